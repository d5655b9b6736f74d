"""The corpus pipeline: five stages over ``documents``, each written and read again.

toxicity        drops the documents that the factorization machine rejects
near_duplicates keeps one document of each group, with or without ids
decontaminate   drops the documents that hold a window of a benchmark item
personal_data   replaces personal data by the name of its kind
tokens          encodes what is left, and checks that it decodes to itself

A document without text is clean at every stage and stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm import decontaminate, odd_sketch, pii_bootstrap, piece_bpe, toxicity
from smogline.llm.common import held_out, small_or_shuffled, table, text_key, written
from smogline.llm.queries import CUT, MODEL
from smogline.scratch import cleared, new_folder
from smogline.sources.files import delete

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# No SQL for a fitted machine; tests compare the stages with brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents less those of a dropped id and text; texts move only if these are too many to broadcast."""
    rows = dropped.select(F.col("doc_id").alias("dropped_id"), F.col("key").alias("dropped_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("dropped_id")) & (text_key() == F.col("dropped_key"))
    return docs.join(small_or_shuffled(written(rows, "dropped")), same, "left_anti")


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents, with numbers after all ids for those without id; ``numbered`` tells which."""
    docs = docs.select(*COLUMNS, F.col("doc_id").isNull().alias("numbered"))
    idless = docs.where("numbered")
    if idless.isEmpty():
        return docs
    last = docs.agg(F.greatest(F.max("doc_id"), F.lit(0))).first()[0]
    ids = written(idless.withColumn("doc_id", F.monotonically_increasing_id() + F.lit(last + 1)), "numbered")
    return docs.where("not numbered").unionByName(ids)


def toxic_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    machine = toxicity.fit(docs, table(spark, folder, "labels"), ~held_out("doc_id", 4, 2))
    return docs.select(*COLUMNS).where(toxicity.score(machine, "text") < CUT)


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    docs = _numbered(docs)
    left = _without(docs, odd_sketch.near_duplicates(docs).where("not text_kept"))
    return left.withColumn("doc_id", F.when(~F.col("numbered"), F.col("doc_id"))).select(*COLUMNS)


def leaks_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    leaks = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"))
    return _without(docs.select(*COLUMNS), leaks.where("size(hit_words) > 0"))


def redacted(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    found = pii_bootstrap.personal_data(docs).where("size(spans) > 0").select("doc_id", "key", "spans")
    spans = written(found.distinct().withColumnsRenamed({"doc_id": "span_id", "key": "span_key"}), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("span_key"))
    # Bounded by counting spans, not rows: a row may have many.
    few = (spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]) <= 500_000
    joined = docs.select(*COLUMNS).join(F.broadcast(spans) if few else spans, same, "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(pii_bootstrap.redacted(F.col("text"), F.col("spans")))
    return joined.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    ).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    coded = piece_bpe.encode(docs.select(*COLUMNS), public_tokenizers.path(MODEL))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", one_of_each),
    ("decontaminate", leaks_out),
    ("personal_data", redacted),
    ("tokens", tokens),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage. What a stage needed on its way goes when its rows are written, and so do those of the stage before."""
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES:
        place = new_folder(spark, name)
        with cleared(spark):
            rows = stage(spark, docs, folder)
            rows.write.parquet(place)
        docs = spark.read.schema(rows.schema).parquet(place)
        if before is not None:
            delete(spark, before)
        before = place
    return docs
