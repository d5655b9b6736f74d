"""One query per operator over its whole table, with the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm import (
    attention_lm,
    decision_list,
    decontaminate,
    importance,
    language_id,
    merkle,
    odd_sketch,
    pii_bootstrap,
    piece_bpe,
    quality_mil,
    rendezvous,
    style_tree,
    toxicity,
)
from smogline.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# The vocabulary comes with its package, at one place on every worker.
MODEL = "piece_bpe_32k.model"
CUT = 0.3


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _sha(text) -> F.Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN_WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {PLAIN_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
    windows AS (
        SELECT DISTINCT item, array_to_string(list_slice(words, i, i + least(10, len(words)) - 1), ' ') AS "window",
               least(10, len(words)) AS width
        FROM (SELECT item, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0)),
    docs AS (SELECT row_number() OVER () AS row, doc_id, {PLAIN_WORDS} AS words FROM documents),
    widths AS (SELECT DISTINCT width FROM windows),
    starts AS (
        SELECT row, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM docs, widths WHERE len(words) >= width),
    found AS (
        SELECT row, item, i, starts.width
        FROM starts JOIN windows
          ON starts.width = windows.width AND array_to_string(list_slice(words, i, i + starts.width - 1), ' ') = "window"),
    hits AS (
        SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + width)) AS p FROM found) GROUP BY row),
    named AS (
        SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
""")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    widths = F.transform("hit_words", lambda run: run["last"] - run["first"])
    n_hit = F.aggregate(widths, F.lit(0).cast("long"), lambda total, width: total + width)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        _sha(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


@query()
def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = style_tree.extract(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    away = held_out("doc_id", 5, 0)
    network = quality_mil.fit(docs, table(spark, folder, "labels"), ~away)
    looked = docs.select("doc_id", away.alias("held_out"), quality_mil.score(network, "text").alias("look"))
    scored = looked.select("doc_id", "held_out", F.col("look.score").alias("score"), F.col("look.passage").alias("passage"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


# CRC-32 by its table, which follows from the polynomial: eight shifts for each byte.
CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"


@query(f"""
    WITH tabled AS MATERIALIZED (SELECT {CRC_TABLE} AS crcs),
    bytes AS (
        SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS hexes FROM documents),
    sized AS (
        SELECT row, doc_id, CAST(length(hexes) // 2 + 16 AS BIGINT) AS size,
               xor(list_reduce(
                   list_concat([4294967295],
                       list_transform(range(1, length(hexes), 2), lambda i: CAST('0x' || substr(hexes, i, 2) AS BIGINT))),
                   lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
        FROM bytes, tabled),
    draws AS (
        SELECT row, shard, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || shard), 1, 13) AS BIGINT) AS draw
        FROM sized, (SELECT unnest(range(41)) AS shard)),
    chosen AS (
        SELECT row, arg_max(shard, draw) FILTER (shard < 40) AS shard, arg_max(shard, draw) AS grown_shard
        FROM draws GROUP BY row)
    SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
           row_number() OVER (
               PARTITION BY shard
               ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3), doc_id, text_crc32, size) - 1 AS slot,
           CAST(grown_shard AS INT) AS grown_shard
    FROM sized JOIN chosen USING (row)
""")
def op4_rendezvous(spark: SparkSession, folder: str) -> DataFrame:
    placed = rendezvous.place(table(spark, folder, "documents"), [1.0] * 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query()
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = piece_bpe.encode(docs, public_tokenizers.path(MODEL))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        _sha("decoded").alias("decoded_sha256"),
    )


@query()
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, folder, "documents")).drop("key", "text_kept")


@query()
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii_bootstrap.personal_data(table(spark, folder, "documents"))

    def number(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, ("email", "ip", "card", "phone")),
        _sha(pii_bootstrap.listed("base")).alias("base_sha256"),
        pii_bootstrap.listed("spans").alias("spans"),
    )


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    away = held_out("doc_id", 4, 2)
    machine = toxicity.fit(docs, table(spark, folder, "labels"), ~away)
    scored = docs.select("doc_id", away.alias("held_out"), toxicity.score(machine, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@query()
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    away = held_out("doc_id", 4, 2)
    hierarchy = language_id.fit(docs, ~away)
    found = docs.select("doc_id", away.alias("held_out"), language_id.identify(hierarchy, "text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query()
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = decision_list.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        "base_failed",
        "kept",
        "rule",
    )


# The CRC of a feature's bytes, by the same table as above.
FEATURE_CRC = """xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, length(hexes), 2), lambda i: CAST('0x' || substr(hexes, i, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"""


@query(f"""
    WITH tabled AS MATERIALIZED (SELECT {CRC_TABLE} AS crcs),
    texts AS MATERIALIZED (
        SELECT true AS corpus, row_number() OVER () AS row, doc_id, {PLAIN_WORDS} AS words FROM documents
        UNION ALL SELECT false, row_number() OVER (), NULL, {PLAIN_WORDS} FROM benchmark),
    places AS (SELECT corpus, row, words, unnest(range(1, len(words) + 1)) AS i FROM texts),
    runs AS MATERIALIZED (
        SELECT corpus, row, array_to_string(list_slice(words, i, i + width - 1), ' ') AS feature, count(*) AS n
        FROM places, (SELECT unnest([1, 2, 3]) AS width) WHERE i + width - 1 <= len(words) GROUP BY ALL),
    hashed AS MATERIALIZED (
        SELECT feature, {FEATURE_CRC} % 10000 AS bucket
        FROM (SELECT feature, hex(encode(feature)) AS hexes FROM (SELECT DISTINCT feature FROM runs)), tabled),
    counted AS (
        SELECT bucket, sum(n) FILTER (corpus) AS s, sum(n) FILTER (NOT corpus) AS t FROM runs JOIN hashed USING (feature) GROUP BY bucket),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln(((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST(coalesce(sum(s) OVER (), 0) AS DOUBLE) + 10000))
                                          / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (CAST(coalesce(sum(t) OVER (), 0) AS DOUBLE) + 10000)))) AS BIGINT) AS gain
        FROM counted),
    weights AS (
        SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
        FROM runs JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE corpus GROUP BY row),
    scored AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                   (CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
        FROM texts LEFT JOIN weights USING (row) WHERE corpus),
    ranked AS (
        SELECT *, row_number() OVER (ORDER BY n_words < 20, score DESC, doc_id NULLS FIRST) AS place,
               count(*) FILTER (n_words >= 20) OVER () AS able FROM scored)
    SELECT doc_id, n_words, n_features, weight, score,
           CASE WHEN n_words >= 20 AND place <= 5 * able // 100 THEN place END AS rank
    FROM ranked
""")
def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op11_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    away = held_out("doc_id", 5, 1)
    model = attention_lm.fit(docs, ~away, public_tokenizers.path(MODEL))
    return attention_lm.score(docs, model, away)


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    named = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return f"sha256({' || '.join(map(_field, named))})"


# CRC-32 of an id's digits, as above.
ID_CRC = """xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, length(digits) + 1), lambda i: CAST(ascii(substr(digits, i, 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"""
# Levels of nodes from leaves (tree, place, digest), and each run's digests in order.
CLIMB = """
    SELECT 0 AS level, tree, place, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
    UNION ALL
    SELECT level + 1, tree, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
    FROM {nodes} WHERE n > 1 GROUP BY level, tree, place // 8, n"""
RUNS = "SELECT level, tree, place // 8 AS run, list(digest ORDER BY place) AS digests FROM {nodes} WHERE n > 1 GROUP BY ALL"
SIDES = "array_to_string(list_slice(digests, 1, spot), '') AS lefts, array_to_string(list_slice(digests, spot + 2, 8), '') AS rights"


@query(f"""
    WITH RECURSIVE tabled AS MATERIALIZED (SELECT {CRC_TABLE} AS crcs),
    rows AS MATERIALIZED (
        SELECT row_number() OVER () AS row, doc_id, lang, {_leaf("text")} AS leaf,
               CASE WHEN {ID_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                    ELSE {_leaf("text")} END AS seen
        FROM (SELECT *, CAST(doc_id AS VARCHAR) AS digits FROM documents), tabled),
    placed AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place,
               dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree
        FROM rows),
    leaves AS (SELECT tree, place, leaf AS digest FROM placed),
    nodes AS ({CLIMB.format(leaves="leaves", nodes="nodes")}),
    subroots AS MATERIALIZED (SELECT 0 AS tree, tree AS place, digest FROM nodes WHERE n = 1),
    tops AS ({CLIMB.format(leaves="subroots", nodes="tops")}),
    steps AS MATERIALIZED (
        SELECT row, level, {SIDES}
        FROM (SELECT row, level, digests, (place // CAST(8 ** level AS BIGINT)) % 8 AS spot
              FROM placed JOIN ({RUNS.format(nodes="nodes")}) USING (tree)
              WHERE run = place // CAST(8 ** (level + 1) AS BIGINT))
        UNION ALL
        SELECT row, 100 + level, {SIDES}
        FROM (SELECT row, level, digests, (placed.tree // CAST(8 ** level AS BIGINT)) % 8 AS spot
              FROM placed, ({RUNS.format(nodes="tops")}) AS runs
              WHERE run = placed.tree // CAST(8 ** (level + 1) AS BIGINT))),
    paths AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY row ORDER BY level) AS k, count(*) OVER (PARTITION BY row) AS length FROM steps),
    folds AS (
        SELECT row, 0 AS k, seen AS acc FROM placed
        UNION ALL
        SELECT row, folds.k + 1, sha256(lefts || acc || rights) FROM folds JOIN paths USING (row) WHERE paths.k = folds.k + 1),
    proofs AS (SELECT row, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof, count(*) AS length FROM steps GROUP BY row),
    root AS (SELECT digest AS root FROM tops WHERE n = 1)
    SELECT doc_id, leaf, subroots.digest AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
           acc AS folded_root, acc = root AS verified
    FROM placed JOIN subroots ON subroots.place = placed.tree CROSS JOIN root
         LEFT JOIN proofs USING (row) JOIN folds ON folds.row = placed.row AND folds.k = coalesce(length, 0)
""")
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle.manifest(docs, merkle.lowered(F.col("doc_id"), F.col("text")))
