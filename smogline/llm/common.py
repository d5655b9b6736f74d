"""What the operators share: tables, folds, bounded samples, written intermediates."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.scratch import new_folder

# Rows that one executor may hold of a broadcast side of a few numbers each.
MAX_BROADCAST_ROWS = 500_000
# Rows of a few numbers or words each that a file of an intermediate table should have.
FILE_ROWS = 100_000


# Bytes of a batch on its way to or from a worker. Texts differ in length by
# orders of magnitude, so a limit by rows would not bound memory.
BATCH_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT = "67108864b"
# The C library's names for when freed memory goes back to the system, and when memory is mapped by itself; its default for both.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3
MALLOC_DEFAULT = 128 << 10
KEPT_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in this session, unless it has a limit of its own."""
    if spark.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, purpose: str, most: int | None = None, group_bytes: int | None = None) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Cuts lineage, and survives lost executors: later stages reread the files.
    Of a table that has ``most`` rows at most there are no more files than these
    fill: each is another process or request of the file system, however small.
    Row groups are of about ``group_bytes``, if given: a task that reads long
    values holds all that a group has of them.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    if most is not None:
        df = df.coalesce(1 + most // FILE_ROWS)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def in_order(rows: DataFrame, *order: Column, position: str = "position") -> DataFrame:
    """The rows with their place in the order of all rows: 0, 1, 2 ... without gaps.

    Rows are dealt by range and sorted once. Places inside a range are shifted
    by the sizes of the ranges before: one number for each range comes to the
    driver, however many rows there are. ``order`` should tell rows apart, or a
    run of equal ones lands in one range.
    """
    spark = rows.sparkSession
    # The range in the upper bits and the row in the lower ones, as Spark documents them.
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(position, F.monotonically_increasing_id())
    ranged = written(ranged, "ranged")
    part = F.shiftright(position, 33)
    sizes = sorted((row["part"], row["count"]) for row in ranged.groupBy(part.alias("part")).count().collect())
    firsts, before = [], 0
    for number, count in sizes:
        firsts.append((number, before))
        before += count
    shifts = spark.createDataFrame(firsts, "_range long, _first long")
    inside = F.col(position).bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.join(F.broadcast(shifts), part == F.col("_range"))
    return placed.withColumn(position, F.col("_first") + inside).drop("_range", "_first")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(folds))


def held_out(doc_id: Column | str, folds: int, rest: int) -> Column:
    """Whether the row is kept from learning; a row without an id is, too."""
    return F.coalesce(fold(doc_id, folds) == rest, F.lit(True))


def text_key(text: Column | str = "text") -> Column:
    """A hash that tells rows apart which repeat a doc_id with another text; NULL counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def small_or_shuffled(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the rows (of a few numbers each) were counted to fit.

    ``df`` should be a written table, so that counting reads only footers.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def sample_ids(labels: DataFrame, label: str, learn: Column, per_label: int) -> DataFrame:
    """At most ``per_label`` learnable ids of each of the labels 0 and 1.

    Chosen in the order of a hash of the id, so that every run takes the same.
    An id whose rows disagree is left out. Columns: doc_id, label, weight
    (how many labelled rows each sampled row of its label stands for).
    """
    agreed = (
        labels.where(learn & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    counts = {row["label"]: row["count"] for row in agreed.groupBy("label").count().collect()}
    parts = [
        agreed.where(F.col("label") == value)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_label)
        .withColumn("weight", F.lit(counts.get(value, 0) / max(1, min(per_label, counts.get(value, 0)))))
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def one_text(rows: DataFrame, *key: str) -> DataFrame:
    """One row per key, with its text of the least hash: an id on very many rows counts once, and moves once per task."""
    return rows.groupBy(*key).agg(F.min_by("text", text_key()).alias("text"))


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled documents with label and weight, one of each id; the sample's bound makes the broadcast safe.

    NULL texts are left out.
    """
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")
    return one_text(found, *sample.columns)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in smaller parts, so that a worker holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


@contextmanager
def kept_memory() -> Iterator[None]:
    """Let this worker keep what it frees meanwhile, up to KEPT_BYTES: large arrays that come again and again need no new pages."""
    libc = ctypes.CDLL(None)
    settings = (M_TRIM_THRESHOLD, M_MMAP_THRESHOLD) if hasattr(libc, "mallopt") else ()
    for setting in settings:
        libc.mallopt(setting, KEPT_BYTES)
    try:
        yield
    finally:
        for setting in settings:
            libc.mallopt(setting, MALLOC_DEFAULT)
        give_back()


def give_back() -> None:
    """Return what this worker has freed to the system: it goes on to wait, and others need the memory."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
