"""Keyed tables as a log of micro-batches, read through a last-write-wins view.

Layout below a root:

- ``log/batch_id=N/outcome=accepted|rejected``: one write per batch stores good
  and rejected rows together, so neither can appear without the other and the
  batch is read and parsed once. A batch overwrites its own folder: a replay
  replaces what the first attempt left.
- ``settled/upto=B/slice=S``: what batches up to B have settled, one row per
  key, in buckets by a hash of the key. A slice is a day of the readings, or a
  part of the keys of a table without time. ``compact`` writes only the slices
  that the batches since have touched; other slices stay in the generation that
  wrote them last.
- ``manifest``: which batches and slices count, see there. Views open what the
  last one names and list nothing. ``expire`` removes what none names any more.

The write with the greatest order wins, whatever batch it came in. Rows without
an order follow their batches, and go before rows with one; what is equal in all
that is decided by content. So batches may be cut anywhere.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.operators.forecast import INCOMPLETE, PAYLOAD, REASON
from smogline.operators.latest import SECONDS_PER_DAY, last_write
from smogline.schemas import Table
from smogline.sources import files, manifest
from smogline.sources.manifest import Manifest
from smogline.sources.streams import ORDER

BATCH = "batch_id"
OUTCOME = "outcome"
ACCEPTED = "accepted"
REJECTED = "rejected"
SLICE = "slice"
GENERATION = "upto"
# Before any batch of a stream: an empty log, and rows that are settled.
NO_BATCH = -1
# Batches from here on are corrections of earlier ones, made apart from the stream.
CORRECTIONS = 1 << 40
ORDER_TYPE = "STRUCT<at: TIMESTAMP, part: INT, pos: BIGINT>"
# Slices of a table whose key has no time.
KEY_SLICES = 64
# Hash of a row, written with it: ties are decided without reading all columns.
CONTENT = "content_hash"
# Hash of a row's key, which settled rows are dealt to buckets by.
KEY_HASH = "key_hash"
# Buckets of a slice, unless the log was created with another number: few, as a day of a small table is a small file.
BUCKETS = 4
# Later writes go into hash tables, which must fit in memory, up to these bytes of files for each bucket; more are sorted,
# which may spill. The content hash does not compress, so a megabyte holds fewer than 200,000 keys.
HASHED_BYTES = 1 << 20
# Below a root, what a batch has chosen to be made from; of no use once it is settled.
CHOICES = "choices"
# Folders of removed batches and slices are kept for readers that may have opened them.
GRACE_SECONDS = 86_400.0
REMOVERS = 16


def _own_schema(table: Table) -> str:
    return f"{table.ddl}, {ORDER} {ORDER_TYPE}, {CONTENT} BIGINT"


def _log_schema(table: Table) -> str:
    return f"{_own_schema(table)}, {REASON} STRING, {PAYLOAD} STRING, {BATCH} BIGINT, {OUTCOME} STRING"


def _slice(table: Table) -> Column:
    if table.newest_first:
        return F.floor(F.col(table.newest_first) / SECONDS_PER_DAY).cast("bigint")
    return F.pmod(F.xxhash64(*table.key), F.lit(KEY_SLICES))


def _key_hash(table: Table) -> Column:
    # 0.0 added: -0 and 0 are one key.
    kinds = table.columns
    return F.xxhash64(*(F.col(name) + F.lit(0.0) if kinds[name] == "DOUBLE" else F.col(name) for name in table.key))


def create_log(spark: SparkSession, table: Table, root: str, buckets: int = BUCKETS) -> None:
    """An empty log that can be read before its first batch; a no-op if there is one.

    A view that merges settled and later rows has a task for each of the
    ``buckets``, whatever days it reads, so large tables want as many as cores.
    """
    empty = spark.createDataFrame([], _log_schema(table)).drop(BATCH, OUTCOME)
    empty.write.mode("ignore").parquet(f"{root}/log/{BATCH}={NO_BATCH}/{OUTCOME}={ACCEPTED}")
    manifest.commit(spark, root, lambda: _found(spark, root), lambda found: replace(found, buckets=found.buckets or buckets))


def _found(spark: SparkSession, root: str) -> Manifest:
    """The manifest of a log that has none: all its batches, none of them settled."""
    prefix = f"{BATCH}="
    names = (name for name in files.child_folders(spark, f"{root}/log") if name.startswith(prefix))
    return Manifest(batches=manifest.ranges(int(name.removeprefix(prefix)) for name in names))


def _manifest(spark: SparkSession, root: str) -> Manifest:
    return manifest.latest(spark, root) or _found(spark, root)


def write_batch(df: DataFrame, table: Table, root: str, batch_id: int) -> None:
    """Store one batch, good rows and rejected ones; safe to repeat. Views show it from then on."""
    stage_batch(df, table, root, batch_id)
    publish_batch(df.sparkSession, root, batch_id)


def stage_batch(df: DataFrame, table: Table, root: str, batch_id: int) -> None:
    """Write the rows of one batch, which no view shows yet.

    A row with NULL in its key is rejected as incomplete. Rows are rebalanced on
    their way, so that a small batch makes one file for each outcome and a large
    one files of the advisory size, however many tasks it came from.
    """
    keyless = F.lit(False)
    for name in table.key:
        keyless = keyless | F.col(name).isNull()
    named = table.select_from(df, ORDER, REASON, PAYLOAD).withColumn(
        REASON, F.coalesce(REASON, F.when(keyless, INCOMPLETE))
    )
    outcome = F.when(F.col(REASON).isNull(), ACCEPTED).otherwise(REJECTED)
    hashed = named.withColumn(CONTENT, F.xxhash64(*table.columns))
    rows = hashed.withColumn(OUTCOME, outcome).hint("rebalance", OUTCOME)
    # Static, whatever the session says: a replay without rejects must remove the first attempt's.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(OUTCOME).parquet(f"{root}/log/{BATCH}={batch_id}")


def publish_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    """Let views show a batch whose rows are written."""
    manifest.commit(spark, root, lambda: _found(spark, root), lambda found: _with_batch(found, batch_id))


def _with_batch(found: Manifest, batch_id: int) -> Manifest:
    if found.upto is not None and batch_id <= found.upto:
        # Settled already; see ``compact`` for why this is no batch that a stream would run again.
        return found
    return replace(found, batches=manifest.ranges([*found.batch_ids(), batch_id]))


def write_rows(df: DataFrame, table: Table, root: str, batch_id: int) -> None:
    """Store complete rows that come from elsewhere than a message stream."""
    none = F.lit(None).cast("string")
    columns = {REASON: none, PAYLOAD: none}
    if ORDER not in df.columns:
        columns[ORDER] = F.lit(None).cast(ORDER_TYPE)
    write_batch(df.withColumns(columns), table, root, batch_id)


def read_log(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """Every row of every batch, accepted or not, with its batch and order."""
    return spark.read.schema(_log_schema(table)).parquet(f"{root}/log")


def read_batch(spark: SparkSession, table: Table, root: str, batch_id: int) -> DataFrame:
    """All rows of one batch as they were written, with order, reason and payload."""
    reader = spark.read.schema(_log_schema(table)).option("basePath", f"{root}/log")
    return table.select_from(reader.parquet(f"{root}/log/{BATCH}={batch_id}"), ORDER, REASON, PAYLOAD)


def quarantine(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """Rejected rows with the reason; only their partitions are read."""
    rows = read_log(spark, table, root).filter(F.col(OUTCOME) == REJECTED)
    return table.select_from(rows, REASON, PAYLOAD, BATCH)


def current_view(
    spark: SparkSession, table: Table, root: str, days: tuple[int, int] | None = None, lease_seconds: float | None = None
) -> DataFrame:
    """The table as its users see it: the last accepted write of each key.

    ``days`` (first and last, since 1970) leaves the other days' folders unread.
    Building the view reads one manifest and starts no job. Settled rows stay in
    their buckets: later writes are dealt to these, and only they move. What the
    view reads stays in place for ``expire``'s grace period, or for
    ``lease_seconds`` if that is longer.
    """
    found = _manifest(spark, root)
    if lease_seconds is not None and found.number >= 0:
        manifest.lease(spark, root, found.number, lease_seconds)
    settled = _settled(spark, table, root, found)
    later = _later(spark, table, root, found.batch_ids())
    if days is not None:
        if not table.newest_first:
            raise ValueError(f"{table.name} has no days")
        later = later.filter(_slice(table).between(*days)) if later is not None else None
        settled = settled.filter(F.col(SLICE).between(*days)) if settled is not None else None
    return table.select_from(_last_writes(spark, settled, later, table, found.buckets or BUCKETS))


def compact(spark: SparkSession, table: Table, root: str) -> None:
    """Settle all batches but the last, by rewriting the slices that they touch.

    The last batch stays as it is: a stream that stopped between its write and
    its commit runs it once more. What was settled before and is replaced stays
    until ``expire``. A compaction that failed leaves nothing that counts.
    """
    found = _manifest(spark, root)
    streamed = [batch for batch in found.batch_ids() if batch < CORRECTIONS]
    corrections = [batch for batch in found.batch_ids() if batch >= CORRECTIONS]
    settling = [batch for batch in streamed if batch < max(streamed)] + corrections
    if not any(batch > NO_BATCH for batch in settling):
        return
    until = max((batch for batch in settling if batch < CORRECTIONS), default=found.upto if found.upto is not None else NO_BATCH)
    # Named after the last batch, and above all generations before: corrections may settle without a new batch.
    generation = max([until, *(before + 1 for before in found.slices.values())])
    later = _later(spark, table, root, settling)
    # Days or key slices: as many as there are folders.
    touched = {row[SLICE] for row in later.select(_slice(table).alias(SLICE)).distinct().collect()}
    before = _settled(spark, table, root, found, touched)
    buckets = found.buckets or BUCKETS
    kept = _last_writes(spark, before, later, table, buckets).withColumn(SLICE, _slice(table))
    if touched:
        _write_generation(spark, kept, table, f"{root}/settled/{GENERATION}={generation}", buckets)

    def settle(now: Manifest) -> Manifest:
        left = set(now.batch_ids()).difference(settling)
        slices = now.slices | dict.fromkeys(touched, generation)
        return replace(now, batches=manifest.ranges(left), upto=until, slices=slices, buckets=buckets)

    manifest.commit(spark, root, lambda: found, settle)


def _write_generation(spark: SparkSession, rows: DataFrame, table: Table, folder: str, buckets: int) -> None:
    """One file for each slice and bucket, in key order, newest first."""
    # What an attempt that did not end has left; no manifest names it.
    files.delete(spark, folder)
    inside = [F.col(name) for name in table.key if name != table.newest_first]
    inside += [F.desc(table.newest_first)] if table.newest_first else []
    bucket = F.pmod(F.hash(KEY_HASH), F.lit(buckets))
    dealt = rows.withColumn(KEY_HASH, _key_hash(table)).repartition(F.col(SLICE), bucket)
    ordered = dealt.sortWithinPartitions(SLICE, bucket, *inside)
    name = _table_name(f"{folder}/{time.time_ns()}")
    writer = ordered.write.format("parquet").partitionBy(SLICE).bucketBy(buckets, KEY_HASH)
    writer.option("path", folder).mode("overwrite").saveAsTable(name)
    # The table only served to write buckets; its files stay.
    spark.sql(f"DROP TABLE {name}")


def _table_name(text: str) -> str:
    return f"smogline_{hashlib.md5(text.encode()).hexdigest()}"


def expire(spark: SparkSession, root: str, grace_seconds: float = GRACE_SECONDS) -> None:
    """Remove settled batches' accepted rows, and slices that later generations replaced; rejected rows stay.

    Kept is what the last manifest names, and what readers may have opened: all
    that a manifest named within the grace period or under a lease. Removing
    again after a failure goes on where it stopped.
    """
    written = manifest.numbers(spark, root)
    if not written:
        return
    since = time.time() - grace_seconds
    last = max(written)
    # Until the next one was written, a manifest was the last one.
    ends = dict(zip(written, [*list(written.values())[1:], float("inf")]))
    held = {number for number in written if ends[number] >= since} | {last} | manifest.leased(spark, root) & set(written)
    every = {number: manifest.read(spark, root, number) for number in written}
    kept = [found for number, found in every.items() if number in held and found is not None]
    dropped = [found for number, found in every.items() if number not in held and found is not None]
    batches = {batch for found in dropped for batch in found.batch_ids()} - {b for found in kept for b in found.batch_ids()}
    named = {(generation, part) for found in kept for part, generation in found.slices.items()}
    slices = {(generation, part) for found in dropped for part, generation in found.slices.items()} - named
    still = {generation for generation, _ in named}

    def remove_batch(batch: int) -> None:
        folder = f"{root}/log/{BATCH}={batch}"
        rejects = files.exists(spark, f"{folder}/{OUTCOME}={REJECTED}")
        files.delete(spark, f"{folder}/{OUTCOME}={ACCEPTED}" if rejects else folder)
        files.delete(spark, f"{root}/{CHOICES}/{batch}")

    with ThreadPoolExecutor(REMOVERS) as removers:
        list(removers.map(remove_batch, sorted(batches - {NO_BATCH})))
        gone = {f"{root}/settled/{GENERATION}={g}" + (f"/{SLICE}={part}" if g in still else "") for g, part in slices}
        list(removers.map(lambda path: files.delete(spark, path), sorted(gone)))
    for found in dropped:
        for generation, parts in found.generations().items():
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{root}/{generation}/{parts}')}")
    # Last, so that a removal that failed is done again.
    for number in set(written) - held:
        files.delete(spark, manifest._path(root, number))


def _later(spark: SparkSession, table: Table, root: str, batches: list[int]) -> DataFrame | None:
    """Accepted rows of some batches with their order, and nothing of other ones."""
    if not batches:
        return None
    reader = spark.read.schema(_log_schema(table)).option("basePath", f"{root}/log")
    rows = reader.parquet(*(f"{root}/log/{BATCH}={batch}" for batch in batches))
    return rows.filter(F.col(OUTCOME) == ACCEPTED).drop(REASON, PAYLOAD, OUTCOME)


def _settled(
    spark: SparkSession, table: Table, root: str, found: Manifest, only: Iterable[int] | None = None
) -> DataFrame | None:
    """Settled rows of all slices or some, each from the generation that the manifest names."""
    parts = []
    for generation, slices in found.generations().items():
        slices = [part for part in slices if only is None or part in only]
        if not slices:
            continue
        # Registered as what it is, a bucketed table, so that Spark knows that rows need not move.
        name = _table_name(f"{root}/{generation}/{slices}")
        folder = f"{root}/settled/{GENERATION}={generation}"
        quoted = folder.replace("'", "''")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_own_schema(table)}, {KEY_HASH} BIGINT, {SLICE} BIGINT) USING parquet"
            f" PARTITIONED BY ({SLICE}) CLUSTERED BY ({KEY_HASH}) INTO {found.buckets} BUCKETS LOCATION '{quoted}'"
        )
        places = " ".join(f"PARTITION ({SLICE}={part}) LOCATION '{quoted}/{SLICE}={part}'" for part in slices)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
        parts.append(spark.table(name))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _newest(rows: DataFrame, table: Table) -> DataFrame:
    return last_write(rows, table.key, [ORDER, BATCH, CONTENT])


def _join_hint(later: DataFrame, buckets: int) -> str:
    """How later rows meet settled ones: hashed if their files, which are listed already, are small, else sorted."""
    size = later._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return "shuffle_hash" if size <= HASHED_BYTES * buckets else "merge"


def _last_writes(
    spark: SparkSession, settled: DataFrame | None, later: DataFrame | None, table: Table, buckets: int = BUCKETS
) -> DataFrame:
    """Settled rows, replaced where a later write wins, and the last writes of other keys.

    Rows meet by the hash of their key, which settled rows are in buckets by, and
    then by the key itself: as two inequalities, since an equality would ask for
    another distribution. Either kind of join leaves settled rows in their buckets.
    """
    names = [*table.columns, ORDER, CONTENT]
    if later is None:
        return settled.select(*names) if settled is not None else spark.createDataFrame([], _own_schema(table))
    newest = _newest(later, table).select(*names, BATCH)
    if settled is None:
        return newest.select(*names)
    new = newest.withColumn(KEY_HASH, _key_hash(table)).select(*(F.col(n).alias(f"new_{n}") for n in (*names, BATCH, KEY_HASH)))
    how = _join_hint(later, buckets)
    same = F.col(KEY_HASH) == F.col(f"new_{KEY_HASH}")
    for name in table.key:
        same = same & (F.col(name) <= F.col(f"new_{name}")) & (F.col(name) >= F.col(f"new_{name}"))
    # Settled rows count as written before any batch.
    order = F.struct(F.col(ORDER), F.lit(NO_BATCH).cast("bigint"), F.col(CONTENT))
    new_order = F.struct(F.col(f"new_{ORDER}"), F.col(f"new_{BATCH}"), F.col(f"new_{CONTENT}"))
    wins = F.col(f"new_{KEY_HASH}").isNotNull() & (new_order >= order)
    merged = settled.join(new.hint(how), same, "left").select(
        *(F.col(name) if name in table.key else F.when(wins, F.col(f"new_{name}")).otherwise(F.col(name)).alias(name) for name in names)
    )
    # A semi-join by its meaning. As one, or as an inner join, it would get filters below the union of generations,
    # which then forgets its buckets; a condition that is not deterministic keeps it an outer one.
    keys = new.select(f"new_{KEY_HASH}", *(f"new_{name}" for name in table.key)).hint(how)
    met = settled.join(keys, same, "left").where(F.col(f"new_{KEY_HASH}").isNotNull() & (F.rand() < 2)).select(KEY_HASH, *table.key)
    fresh = new.join(met.hint(how), same, "left_anti").select(*(F.col(f"new_{name}").alias(name) for name in names))
    return merged.unionByName(fresh)
