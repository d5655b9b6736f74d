"""The standing queries: raw readings, readings with city and country, and both from one parse.

All write batches through ``sources.keyed``: a restart continues from the
checkpoint, and a batch that runs twice replaces its own folder. Which version
of a changing dictionary a batch takes is written down before it is used, so
that the second run takes the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from smogline.operators.dictionary import by_rounded_key
from smogline.operators.enrich import KEYS, enrich_by_key, with_keys
from smogline.operators.forecast import PAYLOAD, REASON, UNMATCHED, parse_forecast, to_geo_columns, to_raw_columns
from smogline.operators.frequent import FrequentStations
from smogline.operators.sizes import broadcast_if_small, in_memory_bytes
from smogline.schemas import ENRICHED_READINGS, GEO_DICTIONARY, RAW_COLUMNS, RAW_READINGS
from smogline.scratch import shared_folder
from smogline.sources import files
from smogline.sources.keyed import (
    ACCEPTED,
    CHOICES,
    CORRECTIONS,
    OUTCOME,
    create_log,
    publish_batch,
    read_batch,
    read_log,
    stage_batch,
    write_batch,
)
from smogline.sources.streams import ORDER
from smogline.sources.tables import latest_version, read_version
from smogline.streaming.health import observed

# Fixed value: the pause between micro-batches.
INTERVAL = {"processingTime": "3 seconds"}

# A stream broadcasts its dictionary anew for every micro-batch, so it takes less
# than a batch job would: this much is sent in well under one interval.
STREAM_BROADCAST_BYTES = 32 << 20

# Everything that has arrived, then stop: for backfills and tests.
CATCH_UP = {"availableNow": True}


def raw_ingest(
    messages: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store every reading under its coordinates and time."""

    create_log(messages.sparkSession, RAW_READINGS, root)

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, RAW_READINGS, root, batch_id)

    return _start(to_raw_columns(parse_forecast(messages)), store, checkpoint, trigger)


@dataclass(frozen=True)
class Versions:
    """A dictionary that changes: ``current`` names its version, ``load`` reads the rows of one."""

    current: Callable[[], int]
    load: Callable[[int], DataFrame]


def dictionary_versions(spark: SparkSession, root: str) -> Versions:
    """The finished versions of a dictionary kept by ``replace_table``."""
    return Versions(lambda: latest_version(spark, root), lambda version: read_version(spark, GEO_DICTIONARY, root, version))


class _Lookup:
    """The dictionary by rounded key: one that is read once, or the version that a batch has chosen."""

    def __init__(self, dictionary: DataFrame | Versions, root: str, max_broadcast_bytes: int):
        self.dictionary, self.root, self.max_bytes = dictionary, root, max_broadcast_bytes
        self.kept: dict[int, tuple[DataFrame, bool]] = {}
        if not isinstance(dictionary, Versions):
            self.of_version(0)

    def of_version(self, version: int) -> tuple[DataFrame, bool]:
        if version not in self.kept:
            found = self.dictionary.load(version) if isinstance(self.dictionary, Versions) else self.dictionary
            rows = frozen(by_rounded_key(found))
            self.kept.clear()
            self.kept[version] = rows, in_memory_bytes(rows) <= self.max_bytes
        return self.kept[version]

    def of_batch(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, bool]:
        if not isinstance(self.dictionary, Versions):
            return self.of_version(0)
        return self.of_version(chosen_version(spark, self.root, batch_id, self.dictionary.current))


def chosen_version(spark: SparkSession, root: str, batch_id: int, current: Callable[[], int]) -> int:
    """The version on record for a batch; the current one is put on record if there is none."""
    path = f"{root}/{CHOICES}/{batch_id}"
    if files.exists(spark, path) and (text := files.read_text(spark, path)).endswith("\n"):
        return int(text)
    version = current()
    # A record that was cut off has not been used by anyone.
    files.write_text(spark, path, f"{version}\n", overwrite=True)
    return version


def enriched_stream(
    messages: DataFrame,
    dictionary: DataFrame | Versions,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_broadcast_bytes: int = STREAM_BROADCAST_BYTES,
) -> StreamingQuery:
    """Store every reading under its city, country and time.

    A DataFrame is read once, at the start. Of ``Versions`` the current one is
    asked for at each micro-batch, and read, merged and measured only when it is
    another than before. A batch that runs again takes the version of its first
    run, whatever is current then.
    """
    create_log(messages.sparkSession, ENRICHED_READINGS, root)
    lookup = _Lookup(dictionary, root, max_broadcast_bytes)

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows, fits = lookup.of_batch(session, batch_id)
        stations = FrequentStations(session, root)
        # Known from the batches before, so that this one is parsed once.
        frequent = None if fits else stations.before(batch_id, 2 * int(session.conf.get("spark.sql.shuffle.partitions")))
        write_batch(enrich_by_key(batch, rows, fits, frequent), ENRICHED_READINGS, root, batch_id)
        if not fits:
            stations.add(batch_id, read_batch(session, ENRICHED_READINGS, root, batch_id))

    return _start(to_geo_columns(parse_forecast(messages)), store, checkpoint, trigger)


def both_tables(
    messages: DataFrame,
    dictionary: DataFrame | Versions,
    raw_root: str,
    enriched_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_broadcast_bytes: int = STREAM_BROADCAST_BYTES,
) -> StreamingQuery:
    """Store every reading in the raw table and in the one by city, from one parse.

    The raw rows of a batch are written first, and the enriched ones made of
    these. Neither table shows the batch before both are written, and a batch
    that failed between them runs again as a whole. The tables are those of the
    two separate queries, rejected rows included.
    """
    spark = messages.sparkSession
    create_log(spark, RAW_READINGS, raw_root)
    create_log(spark, ENRICHED_READINGS, enriched_root)
    lookup = _Lookup(dictionary, enriched_root, max_broadcast_bytes)

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stage_batch(batch, RAW_READINGS, raw_root, batch_id)
        rows, fits = lookup.of_batch(session, batch_id)
        named = enrich_by_key(geo_rows(read_batch(session, RAW_READINGS, raw_root, batch_id)), rows, fits)
        stage_batch(named, ENRICHED_READINGS, enriched_root, batch_id)
        publish_batch(session, raw_root, batch_id)
        publish_batch(session, enriched_root, batch_id)

    return _start(to_raw_columns(parse_forecast(messages)), store, checkpoint, trigger)


def geo_rows(raw: DataFrame) -> DataFrame:
    """Stored raw rows, good and rejected ones, with the pollutants named and nulled as in the enriched table."""
    payload_names = {column: name for name, column in RAW_COLUMNS.items()}
    return to_geo_columns(raw.withColumnsRenamed(payload_names))


def enrich_unmatched(
    spark: SparkSession, dictionary: Versions, root: str, since: int | None, version: int, max_broadcast_bytes: int = STREAM_BROADCAST_BYTES
) -> int:
    """Name the readings that found no entry before and have one now; returns how many entries are new.

    New are the entries of ``version`` whose key ``since`` did not have (None:
    all). Only rejected rows are read, only rows of these keys are kept, and
    they are written as a batch of their own, numbered by the version: doing it
    again replaces it. They keep their place in the order of writing, so a later
    reading stays the last. The rejected rows stay in the quarantine.
    """
    lookup = by_rounded_key(dictionary.load(version))
    if since is not None:
        lookup = lookup.join(broadcast_if_small(by_rounded_key(dictionary.load(since)).select(*KEYS), max_broadcast_bytes), KEYS, "left_anti")
    lookup = frozen(lookup)
    new = lookup.count()
    if new:
        fits = in_memory_bytes(lookup) <= max_broadcast_bytes
        waiting = read_log(spark, ENRICHED_READINGS, root).filter((F.col(OUTCOME) != ACCEPTED) & (F.col(REASON) == UNMATCHED))
        waiting = waiting.select(*(name for name in ENRICHED_READINGS.columns if name not in ("city", "country")), ORDER)
        keys = lookup.select(*KEYS)
        known = with_keys(waiting).join(F.broadcast(keys) if fits else keys, KEYS, "left_semi").drop(*KEYS)
        named = enrich_by_key(known, lookup, fits).withColumn(PAYLOAD, F.lit(None).cast("string"))
        # An entry without a name is no entry: those rows stay where they are.
        write_batch(named.filter(F.col(REASON).isNull()), ENRICHED_READINGS, root, CORRECTIONS + version)
    return new


def frozen(lookup: DataFrame) -> DataFrame:
    """A copy that later changes of the source do not reach, kept where executors can re-read it."""
    shared_folder(lookup.sparkSession)
    return lookup.checkpoint()


def run_until_stopped(query: StreamingQuery) -> None:
    """Block until the query is stopped; raises what made it fail."""
    query.awaitTermination()


def console(stream: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Print each micro-batch; call ``start()`` on the result."""
    return stream.writeStream.format("console").option("numRows", rows).option("truncate", False)


def _start(
    rows: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    writer = observed(rows).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or INTERVAL)).start()
