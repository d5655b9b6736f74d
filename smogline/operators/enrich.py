"""City and country for readings, by rounded coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.functions.coordinates import coord_key
from smogline.operators.dictionary import by_rounded_key
from smogline.operators.forecast import REASON, UNMATCHED
from smogline.operators.sizes import MAX_BROADCAST_BYTES, in_memory_bytes

KEYS = ["lat_key", "lon_key"]


def enrich(
    readings: DataFrame,
    dictionary: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left lookup of each reading; unmatched rows get a ``reject_reason``.

    The dictionary is broadcast only after its size was measured, before
    entries are merged by rounded key, which can only make it smaller. A larger
    one is joined by shuffle.
    """
    names = dictionary.select("latitude", "longitude", "city", "country")
    fits = in_memory_bytes(names) <= max_broadcast_bytes
    return enrich_by_key(readings, by_rounded_key(names), fits)


def with_keys(readings: DataFrame) -> DataFrame:
    """The readings with their rounded key."""
    return readings.withColumns({"lat_key": coord_key("latitude"), "lon_key": coord_key("longitude")})


def enrich_by_key(readings: DataFrame, lookup: DataFrame, fits: bool, frequent: DataFrame | None = None) -> DataFrame:
    """The same for a dictionary that has its rounded keys already.

    An entry without city or country matches nothing: both are parts of a key.
    Without a broadcast, the stations with most readings are looked up apart:
    those of ``frequent``, or else they are counted first.
    """
    keyed = with_keys(readings)
    usable = lookup.filter(F.col("city").isNotNull() & F.col("country").isNotNull())
    marked = usable.withColumn("found", F.lit(True))
    joined = keyed.join(F.broadcast(marked), KEYS, "left") if fits else spread_left_join(keyed, marked, frequent)
    reason = F.when(F.col("found").isNull(), UNMATCHED)
    if REASON in readings.columns:
        reason = F.coalesce(REASON, reason)
    return joined.withColumn(REASON, reason).drop("found", *KEYS)


def spread_left_join(readings: DataFrame, lookup: DataFrame, frequent: DataFrame | None = None) -> DataFrame:
    """Left join on the rounded key by shuffle, in which no station fills a task.

    The stations with most readings are counted, twice as many as there are
    shuffle partitions: any other one has less than half a partition's share.
    Counting reads the readings twice; where their keys are known from before,
    ``frequent`` (lat_key, lon_key) has them, not more than can be broadcast.
    Their entries are that many rows at most, and are broadcast. Readings that
    these resolve, and readings without a key, then spread by a hash of their
    content (the same in a retried task) while the rest is joined by key.
    """
    partitions = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = [name for name in lookup.columns if name not in KEYS]
    has_key = F.col("lat_key").isNotNull() & F.col("lon_key").isNotNull()
    if frequent is None:
        counts = readings.filter(has_key).groupBy(*KEYS).count()
        frequent = counts.orderBy(F.desc("count"), *KEYS).limit(2 * partitions)
    top = frequent.select(*KEYS, F.lit(True).alias("top"))
    entries = lookup.join(F.broadcast(top.select(*KEYS)), KEYS, "left_semi")
    frequent = top.join(F.broadcast(entries), KEYS, "left").withColumnsRenamed({name: f"top_{name}" for name in values})
    content = F.xxhash64(*[name for name in readings.columns if name not in KEYS])
    alone = F.col("top").isNotNull() | ~has_key
    first = readings.join(F.broadcast(frequent), KEYS, "left").withColumn(
        "spread", F.when(alone, content).otherwise(F.xxhash64(*KEYS))
    )
    rest = lookup.withColumn("spread", F.xxhash64(*KEYS))
    rest = rest.withColumnsRenamed({name: f"rest_{name}" for name in rest.columns})
    same = [F.col(name) == F.col(f"rest_{name}") for name in (*KEYS, "spread")]
    joined = first.join(rest, same, "left")
    return joined.select(
        *readings.columns, *(F.coalesce(f"top_{name}", f"rest_{name}").alias(name) for name in values)
    )
