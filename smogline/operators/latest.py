"""Last write wins, newest first, and rows in key order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86_400


def last_write(df: DataFrame, key: list[str] | tuple[str, ...], order: list[str]) -> DataFrame:
    """The whole row written last for each key.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    shuffle, so a map task sends one row per key: a key that holds a large part
    of the input costs no more than any other.
    """
    # Rows are sorted by key before the limit, and sorting compares the first
    # column's leading bytes: numbers tell more keys apart than names do.
    numbers_first = sorted(key, key=lambda name: df.schema[name].dataType == T.StringType())
    newest = Window.partitionBy(*numbers_first).orderBy(*[F.desc(name) for name in order])
    rank = "_write_rank"
    return df.withColumn(rank, F.row_number().over(newest)).filter(F.col(rank) == 1).drop(rank)


def newest_first_rank(df: DataFrame, station: list[str], timestamp: str, rank: str = "newest_rank") -> DataFrame:
    """Number the readings of each station, newest first.

    Expects the rows of a keyed table: no NULL in the key, one row per station
    and second. Ranks are counted inside days and shifted by the number of
    readings on later days, so no task sorts more than one station day, however
    long or frequent a station's history is.
    """
    # Stated before the plan splits in two, so that both sides are the same and
    # the shuffle below them runs once: Catalyst would infer it for one side.
    days = df.withColumn("_day", F.floor(F.col(timestamp) / SECONDS_PER_DAY))
    for name in (*station, "_day"):
        days = days.filter(F.col(name).isNotNull())
    later_days = Window.partitionBy(*station).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    counts = days.groupBy(*station, "_day").agg(F.count("*").alias("_n"))
    newer = counts.select(*station, "_day", F.coalesce(F.sum("_n").over(later_days), F.lit(0)).alias("_newer"))
    in_day = Window.partitionBy(*station, "_day").orderBy(F.desc(timestamp))
    ranked = days.join(newer, [*station, "_day"]).withColumn(rank, F.col("_newer") + F.row_number().over(in_day))
    return ranked.drop("_day", "_newer")


def in_key_order(df: DataFrame, key: tuple[str, ...], newest_first: str | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by key, newest first inside a station.

    The range includes the time column, so a station with very many readings
    spreads over several files; their min/max statistics let a reader skip.
    """
    order: list[Column] = [F.col(name) for name in key if name != newest_first]
    if newest_first:
        order.append(F.desc(newest_first))
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
