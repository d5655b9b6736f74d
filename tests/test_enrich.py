from collections import Counter

from pyspark.sql import functions as F

from smogline.operators.enrich import enrich
from smogline.operators.sizes import in_memory_bytes
from tests.samples import plan


def dictionary(spark, entries=50):
    rows = [(i + 0.5, -i - 0.5, f"city {i}", "land") for i in range(entries)]
    return spark.createDataFrame(rows, "latitude DOUBLE, longitude DOUBLE, city STRING, country STRING")


def readings(spark, rows):
    return spark.createDataFrame(
        rows, "id INT, latitude DOUBLE, longitude DOUBLE, reject_reason STRING, payload STRING"
    )


def mixed(spark):
    # One station holds half of the rows; a third have no coordinates at all.
    rows = [(i, 3.5, -3.5, None, None) for i in range(300)]
    rows += [(300 + i, None, None, "malformed", "{") for i in range(200)]
    rows += [(500 + i, i + 0.5000001, -i - 0.5, None, None) for i in range(100)]
    return readings(spark, rows)


def test_matched_unmatched_and_rejected(spark):
    found = {row.id: row for row in enrich(mixed(spark), dictionary(spark)).collect()}
    assert len(found) == 600
    assert found[0].city == "city 3" and found[0].reject_reason is None
    assert found[301].reject_reason == "malformed" and found[301].payload == "{"
    assert found[507].city == "city 7"
    assert found[560].reject_reason == "unmatched" and found[560].latitude == 60.5000001


def test_spread_join_gives_the_same_rows(spark):
    small = enrich(mixed(spark), dictionary(spark))
    large = enrich(mixed(spark), dictionary(spark), max_broadcast_bytes=100)
    assert Counter(small.collect()) == Counter(large.select(small.columns).collect())


def test_spread_join_splits_a_busy_station(spark):
    rows = [(i, 3.5, -3.5, None, None) for i in range(2000)]
    rows += [(2000 + i, i % 50 + 0.5, -(i % 50) - 0.5, None, None) for i in range(2000)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = enrich(readings(spark, rows), dictionary(spark), max_broadcast_bytes=0)
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
    # Eight partitions; the station alone would fill more than half of the rows of one.
    assert sum(sizes) == 4000 and max(sizes) < 0.25 * 4000


def test_entry_without_city_or_country_matches_nothing(spark):
    names = spark.createDataFrame(
        [(3.5, -3.5, None, "land"), (7.5, -7.5, "city", None)], dictionary(spark).schema
    )
    rows = readings(spark, [(1, 3.5, -3.5, None, None), (2, 7.5, -7.5, None, None)])
    for bound in (1 << 20, 0):
        assert [row.reject_reason for row in enrich(rows, names, bound).collect()] == ["unmatched"] * 2


def test_broadcast_only_within_the_bound(spark):
    names = dictionary(spark)
    size = in_memory_bytes(names)
    assert size > 50 * len("city 1land")
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan(enrich(mixed(spark), names, size))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        over = plan(enrich(mixed(spark), names, size - 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the entries of the busiest stations are broadcast.
    assert "SortMergeJoin LeftOuter" in over and "spread" in over


def test_empty_dictionary(spark):
    rows = enrich(mixed(spark), dictionary(spark).limit(0))
    assert Counter(row.reject_reason for row in rows.collect()) == {"unmatched": 400, "malformed": 200}
