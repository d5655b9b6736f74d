import random

from pyspark.sql import functions as F

from smogline.operators.latest import in_key_order, last_write, newest_first_rank
from tests.samples import plan


def test_whole_row_of_the_last_write(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, 10), ("a", 2, None, 20), ("b", 1, 3, 30), (None, 5, 5, 50)], "k STRING, seq INT, x INT, y INT"
    )
    found = {row.k: (row.seq, row.x, row.y) for row in last_write(rows, ["k"], ["seq"]).collect()}
    assert found == {"a": (2, None, 20), "b": (1, 3, 30), None: (5, 5, 50)}


def test_hot_key_is_cut_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(10_000).select(key.alias("k"), "id")
    latest = last_write(rows, ["k"], ["id"])
    text = plan(latest)
    assert "WindowGroupLimit" in text and text.count("Exchange") <= 2
    assert latest.filter("k = 'hot'").first().id == 9999
    assert latest.count() == rows.select("k").distinct().count()


def test_rank_equals_a_plain_sort(spark):
    random.seed(7)
    stations = {("hot", t) for t in random.sample(range(0, 40 * 86_400), 400)}
    stations |= {(f"s{i}", t) for i in range(20) for t in random.sample(range(0, 10 * 86_400), 15)}
    stations.add(("early", -86_401))
    rows = spark.createDataFrame(sorted(stations), "station STRING, t BIGINT")
    ranked = newest_first_rank(rows, ["station"], "t").collect()
    expected = {}
    for station in {s for s, _ in stations}:
        times = sorted((t for s, t in stations if s == station), reverse=True)
        expected |= {(station, t): place for place, t in enumerate(times, 1)}
    assert {(row.station, row.t): row.newest_rank for row in ranked} == expected


def test_key_order_splits_a_hot_station(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"), F.col("id").alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        in_key_order(rows, ("latitude", "longitude", "t"), "t").write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name().alias("file")).agg(
        F.min("t").alias("low"), F.max("t").alias("high"), F.count("*").alias("n"), F.first("t").alias("first")
    ).orderBy("low").collect()
    assert len(files) > 4 and max(row.n for row in files) < 8_000
    assert all(below.high < above.low for below, above in zip(files, files[1:], strict=False))
    assert all(row.first == row.high for row in files)
