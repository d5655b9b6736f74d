"""What queries on streams and logs do with more rows: work for all cores, and no text parsed twice."""

import pytest
from pyspark.sql import functions as F

from smogline.plans import queries
from smogline.sources import keyed, streams


@pytest.fixture
def folder(spark, tmp_path):
    """Events and places of our own."""
    kinds = F.array(*map(F.lit, ["view", "click", "error", "purchase", "signup"]))
    events = spark.range(2000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("ts"),
        (F.col("id") % 40).alias("user_id"),
        F.get(kinds, (F.col("id") % 5).cast("int")).alias("event_type"),
        (F.col("id") % 97).cast("double").alias("value"),
        F.lit("{}").alias("props"),
    )
    events.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    customers = spark.range(60).selectExpr("id AS c_custkey", "id % 5 AS c_nationkey", "concat('c', id) AS c_name", "'BUILDING' AS c_mktsegment", "100.0D AS c_acctbal")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(5).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name", "0L AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1).selectExpr("id AS r_regionkey", "'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


@pytest.fixture
def buckets(monkeypatch):
    """The numbers of buckets that logs are asked to have."""
    asked, create = [], keyed.create_log

    def recorded(spark, table, root, *number):
        asked.extend(number)
        create(spark, table, root, *number)

    monkeypatch.setattr(keyed, "create_log", recorded)
    return asked


def test_batches_are_cut_from_parsed_rows(spark, folder, buckets, monkeypatch):
    plans, write = [], keyed.write_batch

    def recorded(rows, *rest):
        plans.append(rows._jdf.queryExecution().toString())
        write(rows, *rest)

    monkeypatch.setattr(keyed, "write_batch", recorded)
    found = queries.raw_in_any_batching(spark, folder).groupBy("batches").count().collect()
    assert {row["batches"] for row in found} == {1, 2, 5} and len({row["count"] for row in found}) == 1
    assert len(plans) == 8 and not any("from_json" in plan for plan in plans)
    assert len(buckets) == 3 and min(buckets) >= spark.sparkContext.defaultParallelism


def test_a_backfilled_log_has_a_bucket_for_each_core(spark, folder, buckets):
    assert queries.unmatched_backfill(spark, folder).count() > 0
    assert buckets and min(buckets) >= spark.sparkContext.defaultParallelism


def test_a_batch_of_many_files_has_work_for_all_cores(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "FILE_MESSAGES", 20)
    taken, stream = [], streams.file_stream

    def recorded(*args, **options):
        taken.append(int(options["maxFilesPerTrigger"]))
        return stream(*args, **options)

    monkeypatch.setattr(streams, "file_stream", recorded)
    row = queries.stream_health(spark, folder).first()
    assert row["messages"] == row["logged"] == 2000 and row["rejected"] == row["quarantined"] > 0
    assert taken[0] >= min(33, queries.FILES_PER_CORE * spark.sparkContext.defaultParallelism)
