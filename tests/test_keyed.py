import shutil

import pytest
from pyspark.sql import functions as F

from smogline.operators.forecast import parse_forecast, to_raw_columns
from smogline.schemas import GEO_DICTIONARY, RAW_READINGS
from smogline.sources import keyed
from smogline.sources.streams import numbered_messages
from tests.samples import forecast, plan


def batch(spark, *messages):
    rows = spark.createDataFrame(list(messages), "seq BIGINT, value STRING")
    return to_raw_columns(parse_forecast(numbered_messages(rows, "value", "seq")))


def view(spark, root):
    rows = keyed.current_view(spark, RAW_READINGS, root).collect()
    return {(row.latitude, row.timestamp): row.pm_data.pi for row in rows}


def test_last_write_wins_whatever_the_batches(spark, tmp_path):
    messages = [(2, forecast(1.0, base=2)), (1, forecast(1.0, base=1)), (3, forecast(2.0, base=3)), (0, "{bad")]
    late = [(1, forecast(2.0, base=9)), (5, forecast(1.0, base=5))]
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    keyed.write_batch(batch(spark, *messages, *late), RAW_READINGS, whole, 0)
    for number, part in enumerate((late, messages)):
        keyed.write_batch(batch(spark, *part), RAW_READINGS, cut, number)
    assert view(spark, whole) == view(spark, cut) == {(1.0, 1700000000): 5.0, (2.0, 1700000000): 3.0}
    bad = keyed.quarantine(spark, RAW_READINGS, cut).collect()
    assert [(row.reject_reason, row.payload, row.batch_id) for row in bad] == [("malformed", "{bad", 1)]


def test_rows_without_order_follow_their_batches(spark, tmp_path):
    root = str(tmp_path / "log")
    for number, base in enumerate((7, 3)):
        rows = batch(spark, (1, forecast(1.0, base=base))).drop("write_order", "reject_reason", "payload")
        keyed.write_rows(rows, RAW_READINGS, root, number)
    assert view(spark, root) == {(1.0, 1700000000): 3.0}
    keyed.write_batch(batch(spark, (1, forecast(1.0, base=4))), RAW_READINGS, root, 2)
    assert view(spark, root) == {(1.0, 1700000000): 4.0}


def test_ties_are_decided_by_content(spark, tmp_path):
    rows = [(1, forecast(1.0, base=base)) for base in range(20)]
    views = []
    for name, order in (("a", rows), ("b", rows[::-1])):
        keyed.write_batch(batch(spark, *order).repartition(5), RAW_READINGS, str(tmp_path / name), 0)
        views.append(view(spark, str(tmp_path / name)))
    assert views[0] == views[1] and len(views[0]) == 1


def test_rows_without_key_are_rejected(spark, tmp_path):
    root = str(tmp_path / "dictionary")
    rows = [(None, 2.0, "old", "o", "c", None, None), (None, 2.0, "new", "n", "c", None, None), (1.0, 2.0, "x", "y", "c", None, None)]
    keyed.write_rows(spark.createDataFrame(rows, GEO_DICTIONARY.ddl), GEO_DICTIONARY, root, 0)
    keyed.write_rows(spark.createDataFrame(rows[2:], GEO_DICTIONARY.ddl), GEO_DICTIONARY, root, 1)
    keyed.compact(spark, GEO_DICTIONARY, root)
    assert [row.city for row in keyed.current_view(spark, GEO_DICTIONARY, root).collect()] == ["x"]
    bad = keyed.quarantine(spark, GEO_DICTIONARY, root).collect()
    assert sorted((row.city, row.reject_reason) for row in bad) == [("new", "incomplete"), ("old", "incomplete")]


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(spark, request):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    yield
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_replay_replaces_the_first_attempt(spark, tmp_path, overwrite_mode):
    root = str(tmp_path / "log")
    keyed.write_batch(batch(spark, (1, forecast(1.0)), (2, "{bad")), RAW_READINGS, root, 5)
    # The second attempt rejects nothing: nothing of the first one's rejects may stay.
    keyed.write_batch(batch(spark, (1, forecast(1.0)), (2, forecast(2.0))), RAW_READINGS, root, 5)
    log = keyed.read_log(spark, RAW_READINGS, root)
    assert log.count() == 2 and keyed.quarantine(spark, RAW_READINGS, root).count() == 0
    assert len(view(spark, root)) == 2


def grown_log(spark, root):
    for number in range(4):
        rows = [(i, forecast(float(i), base=10 * number + i)) for i in range(number + 1)]
        keyed.write_batch(batch(spark, *rows, (9, None)), RAW_READINGS, root, number)
    return view(spark, root)


def test_compaction_keeps_view_rejects_and_order_of_batches(spark, tmp_path, overwrite_mode):
    root = str(tmp_path / "log")
    before = grown_log(spark, root)
    keyed.compact(spark, RAW_READINGS, root)
    assert view(spark, root) == before
    keyed.write_batch(batch(spark, (99, forecast(0.0, base=77)), (-1, forecast(1.0, base=78))), RAW_READINGS, root, 4)
    after = before | {(0.0, 1700000000): 77.0}
    assert view(spark, root) == after
    keyed.compact(spark, RAW_READINGS, root)
    keyed.write_batch(batch(spark, (1, "{")).limit(0), RAW_READINGS, root, 5)
    keyed.compact(spark, RAW_READINGS, root)
    # What is settled no longer needs its batches.
    for number in range(5):
        shutil.rmtree(f"{root}/log/batch_id={number}/outcome=accepted")
    assert view(spark, root) == after
    assert keyed.quarantine(spark, RAW_READINGS, root).count() == 4


def test_last_batch_can_be_replayed_after_compaction(spark, tmp_path):
    root = str(tmp_path / "log")
    before = grown_log(spark, root)
    keyed.compact(spark, RAW_READINGS, root)
    rows = [(i, forecast(float(i), base=30 + i)) for i in range(4)]
    keyed.write_batch(batch(spark, *rows, (9, None)), RAW_READINGS, root, 3)
    assert view(spark, root) == before
    assert keyed.quarantine(spark, RAW_READINGS, root).count() == 4


DAY = 86_400


def daily(spark, root):
    """Three days, settled, and then a later write to the second."""
    rows = [(i, forecast(float(i), timestamp=DAY * day, base=10 * day)) for i in range(2) for day in (100, 101, 102)]
    keyed.write_batch(batch(spark, *rows), RAW_READINGS, root, 0)
    keyed.write_batch(batch(spark, (50, forecast(0.0, timestamp=DAY * 101, base=99))), RAW_READINGS, root, 1)
    keyed.compact(spark, RAW_READINGS, root)


def test_compaction_writes_only_the_days_written_since(spark, tmp_path):
    root = str(tmp_path / "log")
    daily(spark, root)
    keyed.write_batch(batch(spark, (1, "{")).limit(0), RAW_READINGS, root, 2)
    keyed.compact(spark, RAW_READINGS, root)
    folders = {path.name: sorted(day.name for day in path.iterdir() if day.is_dir()) for path in (tmp_path / "log/settled").iterdir()}
    assert folders == {"upto=0": ["slice=100", "slice=101", "slice=102"], "upto=1": ["slice=101"]}
    assert view(spark, root)[(0.0, DAY * 101)] == 99.0 and len(view(spark, root)) == 6
    # A generation whose write did not end does not count.
    (tmp_path / "log/settled/upto=1/_SUCCESS").unlink()
    assert view(spark, root)[(0.0, DAY * 101)] == 99.0 and len(view(spark, root)) == 6
    keyed.compact(spark, RAW_READINGS, root)
    assert len(view(spark, root)) == 6


def test_days_are_pruned(spark, tmp_path):
    root = str(tmp_path / "log")
    daily(spark, root)
    shown = keyed.current_view(spark, RAW_READINGS, root, days=(101, 102))
    assert sorted({row.timestamp // DAY for row in shown.collect()}) == [101, 102]
    filters = [line for line in plan(shown).splitlines() if line.startswith("PartitionFilters") and "slice" in line]
    assert filters and all(">= 101" in line and "<= 102" in line for line in filters)
    with pytest.raises(ValueError, match="has no days"):
        keyed.current_view(spark, GEO_DICTIONARY, root, days=(1, 2))


def test_building_a_view_starts_no_job(spark, tmp_path):
    root = str(tmp_path / "log")
    daily(spark, root)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        shown = keyed.current_view(spark, RAW_READINGS, root)
        assert list(tracker.getJobIdsForGroup("building")) == []
        assert shown.count() == 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_files_per_batch_are_bounded(spark, tmp_path):
    rows = [(i, forecast(float(i % 80))) for i in range(400)] + [(1000 + i, "{") for i in range(50)]
    keyed.write_batch(batch(spark, *rows).repartition(40), RAW_READINGS, str(tmp_path / "log"), 0)
    assert len(list((tmp_path / "log").rglob("part-*.parquet"))) <= 2


def test_nothing_to_compact(spark, tmp_path):
    root = str(tmp_path / "log")
    keyed.create_log(spark, RAW_READINGS, root)
    keyed.compact(spark, RAW_READINGS, root)
    keyed.write_batch(batch(spark, (1, forecast())), RAW_READINGS, root, 0)
    keyed.compact(spark, RAW_READINGS, root)
    assert not (tmp_path / "log/settled").exists() and len(view(spark, root)) == 1


def test_key_filters_and_partitions_reach_the_scan(spark, tmp_path):
    root = str(tmp_path / "log")
    keyed.write_batch(batch(spark, (1, forecast()), (2, "{")), RAW_READINGS, root, 0)
    one_station = keyed.current_view(spark, RAW_READINGS, root).filter(
        (F.col("latitude") == 47.25) & (F.col("timestamp") >= 1700000000)
    )
    text = plan(one_station.select("timestamp", "pm_data.pi"))
    assert "EqualTo(latitude,47.25)" in text and "GreaterThanOrEqual(timestamp,1700000000)" in text
    assert "(outcome#" in text.split("PartitionFilters: ", 1)[1].splitlines()[0]
    schema = text.split("ReadSchema: ", 1)[1].splitlines()[0]
    assert "pm_data" in schema and "ozone_data" not in schema and "payload" not in schema


def test_plain_rows(spark, tmp_path):
    root = str(tmp_path / "dictionary")
    columns = GEO_DICTIONARY.ddl
    old = spark.createDataFrame([(1.0, 2.0, "old", "o", "c", None, None), (3.0, 4.0, "kept", "k", "c", None, None)], columns)
    new = spark.createDataFrame([(1.0, 2.0, "new", "n", "c", None, None)], columns)
    keyed.write_rows(old, GEO_DICTIONARY, root, 0)
    keyed.write_rows(new, GEO_DICTIONARY, root, 1)
    assert sorted(row.city for row in keyed.current_view(spark, GEO_DICTIONARY, root).collect()) == ["kept", "new"]
