from datetime import datetime

import pytest

from smogline.schemas import ENRICHED_READINGS, RAW_READINGS
from smogline.sources import keyed, streams
from smogline.streaming import ingest
from tests.samples import forecast

MESSAGE = "seq BIGINT, value STRING"
NAMES = "latitude DOUBLE, longitude DOUBLE, city STRING, country STRING"


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("landing", "root", "checkpoint", "names")}


def land(spark, folders, *messages):
    rows = spark.createDataFrame(list(messages), MESSAGE)
    rows.coalesce(1).write.mode("append").json(folders["landing"], ignoreNullFields=False)


def arriving(spark, folders, **options):
    stream = streams.file_stream(spark, folders["landing"], MESSAGE, "json", **options)
    return streams.numbered_messages(stream, "value", "seq")


def ingest_raw(spark, folders, **options):
    ingest.raw_ingest(
        arriving(spark, folders, **options), folders["root"], folders["checkpoint"], ingest.CATCH_UP
    ).awaitTermination()


def raw_view(spark, folders):
    rows = keyed.current_view(spark, RAW_READINGS, folders["root"]).collect()
    return {row.latitude: row.pm_data.pi for row in rows}


def test_restart_continues_and_order_decides(spark, folders):
    land(spark, folders, (1, forecast(1.0, base=1)), (2, forecast(2.0, base=2)), (3, "{bad"))
    ingest_raw(spark, folders)
    land(spark, folders, (1, forecast(2.0, base=5)), (2, None))
    ingest_raw(spark, folders)
    ingest_raw(spark, folders)
    log = keyed.read_log(spark, RAW_READINGS, folders["root"])
    assert log.count() == 5 and log.select("batch_id").distinct().count() == 2
    assert raw_view(spark, folders) == {1.0: 1.0, 2.0: 2.0}
    assert keyed.quarantine(spark, RAW_READINGS, folders["root"]).count() == 2


def test_batch_that_ran_without_being_committed_runs_again(spark, folders, tmp_path):
    land(spark, folders, (1, forecast(1.0, base=1)))
    ingest_raw(spark, folders)
    before = raw_view(spark, folders)
    # As after a crash between the write and the commit: same offsets, no commit file.
    crashed = tmp_path / "crashed"
    for source in (tmp_path / "checkpoint").rglob("*"):
        relative = source.relative_to(tmp_path / "checkpoint")
        if source.is_file() and relative.parts[0] != "commits":
            (crashed / relative).parent.mkdir(parents=True, exist_ok=True)
            (crashed / relative).write_bytes(source.read_bytes())
    ingest_raw(spark, folders | {"checkpoint": str(crashed)})
    assert raw_view(spark, folders) == before
    assert keyed.read_log(spark, RAW_READINGS, folders["root"]).count() == 1


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_enriched_stream_keeps_unmatched_and_bad_rows(spark, folders, max_bytes):
    names = spark.createDataFrame([(1.0, 15.5, "One", "Land")], NAMES)
    land(spark, folders, (1, forecast(1.0)), (2, forecast(2.0)), (3, "{bad"))
    query = ingest.enriched_stream(
        arriving(spark, folders), names, folders["root"], folders["checkpoint"], ingest.CATCH_UP, max_bytes
    )
    query.awaitTermination()
    rows = keyed.current_view(spark, ENRICHED_READINGS, folders["root"]).collect()
    assert [(row.city, row.country, row.latitude) for row in rows] == [("One", "Land", 1.0)]
    assert rows[0].overall_data.value_upm is None and rows[0].overall_data.pi == 16.0
    bad = keyed.quarantine(spark, ENRICHED_READINGS, folders["root"]).collect()
    assert sorted((row.reject_reason, row.latitude) for row in bad) == [("malformed", None), ("unmatched", 2.0)]


def test_stations_of_one_city_share_a_row(spark, folders):
    names = spark.createDataFrame([(1.0, 15.5, "One", "Land"), (1.1, 15.5, "One", "Land")], NAMES)
    land(spark, folders, (1, forecast(1.1, base=1)), (2, forecast(1.0, base=2)))
    ingest.enriched_stream(
        arriving(spark, folders), names, folders["root"], folders["checkpoint"], ingest.CATCH_UP
    ).awaitTermination()
    row = keyed.current_view(spark, ENRICHED_READINGS, folders["root"]).first()
    assert (row.latitude, row.particulate_matter.pi) == (1.0, 2.0)


@pytest.mark.parametrize("refreshed", [False, True])
def test_dictionary_is_frozen_or_refreshed(spark, folders, refreshed):
    loads = []
    current = [1]

    def save(*rows):
        spark.createDataFrame(list(rows), NAMES).write.mode("overwrite").parquet(folders["names"])

    def names(version=1):
        loads.append(version)
        return spark.read.parquet(folders["names"])

    save((1.0, 15.5, "Old", "Land"))
    land(spark, folders, (1, forecast(1.0, timestamp=3600)))
    query = ingest.enriched_stream(
        arriving(spark, folders),
        ingest.Versions(lambda: current[0], names) if refreshed else names(),
        folders["root"],
        folders["checkpoint"],
        {"processingTime": "0 seconds"},
    )
    try:
        query.processAllAvailable()
        # Another micro-batch of the same version does not read the dictionary.
        land(spark, folders, (2, forecast(1.0, timestamp=5400)))
        query.processAllAvailable()
        assert loads == [1]
        save((1.0, 15.5, "New", "Land"))
        current[0] = 2
        land(spark, folders, (3, forecast(1.0, timestamp=7200)))
        query.processAllAvailable()
    finally:
        query.stop()
    assert loads == ([1, 2] if refreshed else [1])
    rows = keyed.current_view(spark, ENRICHED_READINGS, folders["root"]).collect()
    assert {row.timestamp: row.city for row in rows} == {3600: "Old", 5400: "Old", 7200: "New" if refreshed else "Old"}


def test_log_can_be_read_before_the_first_batch(spark, folders):
    land(spark, folders, (1, forecast(1.0)))
    keyed.create_log(spark, RAW_READINGS, folders["root"])
    assert raw_view(spark, folders) == {}
    assert keyed.quarantine(spark, RAW_READINGS, folders["root"]).count() == 0
    ingest_raw(spark, folders)
    keyed.create_log(spark, RAW_READINGS, folders["root"])
    assert raw_view(spark, folders) == {1.0: 11.0}


def test_publish_stream(spark, folders):
    land(spark, folders, (1, "a"), (2, "b"))
    writer = streams.publish_stream(arriving(spark, folders), "text", folders["checkpoint"], folders["root"])
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(row.value for row in spark.read.text(folders["root"]).collect()) == ["a", "b"]


def test_kafka_rows_are_ordered_by_time_then_place(spark):
    rows = spark.createDataFrame(
        [(b"k", bytearray(b"{}"), "t", 3, 17, datetime(2024, 1, 1), 0)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT",
    )
    row = streams.kafka_messages(rows).first()
    assert row.value == "{}" and tuple(row.write_order) == (datetime(2024, 1, 1), 3, 17)


def test_topic_options(spark):
    options = streams.kafka_producer_options("a:1,b:2", "readings")
    assert options["kafka.acks"] == "all" and options["kafka.retries"] == "1" and options["topic"] == "readings"
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_stream(spark, "localhost:1", "readings")


def test_default_trigger_and_console(spark, folders):
    land(spark, folders, (1, "seen"))
    assert ingest.INTERVAL == {"processingTime": "3 seconds"}
    query = ingest.console(arriving(spark, folders).select("value"), 5).trigger(availableNow=True).start()
    ingest.run_until_stopped(query)
    assert query.lastProgress.numInputRows == 1
    assert "ConsoleTable" in query.lastProgress.sink.description
