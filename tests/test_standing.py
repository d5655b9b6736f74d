"""Chosen dictionary versions, later names for unmatched rows, and two tables from one parse."""

import pytest
from pyspark.errors import StreamingQueryException

from smogline.operators.forecast import parse_forecast, to_raw_columns
from smogline.schemas import ENRICHED_READINGS, GEO_DICTIONARY, RAW_READINGS
from smogline.sources import files, keyed, tables
from smogline.streaming import ingest
from tests.samples import forecast, plan
from tests.test_streaming import NAMES, arriving, folders, land  # noqa: F401


def place(latitude, city):
    return (latitude, 15.5, city, "x", "Land", None, None)


def publish(spark, folders, version, *rows):
    tables.replace_table(tables.fixture(spark, list(rows), GEO_DICTIONARY), GEO_DICTIONARY, folders["names"], version)
    return ingest.dictionary_versions(spark, folders["names"])


def cities(spark, root):
    return {row.timestamp: row.city for row in keyed.current_view(spark, ENRICHED_READINGS, root).collect()}


def test_a_choice_is_made_once(spark, folders):
    root, versions = folders["root"], iter((7, 8, 9))
    assert [ingest.chosen_version(spark, root, batch, lambda: next(versions)) for batch in (0, 0, 1, 0)] == [7, 7, 8, 7]
    # A record that was cut off counts for nothing.
    files.write_text(spark, f"{root}/{keyed.CHOICES}/2", "1")
    assert ingest.chosen_version(spark, root, 2, lambda: next(versions)) == 9


def test_a_batch_runs_again_under_its_first_version(spark, folders, monkeypatch):
    versions = publish(spark, folders, 1, place(1.0, "Old"))
    land(spark, folders, (1, forecast(1.0, timestamp=3600)))

    def run():
        ingest.enriched_stream(arriving(spark, folders), versions, folders["root"], folders["checkpoint"], ingest.CATCH_UP).awaitTermination()

    with monkeypatch.context() as broken:
        broken.setattr(ingest, "write_batch", lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run()
    publish(spark, folders, 2, place(1.0, "New"))
    run()
    land(spark, folders, (2, forecast(1.0, timestamp=7200)))
    run()
    assert cities(spark, folders["root"]) == {3600: "Old", 7200: "New"}


def test_unmatched_rows_get_the_names_that_came_later(spark, folders):
    root = folders["root"]
    versions = publish(spark, folders, 1, place(1.0, "One"))
    messages = [(i, forecast(float(i % 4), timestamp=3600 * i)) for i in range(12)]
    land(spark, folders, *messages, (99, "{bad"), (100, forecast(2.0, timestamp=3600 * 2, base=50)))
    ingest.enriched_stream(arriving(spark, folders), versions, root, folders["checkpoint"], ingest.CATCH_UP).awaitTermination()
    assert set(cities(spark, root).values()) == {"One"}
    publish(spark, folders, 2, place(1.0, "Uno"), place(2.0, "Two"), place(7.0, "Seven"))
    for _ in range(2):
        assert ingest.enrich_unmatched(spark, versions, root, 1, 2) == 2
        # The name of a place that was known stays, and only new ones were written.
        assert cities(spark, root) == {3600 * i: "One" if i % 4 == 1 else "Two" for i in range(12) if i % 4 in (1, 2)}
    written = keyed.read_batch(spark, ENRICHED_READINGS, root, keyed.CORRECTIONS + 2).collect()
    assert sorted(row.timestamp // 3600 for row in written) == [2, 2, 6, 10] and {row.city for row in written} == {"Two"}
    # The last message of a reading stays the last, and later ones go before.
    view = keyed.current_view(spark, ENRICHED_READINGS, root)
    assert view.filter("timestamp = 7200").first().particulate_matter.pi == 50.0
    land(spark, folders, (200, forecast(2.0, timestamp=3600 * 6, base=70)))
    ingest.enriched_stream(arriving(spark, folders), versions, root, folders["checkpoint"], ingest.CATCH_UP).awaitTermination()
    for _ in range(2):
        keyed.compact(spark, ENRICHED_READINGS, root)
        keyed.expire(spark, root, grace_seconds=0)
        view = keyed.current_view(spark, ENRICHED_READINGS, root)
        assert view.count() == 6 and view.filter("timestamp = 21600").first().particulate_matter.pi == 70.0
    publish(spark, folders, 3, place(1.0, "Uno"), place(2.0, "Two"), place(7.0, "Seven"), place(3.0, "Three"))
    assert ingest.enrich_unmatched(spark, versions, root, 2, 3) == 1
    keyed.compact(spark, ENRICHED_READINGS, root)
    assert set(cities(spark, root).values()) == {"One", "Two", "Three"} and len(cities(spark, root)) == 9
    assert ingest.enrich_unmatched(spark, versions, root, 3, 3) == 0


def run_both(spark, folders, names):
    query = ingest.both_tables(
        arriving(spark, folders), names, folders["root"] + "/raw", folders["root"] + "/geo", folders["checkpoint"], ingest.CATCH_UP
    )
    query.awaitTermination()


def tables_of(spark, folders):
    root = folders["root"]
    raw = keyed.current_view(spark, RAW_READINGS, root + "/raw").count()
    return raw, len(cities(spark, root + "/geo"))


@pytest.mark.parametrize("fault", ["stage", "publish"])
def test_two_tables_show_a_batch_together(spark, folders, monkeypatch, fault):
    names = spark.createDataFrame([(1.0, 15.5, "One", "Land")], NAMES)
    land(spark, folders, (1, forecast(1.0)), (2, forecast(2.0)), (3, "{bad"))
    with monkeypatch.context() as broken:
        calls = []
        real = getattr(ingest, f"{fault}_batch")

        def fails(*arguments):
            calls.append(1)
            return real(*arguments) if len(calls) < (2 if fault == "stage" else 1) else 1 / 0

        broken.setattr(ingest, f"{fault}_batch", fails)
        with pytest.raises(StreamingQueryException):
            run_both(spark, folders, names)
    assert tables_of(spark, folders) == (0, 0)
    run_both(spark, folders, names)
    assert tables_of(spark, folders) == (2, 1)
    bad = keyed.quarantine(spark, ENRICHED_READINGS, folders["root"] + "/geo").collect()
    assert sorted((row.reject_reason, row.latitude, row.payload) for row in bad) == [("malformed", None, "{bad"), ("unmatched", 2.0, None)]


def test_two_tables_equal_two_streams_and_one_parse_serves_both(spark, folders):
    names = spark.createDataFrame([(float(i), 15.5, f"City {i}", "Land") for i in range(3)], NAMES)
    land(spark, folders, *((i, forecast(float(i % 5), timestamp=3600 * i, base=i)) for i in range(20)), (50, "{bad"))
    run_both(spark, folders, names)
    apart = folders["root"] + "/apart"
    query = ingest.enriched_stream(arriving(spark, folders), names, apart, folders["checkpoint"] + "2", ingest.CATCH_UP)
    query.awaitTermination()
    views = [keyed.current_view(spark, ENRICHED_READINGS, root) for root in (apart, folders["root"] + "/geo")]
    assert views[0].exceptAll(views[1]).isEmpty() and views[1].exceptAll(views[0]).isEmpty() and views[0].count() == 12
    raw = to_raw_columns(parse_forecast(arriving(spark, folders)))
    parses = raw._jdf.queryExecution().analyzed().toString().count("from_json")
    assert parses > 0
    stored = ingest.geo_rows(keyed.read_batch(spark, RAW_READINGS, folders["root"] + "/raw", 0))
    assert "from_json" not in plan(stored).lower() and "jsontostructs" not in plan(stored).lower()
