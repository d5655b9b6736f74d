"""Dictionaries that grow, lookups that fail, an outbox, SQL functions and the health of streams."""

import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from smogline.functions import addresses, jsonpath, sqlnames
from smogline.functions.coordinates import coord_key
from smogline.operators.dictionary import NO_ANSWER, TOO_LATE, Limits, lookup_each, unknown_coords
from smogline.plans import jobs
from smogline.schemas import RAW_READINGS
from smogline.sources import keyed
from smogline.streaming import health, ingest
from tests.samples import forecast, plan, response, result
from tests.test_streaming import arriving, folders, land  # noqa: F401

PLACES = "latitude DOUBLE, longitude DOUBLE"


class Geocoder:
    """Answers by latitude, and keeps who asked in files, as it runs in other processes."""

    def __init__(self, folder, answers):
        self.folder, self.answers = str(folder), answers
        folder.mkdir()

    def __call__(self, keys: pd.DataFrame) -> pd.Series:
        for lat in keys["latitude"]:
            open(f"{self.folder}/{lat:g}-{uuid.uuid4().hex}", "w").close()
        return pd.Series([self.answers.get(lat, response(result(f"City {lat:g}, Land", "locality"))) for lat in keys["latitude"]], index=keys.index)


def asked(geocoder):
    import os

    return sorted(float(name.split("-")[0]) for name in os.listdir(geocoder.folder))


def test_a_second_run_asks_for_new_places_only(spark, tmp_path):
    root = str(tmp_path / "dictionary")
    first = Geocoder(tmp_path / "first", {2.0: "{broken", 3.0: response(result("Land", "country")), 4.0: None})
    jobs.extend_dictionary(spark.createDataFrame([(float(i), 0.5) for i in range(5)] * 3, PLACES), first, root, 1)
    assert asked(first) == [0, 1, 2, 3, 4]
    reasons = {row.latitude: (row.reject_reason, row.payload) for row in jobs.rejected_responses(spark, root).collect()}
    assert reasons[2.0] == ("malformed", "{broken") and reasons[3.0][0] == "no_locality" and reasons[4.0] == ("malformed", None)
    # What was malformed or did not come is asked for again; what has no town is not.
    second = Geocoder(tmp_path / "second", {4.0: "{still"})
    found = jobs.extend_dictionary(spark.createDataFrame([(float(i), 0.5) for i in range(7)], PLACES), second, root, 2)
    assert asked(second) == [2, 4, 5, 6]
    assert sorted(row.city for row in found.collect()) == ["City 0", "City 1", "City 2", "City 5", "City 6"]
    reasons = {row.latitude: row.payload for row in jobs.rejected_responses(spark, root).collect()}
    assert reasons == {3.0: reasons[3.0], 4.0: "{still"}
    # Running the same version again gives the same; the version before is still there.
    third = Geocoder(tmp_path / "third", {})
    again = jobs.extend_dictionary(spark.createDataFrame([(5.0, 0.5), (2.0, 0.5)], PLACES), third, root, 2)
    assert asked(third) == [2, 5] and again.count() == 4 and jobs.rejected_responses(spark, root, 1).count() == 3
    patient = Geocoder(tmp_path / "patient", {})
    kept = jobs.extend_dictionary(spark.createDataFrame([(4.0, 0.5)], PLACES), patient, root, 3, again=())
    assert asked(patient) == [] and kept.count() == 4


@pytest.mark.parametrize("most", [1 << 20, -1])
def test_known_places_are_left_out(spark, most):
    readings = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0), (5.0, 6.0)], PLACES)
    known = spark.createDataFrame([(3.0, 4.0, "x")], PLACES + ", city STRING")
    new = unknown_coords(readings, known, most)
    assert sorted(row.latitude for row in new.collect()) == [1.0, 5.0]
    assert ("BroadcastHashJoin" in plan(new)) == (most > 0) or most < 0


def test_failing_and_slow_requests_disturb_nobody(spark):
    def ask(row):
        if row["id"] == 3:
            raise ValueError("no")
        if row["id"] == 5:
            time.sleep(60)
        if row["id"] == 7:
            return None
        time.sleep(0.05)
        return f"text {row['id']}"

    keys = spark.range(20).coalesce(1)
    start = time.monotonic()
    rows = lookup_each(keys, ask, limits=Limits(at_once=8, tries=2, seconds=1.5, pause=0.01)).collect()
    assert time.monotonic() - start < 20
    assert [row.id for row in rows] == list(range(20))
    reasons = {row.id: row.response_failure for row in rows if row.response is None}
    assert reasons == {3: "failed: no", 5: TOO_LATE, 7: NO_ANSWER}
    assert all(row.response == f"text {row.id}" and row.response_failure is None for row in rows if row.id not in reasons)


def test_a_second_try_may_succeed_and_requests_keep_their_pace(spark, tmp_path):
    place = str(tmp_path)

    def ask(row):
        import os

        mark = f"{place}/{row['id']}"
        if row["id"] % 2 and not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("first time")
        return str(time.time())

    rows = lookup_each(spark.range(8).coalesce(1), ask, limits=Limits(at_once=4, per_second=20, pause=0.01)).collect()
    times = sorted(float(row.response) for row in rows)
    assert len(times) == 8 and times[-1] - times[0] >= 7 / 20 - 0.1


def forecasts(keys: pd.DataFrame) -> pd.Series:
    return pd.Series([None if "3.0" in text else f"sent {text}" for text in keys["request"]], index=keys.index)


def test_each_station_of_a_run_is_sent_once(spark, tmp_path):
    root, path, checkpoint = (str(tmp_path / name) for name in ("box", "sent", "checkpoint"))
    stations = spark.createDataFrame([(float(i), 0.5) for i in range(6)], "lat DOUBLE, lon DOUBLE").repartition(3)

    def send():
        jobs.send_outbox(spark, root, "text", checkpoint, path).awaitTermination()
        return sorted(row.value for row in spark.read.text(path).collect())

    # A fetch that stopped half way leaves nothing that is sent.
    (tmp_path / "box/outbox").mkdir(parents=True)
    stations.selectExpr("lat", "lon", "'half' AS value").write.parquet(f"{root}/staged/run=a")
    send()
    rows = jobs.fill_outbox(stations, forecasts, "{lat}/{lon}", root, "a")
    assert rows.count() == 6 and rows.filter("value IS NULL").count() == 1
    once = [f"sent {i}.0/0.5" for i in (0, 1, 2, 4, 5)]
    assert send() == send() == once
    jobs.fill_outbox(stations, lambda keys: 1 / 0, "{lat}/{lon}", root, "a")
    assert send() == once
    jobs.fill_outbox(stations, forecasts, "{lat}/{lon}", root, "b")
    assert send() == sorted(once * 2)


def test_sql_functions_are_the_column_forms(spark):
    names = sqlnames.register_functions(spark, "t_")
    assert len(names) == len(sqlnames.FUNCTIONS)
    rows = [(1, "Graz, Styria, Austria", 47.0707149, '{"a": {"b": 2}, "c": "x"}'), (2, "Graz,,", -0.0, "[1, 2, 3]"), (3, None, None, None), (4, "AUSTRIA", 1e9, "{bad")]
    frame = spark.createDataFrame(rows, "n INT, address STRING, degrees DOUBLE, body STRING")
    frame.createOrReplaceTempView("t_rows")
    found = spark.sql(
        "SELECT n, t_coord_key(degrees) k, t_city_of(address) c, t_country_of(address) d, t_is_header(address) h,"
        " t_plus_joined(address, body) p, t_json_text(body, '$.a.b') j, t_json_length(body) l FROM t_rows"
    )
    columns = frame.select(
        "n", coord_key("degrees"), addresses.city_of("address"), addresses.country_of("address"), addresses.is_header("address"),
        addresses.plus_joined("address", "body"), jsonpath.get("body", "$.a.b"), jsonpath.length("body"),
    )
    assert [tuple(row) for row in found.orderBy("n").collect()] == [tuple(row) for row in columns.orderBy("n").collect()]
    text = plan(found.filter("t_city_of(address) = 'Graz'"))
    assert "EvalPython" not in text and "InPandas" not in text and "t_city_of" not in text


def test_a_listener_counts_what_the_log_holds(spark, folders):  # noqa: F811
    told = []
    seen = health.Health(told.append)
    spark.streams.addListener(seen)
    try:
        for wave in range(2):
            now = int(time.time())
            land(spark, folders, *((i, forecast(float(i), timestamp=now - 100 + i)) for i in range(4)), (9, "{bad"))
            ingest.raw_ingest(arriving(spark, folders), folders["root"], folders["checkpoint"], ingest.CATCH_UP).awaitTermination()
        for _ in range(100):
            if len({found.batch_id for found in seen.seen}) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    log = keyed.read_log(spark, RAW_READINGS, folders["root"])
    assert seen.totals() == (log.count(), log.filter(F.col("reject_reason").isNotNull()).count()) == (10, 2)
    assert told and told[0].rejected_share == 0.2 and 50 < told[0].lag_seconds < 400


def test_a_stop_waits_for_the_running_batch(spark, folders):  # noqa: F811
    land(spark, folders, *((i, forecast(float(i))) for i in range(5)))
    query = ingest.raw_ingest(arriving(spark, folders), folders["root"], folders["checkpoint"], {"processingTime": "0 seconds"})
    query.processAllAvailable()
    assert health.stop_between_batches(query, 30) and not query.isActive
    assert query.exception() is None and keyed.current_view(spark, RAW_READINGS, folders["root"]).count() == 5

    class Busy:
        isActive, status = True, {"isTriggerActive": True}

        def stop(self):
            raise AssertionError

    assert not health.stop_between_batches(Busy(), 0.1)
