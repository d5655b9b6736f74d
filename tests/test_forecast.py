import json

import pytest
from pyspark.sql import functions as F

from smogline.operators.forecast import accepted, parse_forecast, rejected, to_geo_columns, to_raw_columns
from tests.samples import forecast, plan


def parse(spark, *texts):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id INT, value STRING")
    return parse_forecast(rows)


def test_first_hour_of_a_good_payload(spark):
    row = parse(spark, forecast(timestamp=1700000000)).first()
    assert (row.latitude, row.longitude, row.timestamp) == (47.25, 15.5, 1700000000)
    assert row.PM.asDict() == {"value_upm": 11.5, "pi": 11.0, "aqi": 12.0, "aqi_cn": 13.0}
    assert row.overall.pi == 16.0
    assert row.reject_reason is None and row.payload is None


def test_later_hours_need_not_fit(spark):
    tree = json.loads(forecast(base=20))
    tree["hourly"][1] = {"timestamp": "soon", "avg": [1]}
    tree["hourly"].append(5)
    row = parse(spark, json.dumps(tree)).first()
    assert row.reject_reason is None and row.timestamp == 1700000000
    assert row.PM.asDict() == {"value_upm": 20.5, "pi": 20.0, "aqi": 21.0, "aqi_cn": 22.0}
    assert (row.latitude, row.longitude, row.overall.pi) == (47.25, 15.5, 25.0)
    # The hour that is read has to fit, and the text has to be JSON to its end.
    tree["hourly"][0]["avg"]["PM"]["pi"] = "many"
    assert parse(spark, json.dumps(tree)).first().reject_reason == "malformed"
    assert parse(spark, forecast()[:-1]).first().reject_reason == "malformed"


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("{bad", "malformed"),
        ("[1,2]", "malformed"),
        ('{"latitude":"x","longitude":2.0}', "malformed"),
        ('{"latitude":1.0,"longitude":2.0,"hourly":{}}', "malformed"),
        ('{"latitude":1.0}', "incomplete"),
        ('{"latitude":1.0,"longitude":2.0,"hourly":[]}', "incomplete"),
        ('{"latitude":1.0,"longitude":2.0,"hourly":[{}]}', "incomplete"),
        ('{"latitude":1.0,"longitude":2.0,"hourly":[{"timestamp":1e300}]}', "incomplete"),
        ("", "incomplete"),
        (None, "incomplete"),
    ],
)
def test_rejects_keep_the_whole_text(spark, text, reason):
    row = parse(spark, text).first()
    assert (row.reject_reason, row.payload) == (reason, text)


def test_split_loses_no_row(spark):
    rows = parse(spark, forecast(), "{bad", None, forecast())
    assert [row.id for row in accepted(rows).orderBy("id").collect()] == [0, 3]
    assert [row.id for row in rejected(rows).orderBy("id").collect()] == [1, 2]


def test_missing_pollutant_is_null(spark):
    row = to_geo_columns(parse(spark, forecast(without=("PM", "O3")))).first()
    assert row.particulate_matter is None and row.ozone_data is None
    assert row.reject_reason is None and row.nitrous_data.pi == 12.0


def test_unmeasured_field_is_nulled_in_the_enriched_columns_only(spark):
    rows = parse(spark, forecast())
    raw, geo = to_raw_columns(rows).first(), to_geo_columns(rows).first()
    assert raw.overall_data.value_upm == 16.5 and raw.pm_data.value_upm == 11.5
    assert geo.overall_data.value_upm is None and geo.particulate_matter.value_upm is None
    assert geo.overall_data.pi == 16.0 and geo.ozone_data.value_upm == 15.5


def test_other_fields_are_ignored(spark):
    assert parse(spark, forecast(extra={"a": [1]})).first().reject_reason is None


def test_filters_do_not_parse_twice(spark):
    rows = accepted(parse(spark, forecast())).filter(F.col("latitude") > 0)
    assert plan(rows).count("from_json(") == plan(parse(spark, forecast())).count("from_json(")
    assert "EvalPython" not in plan(rows) and "MapInPandas" not in plan(rows)
