import decimal

import pytest

from smogline.functions.coordinates import address_request, coord_key, coordinate_request


@pytest.mark.parametrize(
    ("degrees", "key"),
    [
        (47.25, "47.25"),
        (-122.4194155, "-122.41942"),
        # The double nearest to 0.123455 lies below the tie, the one nearest to 1.000005 above.
        (0.123455, "0.12345"),
        (1.000005, "1.00001"),
        (-0.000001, "0"),
        (0.0, "0"),
        (179.999999, "180"),
        (123456.0, None),
        (float("nan"), None),
        (float("inf"), None),
        (None, None),
    ],
)
def test_key(spark, degrees, key):
    row = spark.createDataFrame([(degrees,)], "x DOUBLE").select(coord_key("x").alias("key")).first()
    assert row.key == (None if key is None else decimal.Decimal(key))


def test_key_agrees_with_exact_decimal_rounding(spark):
    # Within 0.00001 of zero the formatter gives 0 for anything up to its tie; see the next test.
    values = [i * 0.7312345 - 180 for i in range(500)] + [i / 1e6 for i in range(10, 3000, 5)]
    exact = [
        decimal.Decimal(value).quantize(decimal.Decimal("0.00001"), rounding=decimal.ROUND_HALF_EVEN)
        for value in values
    ]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i INT, x DOUBLE")
    found = {row.i: row.key for row in rows.select("i", coord_key("x").alias("key")).collect()}
    assert [found[i] for i in range(len(values))] == exact


def test_tie_next_to_zero_is_zero(spark):
    rows = spark.createDataFrame([(0.000005,), (-0.000005,), (0.0000051,)], "x DOUBLE")
    keys = [row.key for row in rows.select(coord_key("x").alias("key")).collect()]
    assert keys == [decimal.Decimal(0), decimal.Decimal(0), decimal.Decimal("0.00001")]


def test_requests(spark):
    rows = spark.createDataFrame([(47.25, 15.5, "Buenos+Aires+ARGENTINA")], "lat DOUBLE, lon DOUBLE, entry STRING")
    row = rows.select(
        coordinate_request("lat", "lon", "json?latlng={lat},{lon}").alias("a"),
        address_request("entry", "json?address={address}").alias("b"),
    ).first()
    assert row.a == "json?latlng=47.25,15.5"
    assert row.b == "json?address=Buenos+Aires+ARGENTINA"
