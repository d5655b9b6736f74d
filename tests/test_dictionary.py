import json
import uuid

import pandas as pd
import pytest

from smogline.operators.dictionary import (
    bad_responses,
    build_dictionary,
    by_rounded_key,
    distinct_coords,
    forward_geocode,
    geocode_results,
    lookup_keys,
    lookup_saved,
)
from smogline.plans.jobs import locate_cities, refresh_dictionary
from smogline.sources.tables import read_version
from smogline.schemas import GEO_DICTIONARY
from tests.samples import response, result


def responses(spark, *texts):
    rows = [(float(i), -float(i), text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "latitude DOUBLE, longitude DOUBLE, response STRING")


def test_locality_results_only(spark):
    text = response(
        result("Champ de Mars, 75007 Paris, France", "street_address"),
        result("Paris, France", "locality", "political"),
        result("France", "country"),
    )
    row = geocode_results(responses(spark, text)).first()
    assert (row.result_pos, row.city, row.locality, row.country) == (1, "Paris", "Paris, France", "France")
    assert json.loads(row.geometry) == {"location": {"lat": 1.5, "lng": 2.5}, "location_type": "APPROXIMATE"}
    assert row.rawgeo == text


@pytest.mark.parametrize(
    ("address", "city", "country"),
    [
        ("Paris, France", "Paris", " France"),
        ("Singapore", "Singapore", "Singapore"),
        ("Graz, Styria, Austria,,", "Graz", " Austria"),
        (", Nowhere", "", " Nowhere"),
        ("", "", ""),
    ],
)
def test_address_parts(spark, address, city, country):
    row = build_dictionary(responses(spark, response(result(address, "locality"))), trim=False).first()
    assert (row.city, row.country) == (city, country)
    trimmed = build_dictionary(responses(spark, response(result(address, "locality")))).first()
    assert trimmed.country == country.strip()


def test_last_locality_wins_and_rejects_are_reported(spark):
    rows = responses(
        spark,
        response(result("A, X", "locality"), result("B, Y", "locality")),
        response(result("C, Z", "country")),
        response(),
        "{bad",
        None,
        '{"status":"OVER_QUERY_LIMIT"}',
    )
    assert [(row.latitude, row.city) for row in build_dictionary(rows).collect()] == [(0.0, "B")]
    assert geocode_results(rows).count() == 2
    reasons = {row.latitude: row.reject_reason for row in bad_responses(rows).collect()}
    assert reasons == {1.0: "no_locality", 2.0: "no_locality", 3.0: "malformed", 4.0: "malformed", 5.0: "malformed"}


def test_responses_are_accepted_or_rejected_never_both(spark):
    wrong_type = response(result("A, X", "locality"))[: -len(', "status": "OK"}') - 1] + ', {"types": 7}]}'
    rows = responses(
        spark,
        response(result("A, X", "locality")),
        wrong_type,
        response(result(None, "locality")),
        response(result(None, "locality"), result("B, Y", "locality"), result(None, "locality")),
        "{bad",
        None,
        "[]",
    ).unionByName(
        spark.createDataFrame([(None, 2.0, response(result("A, X", "locality")))], "latitude DOUBLE, longitude DOUBLE, response STRING")
    )
    accepted = {row.latitude: row.city for row in build_dictionary(rows).collect()}
    rejected = {row.latitude: row.reject_reason for row in bad_responses(rows).collect()}
    assert accepted == {0.0: "A", 3.0: "B"}
    assert rejected == {
        1.0: "malformed", 2.0: "no_address", 4.0: "malformed", 5.0: "malformed", 6.0: "malformed", None: "incomplete"
    }


def test_short_answer_is_an_error(spark):
    keys = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "latitude DOUBLE").coalesce(1)
    with pytest.raises(Exception, match="1 texts came back for 3 keys"):
        lookup_keys(keys, lambda batch: pd.Series(["only"])).collect()
    # Texts are taken in order, whatever their labels.
    shuffled = lookup_keys(keys, lambda batch: pd.Series(["a", "b", "c"], index=[2, 0, 1])).collect()
    assert [(row.latitude, row.response) for row in shuffled] == [(1.0, "a"), (2.0, "b"), (3.0, "c")]


def test_rounded_duplicates_keep_the_greatest_coordinate(spark):
    rows = spark.createDataFrame(
        [
            (1.0000001, 2.0, "low", "L"),
            (1.0000004, 2.0, "high", "H"),
            (1.0000004, 1.9999999, "west", "W"),
            (5.0, 5.0, "other", "O"),
            (None, 5.0, "lost", "N"),
        ],
        "latitude DOUBLE, longitude DOUBLE, city STRING, country STRING",
    )
    found = {(float(r.lat_key), float(r.lon_key)): (r.city, r.country) for r in by_rounded_key(rows).collect()}
    assert found == {(1.0, 2.0): ("high", "H"), (5.0, 5.0): ("other", "O")}


def _name(keys: pd.DataFrame) -> pd.Series:
    texts = [response(result(f"City {lat:g}, Land", "locality")) for lat in keys["latitude"]]
    return pd.Series(texts, index=keys.index)


def test_lookups(spark):
    readings = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0)], "latitude DOUBLE, longitude DOUBLE")
    keys = distinct_coords(readings)
    assert keys.count() == 2
    found = lookup_keys(keys, _name, parallelism=3)
    assert found.rdd.getNumPartitions() == 3
    assert sorted(row.city for row in build_dictionary(found).collect()) == ["City 1", "City 3"]
    saved = spark.createDataFrame([(1.0, 2.0, "text")], "latitude DOUBLE, longitude DOUBLE, response STRING")
    joined = lookup_saved(keys, saved, ["latitude", "longitude"])
    assert sorted((row.latitude, row.response) for row in joined.collect()) == [(1.0, "text"), (3.0, None)]


def test_refresh_replaces_the_dictionary(spark, tmp_path):
    root = str(tmp_path / "dictionary")
    old = spark.createDataFrame([(1.0, 2.0), (9.0, 9.0)], "latitude DOUBLE, longitude DOUBLE")
    new = spark.createDataFrame([(1.0, 2.0)], "latitude DOUBLE, longitude DOUBLE")
    first = refresh_dictionary(old, _name, root, 1)
    refresh_dictionary(new, _name, root, 2)
    assert read_version(spark, GEO_DICTIONARY, root).count() == 1
    assert first.count() == 2
    # A refresh that finds nothing empties the table.
    refresh_dictionary(new.limit(0), _name, root, 3)
    assert read_version(spark, GEO_DICTIONARY, root).count() == 0


def test_refresh_asks_once_per_coordinate(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(keys: pd.DataFrame) -> pd.Series:
        for lat in keys["latitude"]:
            (asked / f"{lat}-{uuid.uuid4().hex}").touch()
        return _name(keys)

    rows = [(float(i % 40), 1.0) for i in range(400)]
    readings = spark.createDataFrame(rows, "latitude DOUBLE, longitude DOUBLE")
    assert refresh_dictionary(readings, fetch, str(tmp_path / "dictionary"), 1, parallelism=4).count() == 40
    # The range partitioner's sampling reads shuffled rows and does not ask again.
    assert len(list(asked.iterdir())) == 40


def test_forward_geocode_takes_the_first_result(spark):
    rows = spark.createDataFrame(
        [
            ("a", response(result("A", lat=1.0, lng=2.0), result("B", lat=3.0, lng=4.0))),
            ("whole", response(result("W", lat=5, lng=6))),
            ("none", response()),
            ("bad", "{"),
        ],
        "address STRING, response STRING",
    )
    found = {row.address: (row.lat, row.lon) for row in forward_geocode(rows).collect()}
    assert found == {"a": (1.0, 2.0), "whole": (5.0, 6.0), "none": (None, None), "bad": (None, None)}


def test_locate_cities(spark):
    def fetch(keys: pd.DataFrame) -> pd.Series:
        return keys["request"].map(lambda request: response(result(request, lat=float(len(request)), lng=0.5)))

    entries = spark.createDataFrame([("Graz+AUSTRIA",)], "entry STRING")
    row = locate_cities(entries, fetch, "q={address}").first()
    assert (row.entry, row.lat, row.lon) == ("Graz+AUSTRIA", 14.0, 0.5)
