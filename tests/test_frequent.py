"""Busy stations from a sketch, and scratch folders that are removed."""

from pathlib import Path

from smogline.operators.dictionary import by_rounded_key
from smogline.operators.enrich import enrich_by_key
from smogline.operators.forecast import parse_forecast, to_geo_columns
from smogline.operators.frequent import FrequentStations
from smogline.schemas import ENRICHED_READINGS
from smogline.scratch import cleared, new_folder
from smogline.sources import keyed
from smogline.streaming import ingest
from tests.samples import forecast, plan
from tests.test_streaming import NAMES, arriving, folders, land  # noqa: F401


def test_the_sketch_is_merged_over_batches(spark, tmp_path):
    stations = FrequentStations(spark, str(tmp_path))
    assert stations.before(0, 5).count() == 0

    def rows(*counts):
        return spark.createDataFrame([(float(lat), 15.5) for lat, n in counts for _ in range(n)] + [(None, 1.0)], "latitude DOUBLE, longitude DOUBLE")

    stations.add(0, rows((1, 50), (2, 10), (3, 1)))
    stations.add(1, rows((2, 100), (4, 20)))
    stations.add(1, rows((2, 100), (4, 20)))
    top = [[float(row.lat_key) for row in stations.before(batch, 2).collect()] for batch in (1, 2)]
    assert sorted(top[0]) == [1.0, 2.0] and sorted(top[1]) == [1.0, 2.0]
    assert sorted(float(row.lat_key) for row in stations.before(2, 3).collect()) == [1.0, 2.0, 4.0]
    for batch in range(2, 8):
        stations.add(batch, rows((9, 1)))
    assert len(list((tmp_path / "frequent").iterdir())) == 3


def test_readings_are_parsed_once_if_stations_are_known(spark, tmp_path):
    texts = spark.createDataFrame([(forecast(float(i % 3)),) for i in range(9)], "value STRING")
    parsed = to_geo_columns(parse_forecast(texts))
    lookup = by_rounded_key(spark.createDataFrame([(1.0, 15.5, "One", "Land")], NAMES))
    stations = FrequentStations(spark, str(tmp_path))
    stations.add(0, parsed)
    known = enrich_by_key(parsed, lookup, False, stations.before(1, 4))
    counted = enrich_by_key(parsed, lookup, False)
    parses = [plan(frame).lower().count("from_json") for frame in (parsed, known, counted)]
    assert parses[1] == parses[0] < parses[2]
    assert sorted(row.city or "" for row in known.collect()) == sorted(row.city or "" for row in counted.collect()) == [""] * 6 + ["One"] * 3


def test_a_stream_learns_its_busy_stations(spark, folders):  # noqa: F811
    names = spark.createDataFrame([(1.0, 15.5, "One", "Land")], NAMES)
    for wave in range(3):
        land(spark, folders, *((10 * wave + i, forecast(float(i % 2), timestamp=3600 * (wave * 10 + i))) for i in range(6)))
        ingest.enriched_stream(arriving(spark, folders), names, folders["root"], folders["checkpoint"], ingest.CATCH_UP, 0).awaitTermination()
    assert keyed.current_view(spark, ENRICHED_READINGS, folders["root"]).count() == 9
    top = FrequentStations(spark, folders["root"]).before(3, 10).collect()
    assert {float(row.lat_key) for row in top} == {0.0, 1.0}


def test_a_run_takes_its_tables_along(spark, tmp_path):
    target = str(tmp_path / "result")
    with cleared(spark) as run:
        place = new_folder(spark, "inside")
        assert place.startswith(run)
        spark.range(5).write.parquet(place)
        with cleared(spark) as inner:
            spark.range(3).write.parquet(new_folder(spark, "deeper"))
        assert inner.startswith(run) and not Path(inner).exists()
        spark.read.parquet(place).write.parquet(target)
    assert not Path(run).exists() and spark.read.parquet(target).count() == 5
    assert not new_folder(spark, "after").startswith(run)
    try:
        with cleared(spark) as run:
            spark.range(5).write.parquet(new_folder(spark, "inside"))
            raise ValueError
    except ValueError:
        assert not Path(run).exists()
