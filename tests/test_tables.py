import pytest

from smogline import scratch
from smogline.plans import lens
from smogline.plans.jobs import publish_forecasts
from smogline.schemas import ENRICHED_READINGS, RAW_READINGS, STATIONS
from smogline.sources import streams, tables


def test_reader_takes_any_format(spark, tmp_path):
    rows = tables.fixture(spark, [(1.0, 2.0), (3.0, 4.0)], STATIONS)
    rows.write.option("header", True).csv(str(tmp_path / "csv"))
    rows.write.orc(str(tmp_path / "orc"))
    read = tables.read_table(spark, str(tmp_path / "csv"), "csv", header="true", inferSchema="true")
    assert sorted(read.collect()) == sorted(rows.collect())
    assert sorted(tables.read_table(spark, str(tmp_path / "orc"), "orc").collect()) == sorted(rows.collect())
    assert tables.count_rows(rows, "n").first().n == 2


def test_sample_and_preview(spark, capsys):
    rows = tables.fixture(spark, [(float(i), 0.0) for i in range(9)], STATIONS)
    assert tables.sample(rows).count() == 5
    assert [row.lat for row in tables.sample(rows, 2, "lat").collect()] == [0.0, 1.0]
    tables.preview(rows, 1)
    assert "only showing top 1 row" in capsys.readouterr().out


@pytest.mark.parametrize("table", [RAW_READINGS, ENRICHED_READINGS, STATIONS])
def test_create_if_absent(spark, tmp_path, table):
    place = str(tmp_path / table.name)
    assert table.create_if_absent(spark, place) == table.name
    try:
        spark.sql(f"INSERT INTO {table.name} ({table.key[0]}) VALUES (NULL)")
        table.create_if_absent(spark, place)
        assert spark.table(table.name).count() == 1
        assert spark.table(table.name).columns == list(table.columns)
    finally:
        spark.sql(f"DROP TABLE {table.name}")


def test_version_can_be_derived_from_the_one_before(spark, tmp_path):
    root = str(tmp_path / "stations")
    tables.replace_table(tables.fixture(spark, [(1.0, 2.0), (3.0, 4.0)], STATIONS), STATIONS, root, 9)
    old = tables.read_version(spark, STATIONS, root)
    tables.replace_table(old.filter("lat > 2"), STATIONS, root, 10)
    assert [row.lat for row in tables.read_version(spark, STATIONS, root).collect()] == [3.0]
    assert old.count() == 2 and tables.latest_version(spark, root) == 10


def test_published_text(spark, tmp_path):
    stations = tables.fixture(spark, [(47.25, 15.5)], STATIONS)
    path = str(tmp_path / "sent")
    publish_forecasts(stations, lambda keys: keys["request"].str.upper(), "lat={lat}&lon={lon}", "text", path)
    assert [row.value for row in spark.read.text(path).collect()] == ["LAT=47.25&LON=15.5"]
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.publish_to_kafka(spark.read.text(path), "localhost:1", "readings")


def test_scratch_follows_the_session(spark, tmp_path):
    folder = scratch.new_folder(spark, "x")
    assert folder.startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    assert folder != scratch.new_folder(spark, "x")


def test_small_tables_use_all_cores(spark):
    rows = spark.range(10).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert lens.spread(rows).rdd.getNumPartitions() == cores
    wide = spark.range(0, 10, 1, cores + 1)
    assert lens.spread(wide) is wide


def test_unfinished_version_is_not_chosen(spark, tmp_path):
    root = tmp_path / "stations"
    with pytest.raises(ValueError, match="no finished version"):
        tables.latest_version(spark, str(root))
    for version in (1, 2):
        tables.replace_table(tables.fixture(spark, [(float(version), 0.0)], STATIONS), STATIONS, str(root), version)
    (root / "version=2" / "_SUCCESS").unlink()
    assert [row.lat for row in tables.read_version(spark, STATIONS, str(root)).collect()] == [1.0]


def test_stations_without_an_answer_are_counted(spark, tmp_path):
    stations = tables.fixture(spark, [(1.5, 2.5), (3.5, 4.5)], STATIONS)
    path = str(tmp_path / "sent")
    missing = publish_forecasts(
        stations, lambda keys: [None if "1.5" in key else key for key in keys["request"]], "{lat},{lon}", "text", path
    )
    assert missing == 1 and [row.value for row in spark.read.text(path).collect()] == ["3.5,4.5"]
