"""Every operator as a query over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smogline.functions import jsonpath, sqlnames
from smogline.functions.coordinates import address_request, coord_key
from smogline.functions.pollutants import flat_fields
from smogline.operators import cities, dictionary, latest
from smogline.operators.enrich import enrich
from smogline.operators.forecast import (
    REASON,
    UNMATCHED,
    accepted,
    parse_forecast,
    to_geo_columns,
    to_raw_columns,
)
from smogline.plans import jobs, lens
from smogline.schemas import (
    ENRICHED_READINGS,
    GEO_COLUMNS,
    GEO_DICTIONARY,
    PAYLOAD_POLLUTANTS,
    POLLUTANT_FIELDS,
    RAW_COLUMNS,
    RAW_READINGS,
    STATIONS,
    UNMEASURED_POLLUTANTS,
    Table,
)
from smogline.scratch import new_folder
from smogline.sources import citylists, keyed, streams, tables
from smogline.streaming import health, ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


# --- shared SQL and shapes -------------------------------------------------


def _sql_place(key: str) -> str:
    longitude = lens.LONGITUDE.format(id=key, div="//")
    return f"{lens.LATITUDE.format(id=key)} AS latitude, {longitude} AS longitude"


SQL_HOUR = "CAST(epoch(date_trunc('hour', ts)) AS BIGINT)"

SQL_READINGS = (
    f"SELECT event_id, user_id, event_type, value, {_sql_place('user_id')}, {SQL_HOUR} AS timestamp FROM events"
)

SQL_DICTIONARY = (
    f"SELECT c_custkey, {_sql_place('c_custkey')}, n_name AS city, r_name AS country FROM customer"
    " JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE c_acctbal >= 0"
)


def _sql_fields(columns: dict[str, str], enriched: bool) -> str:
    found = []
    for place, name in enumerate(PAYLOAD_POLLUTANTS):
        for field in POLLUTANT_FIELDS:
            text = lens.VALUES[field].format(i=place)
            absent = name == lens.WITHOUT_MEASURE or enriched and name in UNMEASURED_POLLUTANTS
            if field == "value_upm" and absent:
                text = "NULL"
            found.append(f"CAST(CAST({text} AS FLOAT) AS DOUBLE) AS {columns[name]}_{field}")
    return ", ".join(found)


SQL_RAW = (
    f"SELECT latitude, longitude, timestamp, {_sql_fields(RAW_COLUMNS, False)} FROM ({SQL_READINGS})"
    " QUALIFY row_number() OVER (PARTITION BY latitude, longitude, timestamp ORDER BY event_id DESC) = 1"
)

SQL_ENRICHED = (
    f"SELECT city, country, latitude, longitude, timestamp, {_sql_fields(GEO_COLUMNS, True)}"
    f" FROM (SELECT r.*, city, country FROM ({SQL_READINGS}) r JOIN ({SQL_DICTIONARY}) d ON c_custkey = user_id)"
    " QUALIFY row_number() OVER (PARTITION BY city, country, timestamp ORDER BY event_id DESC) = 1"
)

SQL_STATIONS = f"SELECT {_sql_place('user_id')} FROM (SELECT DISTINCT user_id FROM events)"


def flat_raw(df: DataFrame) -> DataFrame:
    pollutants = [field for name in RAW_COLUMNS.values() for field in flat_fields(name)]
    return df.select("latitude", "longitude", "timestamp", *pollutants)


def flat_enriched(df: DataFrame) -> DataFrame:
    pollutants = [field for name in GEO_COLUMNS.values() for field in flat_fields(name)]
    return df.select("city", "country", "latitude", "longitude", "timestamp", *pollutants)


# --- readings --------------------------------------------------------------


@query(SQL_ENRICHED)
def enriched_by_geo(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: payloads to the last reading of each city, country and hour."""
    readings = jobs.enriched_readings(
        lens.messages(spark, folder), lens.dictionary(spark, folder), ["event_id"]
    )
    return flat_enriched(readings)


@query(
    f"SELECT event_id, latitude, longitude, timestamp, {_sql_fields(RAW_COLUMNS, False)} FROM ({SQL_READINGS})"
)
def parse_forecast_raw(spark: SparkSession, folder: str) -> DataFrame:
    parsed = to_raw_columns(accepted(parse_forecast(lens.messages(spark, folder))))
    pollutants = [field for name in RAW_COLUMNS.values() for field in flat_fields(name)]
    return parsed.select("event_id", "latitude", "longitude", "timestamp", *pollutants)


@query(SQL_RAW)
def raw_by_lat_lon(spark: SparkSession, folder: str) -> DataFrame:
    return flat_raw(jobs.raw_readings(lens.messages(spark, folder), ["event_id"]))


@query(
    f"SELECT latitude, longitude, timestamp, {_sql_fields(RAW_COLUMNS, False)} FROM ({SQL_READINGS})"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, event_id DESC) = 1"
)
def latest_per_station(spark: SparkSession, folder: str) -> DataFrame:
    parsed = to_raw_columns(accepted(parse_forecast(lens.messages(spark, folder))))
    return flat_raw(latest.last_write(parsed, ["latitude", "longitude"], ["timestamp", "event_id"]))


@query(
    "SELECT latitude, longitude, timestamp,"
    " row_number() OVER (PARTITION BY latitude, longitude ORDER BY timestamp DESC) AS newest_rank"
    f" FROM (SELECT DISTINCT latitude, longitude, timestamp FROM ({SQL_READINGS}))"
)
def station_history_newest_first(spark: SparkSession, folder: str) -> DataFrame:
    readings = jobs.raw_readings(lens.messages(spark, folder), ["event_id"])
    ranked = latest.newest_first_rank(
        readings.select("latitude", "longitude", "timestamp"), ["latitude", "longitude"], "timestamp"
    )
    return ranked.select("latitude", "longitude", "timestamp", "newest_rank")


@query(
    "SELECT event_type, count(*) AS readings, count(value) AS raw_overall,"
    " count(value) AS raw_pm, CAST(0 AS BIGINT) AS enriched_overall, CAST(0 AS BIGINT) AS enriched_pm,"
    " CAST(0 AS BIGINT) AS enriched_nitrous, count(value) AS enriched_ozone FROM events GROUP BY event_type"
)
def null_value_upm(spark: SparkSession, folder: str) -> DataFrame:
    parsed = accepted(parse_forecast(lens.messages(spark, folder)))
    raw = parsed.select("*", F.col("overall.value_upm").alias("raw_o"), F.col("PM.value_upm").alias("raw_p"))
    both = to_geo_columns(raw)
    return both.groupBy("event_type").agg(
        F.count("*").alias("readings"),
        F.count("raw_o").alias("raw_overall"),
        F.count("raw_p").alias("raw_pm"),
        F.count("overall_data.value_upm").alias("enriched_overall"),
        F.count("particulate_matter.value_upm").alias("enriched_pm"),
        F.count("nitrous_data.value_upm").alias("enriched_nitrous"),
        F.count("ozone_data.value_upm").alias("enriched_ozone"),
    )


SQL_OUTCOMES = (
    "SELECT *, CASE WHEN event_type IN ('click', 'error') THEN 'malformed'"
    " WHEN event_type IN ('purchase', 'signup') OR value < 10 THEN 'incomplete' ELSE 'none' END AS reason"
    f" FROM ({SQL_READINGS})"
)

# What is left of a spoiled message: which of its coordinates were readable, and a trait of its kept text.
SQL_SPOILED = (
    "SELECT event_id, reason, CASE WHEN event_type IN ('purchase', 'view') THEN latitude END AS latitude,"
    " CASE WHEN event_type = 'view' THEN longitude END AS longitude,"
    " CASE WHEN reason = 'none' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) END AS overall_pi,"
    " CASE WHEN reason = 'none' OR event_type = 'signup' THEN NULL WHEN event_type = 'click' THEN '{\"latitude\";'"
    " WHEN event_type = 'error' THEN '[{\"latitude\"' ELSE '{\"latitude\":' END AS begins,"
    " CASE WHEN reason = 'none' OR event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN ']'"
    " ELSE '}' END AS ends"
    f" FROM ({SQL_OUTCOMES})"
)


def _spoiled_rows(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("write_order.pos").alias("event_id"),
        F.coalesce(REASON, F.lit("none")).alias("reason"),
        "latitude",
        "longitude",
        F.col("overall_data.pi").cast("double").alias("overall_pi"),
        F.left("payload", F.lit(12)).alias("begins"),
        F.right("payload", F.lit(1)).alias("ends"),
    )


@query(f"SELECT event_type, reason, count(*) AS n FROM ({SQL_OUTCOMES}) GROUP BY event_type, reason")
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_forecast(lens.spoiled_messages(spark, folder))
    return parsed.groupBy("event_type", F.coalesce(REASON, F.lit("none")).alias("reason")).agg(
        F.count("*").alias("n")
    )


@query(
    f"SELECT latitude, longitude, count(*) AS n FROM ({SQL_READINGS}) r JOIN customer ON c_custkey = user_id"
    " WHERE c_acctbal < 0 GROUP BY latitude, longitude"
)
def unmatched_stations(spark: SparkSession, folder: str) -> DataFrame:
    readings = to_geo_columns(parse_forecast(lens.messages(spark, folder)))
    looked_up = enrich(readings, lens.dictionary(spark, folder))
    return looked_up.filter(F.col(REASON) == UNMATCHED).groupBy("latitude", "longitude").agg(F.count("*").alias("n"))


@query(SQL_ENRICHED)
def enriched_by_spread_join(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship as it runs when the dictionary is too large to broadcast."""
    readings = to_geo_columns(parse_forecast(lens.messages(spark, folder)))
    looked_up = accepted(enrich(readings, lens.dictionary(spark, folder), max_broadcast_bytes=0))
    return flat_enriched(latest.last_write(looked_up, ENRICHED_READINGS.key, ["event_id"]))


# --- stations and the dictionary -------------------------------------------


@query(SQL_STATIONS)
def distinct_coords(spark: SparkSession, folder: str) -> DataFrame:
    return dictionary.distinct_coords(accepted(parse_forecast(lens.messages(spark, folder))))


@query("SELECT count(DISTINCT user_id) AS stations FROM events")
def station_count(spark: SparkSession, folder: str) -> DataFrame:
    return tables.count_rows(lens.stations(spark, folder), "stations")


@query(
    f"SELECT event_id, CAST(round_even(latitude, 5) AS DOUBLE) AS lat_key,"
    f" CAST(round_even(longitude, 5) AS DOUBLE) AS lon_key FROM ({SQL_READINGS})"
)
def coord_key_round(spark: SparkSession, folder: str) -> DataFrame:
    events = lens.table(spark, folder, "events")
    return events.select(
        "event_id",
        coord_key(lens.latitude("user_id")).cast("double").alias("lat_key"),
        coord_key(lens.longitude("user_id")).cast("double").alias("lon_key"),
    )


SQL_GEO_DICTIONARY = (
    f"SELECT {_sql_place('c_custkey')},"
    " CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE n_name END AS city,"
    " CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ', ' || n_name || ', ' || r_name || ','"
    " ELSE n_name || ', ' || r_name END AS locality, r_name AS country,"
    " c_custkey AS geometry_lat, c_nationkey AS geometry_lng,"
    " CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 2 END AS n_results"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
    " WHERE c_acctbal >= 0"
)


def _flat_dictionary(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more, "latitude", "longitude", "city", "locality", "country",
        jsonpath.get("geometry", "$.location.lat", "bigint").alias("geometry_lat"),
        jsonpath.get("geometry", "$.location.lng", "int").alias("geometry_lng"),
        F.json_array_length(F.get_json_object("rawgeo", "$.results")).alias("n_results"),
    )


@query(SQL_GEO_DICTIONARY)
def geo_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_dictionary(dictionary.build_dictionary(lens.geocode_responses(spark, folder)))


@query(
    f"SELECT {_sql_place('c_custkey')}, pos AS result_pos,"
    " CASE WHEN pos = 2 THEN c_name ELSE n_name END AS city,"
    " CASE WHEN pos = 2 THEN c_name || ', ' || n_name || ', ' || r_name || ',' ELSE n_name || ', ' || r_name END AS locality,"
    " ' ' || r_name AS country, c_custkey AS geometry_lat, c_nationkey AS geometry_lng,"
    " CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 2 END AS n_results"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
    " CROSS JOIN (VALUES (1), (2)) v(pos)"
    " WHERE c_acctbal >= 0 AND (pos = 1 OR c_mktsegment = 'BUILDING')"
)
def geocode_localities(spark: SparkSession, folder: str) -> DataFrame:
    """Every locality result, with the country as it is written after the comma."""
    return _flat_dictionary(dictionary.geocode_results(lens.geocode_responses(spark, folder), trim=False), "result_pos")


@query(
    f"SELECT {_sql_place('c_custkey')}, 'no_locality' AS reject_reason FROM customer WHERE c_acctbal < 0"
)
def geocode_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return dictionary.bad_responses(lens.geocode_responses(spark, folder)).drop("payload")


@query(
    f"SELECT {_sql_place('c_custkey')}, CASE c_custkey % 6 WHEN 0 THEN 'no_address' WHEN 1 THEN 'malformed'"
    " WHEN 2 THEN 'malformed' WHEN 3 THEN 'malformed' WHEN 4 THEN 'no_locality' END AS reject_reason,"
    " CASE WHEN c_custkey % 6 = 5 THEN n_name END AS city"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey"
)
def geocode_sound_and_bad(spark: SparkSession, folder: str) -> DataFrame:
    """Responses without an address, with a second result of a wrong type, broken, NULL, without a town, and sound."""
    responses = lens.spoiled_responses(spark, folder)
    rejected = dictionary.bad_responses(responses).withColumn("city", F.lit(None).cast("string"))
    sound = dictionary.build_dictionary(responses).withColumn(REASON, F.lit(None).cast("string"))
    wanted = ["latitude", "longitude", REASON, "city"]
    return rejected.select(*wanted).unionByName(sound.select(*wanted))


@query(SQL_GEO_DICTIONARY)
def dictionary_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """Two full refreshes; the readers see the second."""
    root = new_folder(spark, "dictionary")
    built = dictionary.build_dictionary(lens.geocode_responses(spark, folder))
    renamed = built.withColumn("city", F.upper(F.reverse("city")))
    tables.replace_table(renamed, GEO_DICTIONARY, root, version=1)
    tables.replace_table(built, GEO_DICTIONARY, root, version=2)
    return _flat_dictionary(tables.read_version(spark, GEO_DICTIONARY, root))


def _describe(keys: pd.DataFrame) -> pd.Series:
    # A geocoder that names places after their degree; no town south of the equator.
    lat, lon = (np.floor(keys[name]).astype(int).astype(str) for name in ("latitude", "longitude"))
    address = "Cell " + lat + ", Row " + lat + ", Column " + lon
    kind = np.where(keys["latitude"] >= 0, "locality", "country")
    return '{"results":[{"types":["' + pd.Series(kind, keys.index) + '"],"formatted_address":"' + address + '","geometry":{"n":1}}]}'


@query(
    "SELECT latitude, longitude, 'Cell ' || lat AS city, 'Cell ' || lat || ', Row ' || lat || ', Column ' || lon AS locality,"
    " 'Column ' || lon AS country, '{\"n\":1}' AS geometry,"
    " '{\"results\":[{\"types\":[\"locality\"],\"formatted_address\":\"Cell ' || lat || ', Row ' || lat || ', Column ' || lon"
    " || '\",\"geometry\":{\"n\":1}}]}' AS rawgeo"
    " FROM (SELECT *, CAST(CAST(floor(latitude) AS BIGINT) AS VARCHAR) AS lat,"
    f" CAST(CAST(floor(longitude) AS BIGINT) AS VARCHAR) AS lon FROM ({SQL_STATIONS})) WHERE latitude >= 0"
)
def dictionary_job(spark: SparkSession, folder: str) -> DataFrame:
    """From readings to a new version of the dictionary, beside an unfinished one that does not count."""
    root = new_folder(spark, "dictionary")
    readings = accepted(parse_forecast(lens.messages(spark, folder)))
    jobs.refresh_dictionary(readings, _describe, root, 3, spark.sparkContext.defaultParallelism)
    unfinished = tables.read_version(spark, GEO_DICTIONARY, root, 3).withColumn("city", F.lit("unfinished"))
    writer = unfinished.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    writer.parquet(f"{root}/{tables.VERSION}=4")
    return tables.read_version(spark, GEO_DICTIONARY, root)


def _describe_later(keys: pd.DataFrame) -> pd.Series:
    return _describe(keys).str.replace("Cell ", "Later ")


@query(
    "SELECT latitude, longitude, CASE WHEN latitude < 0 THEN 'no_locality' WHEN first THEN 'Cell ' || degree"
    " ELSE 'Later ' || degree END AS state"
    " FROM (SELECT *, CAST(CAST(floor(latitude) AS BIGINT) AS VARCHAR) AS degree FROM"
    f" (SELECT {_sql_place('user_id')}, first FROM"
    " (SELECT user_id, bool_or(user_id % 3 <> 0) AS first FROM events GROUP BY user_id)))"
)
def dictionary_second_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs, the second over more stations: it asks for the new ones alone. Entries and rejects of both."""
    root = new_folder(spark, "dictionary")
    readings = lens.stations(spark, folder).withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    users = lens.events(spark, folder, "user_id").filter("user_id % 3 <> 0").select(
        lens.latitude("user_id").alias("latitude"), lens.longitude("user_id").alias("longitude")
    )
    cores = spark.sparkContext.defaultParallelism
    jobs.extend_dictionary(users, _describe, root, 1, cores)
    found = jobs.extend_dictionary(readings, _describe_later, root, 2, cores)
    bad = jobs.rejected_responses(spark, root)
    place = ["latitude", "longitude"]
    return found.select(*place, F.col("city").alias("state")).unionByName(bad.select(*place, F.col(REASON).alias("state")))


def _fussy(row: dict) -> str | None:
    # A service that fails in the south and knows nothing of every third degree.
    if row["latitude"] < 0:
        raise ValueError("south")
    degree = int(np.floor(row["latitude"]))
    return f"cell {degree}" if degree % 3 else None


@query(
    "SELECT latitude, longitude, CASE WHEN latitude >= 0 AND degree % 3 <> 0 THEN 'cell ' || degree END AS response,"
    " CASE WHEN latitude < 0 THEN 'failed: south' WHEN degree % 3 = 0 THEN 'no_answer' END AS response_failure"
    f" FROM (SELECT *, CAST(floor(latitude) AS BIGINT) AS degree FROM ({SQL_STATIONS}))"
)
def lookup_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Some requests fail and some have no answer: their rows say why, and the others are there."""
    keys = lens.stations(spark, folder).withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    limits = dictionary.Limits(tries=2, pause=0.001)
    return dictionary.lookup_each(keys, _fussy, limits=limits, parallelism=spark.sparkContext.defaultParallelism)


SQL_NEAR = (
    "SELECT c_custkey, c_name, c_custkey // 3 AS place, c_custkey % 3 AS nudge FROM customer"
)


@query(
    "SELECT CAST(round_even(((place * 611953) % 17000000 - 8500000 + 3e-2) / 100000, 5) AS DOUBLE) AS lat_key,"
    " arg_max(c_name, nudge) AS city, count(*) AS merged"
    f" FROM ({SQL_NEAR}) GROUP BY place"
)
def dictionary_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Three customers share each rounded coordinate; the northernmost names it."""
    near = lens.table(spark, folder, "customer").select(
        (lens.latitude("c_custkey div 3") + F.expr("(c_custkey % 3) * 1e-6")).alias("latitude"),
        lens.longitude("c_custkey div 3").alias("longitude"),
        F.col("c_name").alias("city"),
        F.lit("").alias("country"),
    )
    entries = dictionary.by_rounded_key(near)
    counted = near.groupBy(coord_key("latitude").alias("lat_key"), coord_key("longitude").alias("lon_key")).agg(
        F.count("*").alias("merged")
    )
    both = entries.join(counted, ["lat_key", "lon_key"])
    return both.select(F.col("lat_key").cast("double").alias("lat_key"), "city", "merged")


def _cell(keys: pd.DataFrame) -> pd.Series:
    lat, lon = np.floor(keys["latitude"]).astype(int), np.floor(keys["longitude"]).astype(int)
    return "cell " + lat.astype(str) + " " + lon.astype(str)


@query(
    "SELECT latitude, longitude, 'cell ' || CAST(floor(latitude) AS BIGINT) || ' '"
    f" || CAST(floor(longitude) AS BIGINT) AS response FROM ({SQL_STATIONS})"
)
def lookup_keys(spark: SparkSession, folder: str) -> DataFrame:
    keys = dictionary.distinct_coords(accepted(parse_forecast(lens.messages(spark, folder))))
    return dictionary.lookup_keys(keys, _cell, parallelism=spark.sparkContext.defaultParallelism)


@query(
    f"SELECT {_sql_place('user_id')}, c_acctbal < 0 AS unknown"
    " FROM (SELECT DISTINCT user_id FROM events) JOIN customer ON c_custkey = user_id"
)
def lookup_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Saved responses in place of a service: stations joined to the localities found for them."""
    keys = lens.stations(spark, folder).withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    saved = dictionary.build_dictionary(lens.geocode_responses(spark, folder)).select(
        "latitude", "longitude", F.col("rawgeo").alias("response")
    )
    found = dictionary.lookup_saved(keys, saved, ["latitude", "longitude"])
    return found.select("latitude", "longitude", F.col("response").isNull().alias("unknown"))


def _locate(keys: pd.DataFrame) -> pd.Series:
    # A geocoder whose first result encodes the number at the end of the name.
    number = keys["request"].str.extract(r"#(\d+)\+", expand=False).astype(int)
    first = '{"results":[{"geometry":{"location":{"lat":' + number.astype(str) + ',"lng":' + (-number).astype(str)
    return first + '}}},{"geometry":{"location":{"lat":0,"lng":0}}}]}'


@query(
    "SELECT c_mktsegment || '+' || c_name || '+' || n_name AS entry,"
    " CAST(c_custkey AS DOUBLE) AS lat, CAST(-c_custkey AS DOUBLE) AS lon"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey"
)
def forward_geocode(spark: SparkSession, folder: str) -> DataFrame:
    entries = _normalised(spark, folder)
    return jobs.locate_cities(entries, _locate, "address={address}", spark.sparkContext.defaultParallelism)


@query(
    "SELECT 'address=' || c_mktsegment || '+' || c_name || '+' || n_name AS request"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey"
)
def address_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _normalised(spark, folder).select(address_request("entry", "address={address}").alias("request"))


# --- city lists ------------------------------------------------------------

SQL_ENTRIES = (
    "SELECT row_number() OVER (ORDER BY n_name, c_custkey) - 1 AS pos, c_mktsegment || ' ' || c_name AS city,"
    " n_name AS country, c_mktsegment || '+' || c_name || '+' || n_name AS entry"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey"
)


def _normalised(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "citylist")
    lens.city_lines(spark, folder).write.text(path)
    return cities.normalise_cities(citylists.read_lines(spark, path))


@query(f"SELECT pos, city, country, entry FROM ({SQL_ENTRIES})")
def city_list_fill(spark: SparkSession, folder: str) -> DataFrame:
    return _normalised(spark, folder).select("pos", "city", "country", "entry")


@query(
    "SELECT pos // 1000 AS line_no, string_agg(entry, ',' ORDER BY pos) AS line, count(*) AS n_entries"
    f" FROM ({SQL_ENTRIES}) GROUP BY pos // 1000"
)
def city_list_line(spark: SparkSession, folder: str) -> DataFrame:
    return cities.joined_lines(_normalised(spark, folder))


def _numbered(entries: DataFrame) -> DataFrame:
    """The place of each entry read back: lines before its split, and its place in the split."""
    in_split = Window.partitionBy(*citylists.FILE_SPLIT).orderBy("row")
    earlier = Window.orderBy(*citylists.FILE_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    sizes = entries.groupBy(*citylists.FILE_SPLIT).agg(F.count("*").alias("n"))
    before = sizes.select(*citylists.FILE_SPLIT, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = entries.withColumn("place", F.row_number().over(in_split)).join(before, citylists.FILE_SPLIT)
    return placed.select("entry", (F.col("before") + F.col("place") - 1).alias("pos"))


@query(f"SELECT pos, entry FROM ({SQL_ENTRIES})")
def city_list_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised, written comma-joined, and read back in the same order."""
    source = new_folder(spark, "citylist")
    lens.city_lines(spark, folder).write.text(source)
    return _numbered(jobs.normalise_city_file(spark, source, new_folder(spark, "joined"))).select("pos", "entry")


@query(
    "SELECT row_number() OVER (ORDER BY file, n_name, c_custkey) - 1 AS pos,"
    " c_mktsegment || '+' || c_name || '+' || n_name AS entry FROM (SELECT *, CASE WHEN n_name < 'F'"
    " THEN 'a_rather_long_name' WHEN n_name < 'K' THEN 'b' ELSE 'cc' END AS file FROM customer JOIN nation ON n_nationkey = c_nationkey)"
)
def city_list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files follow each other by name, whatever its length, and one of them has lines of another system."""
    source = new_folder(spark, "citylists")
    lines = lens.city_lines_by_nation(spark, folder)
    for name, nations, ending in (
        ("cc", "n_name >= 'K'", "\n"), ("a_rather_long_name", "n_name < 'F'", "\r\n"), ("b", "n_name >= 'F' AND n_name < 'K'", "\n"),
    ):
        part = lines.filter(nations).orderBy("n_name", "place").select("line")
        part.write.option("lineSep", ending).text(f"{source}/{name}")
    return cities.normalise_cities(citylists.read_lines(spark, f"{source}/*")).select("pos", "entry")


# --- JSON on columns -------------------------------------------------------


@query(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,"
    " CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double,"
    " json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS absent FROM events"
)
def json_path_get(spark: SparkSession, folder: str) -> DataFrame:
    return lens.events(spark, folder, "event_id", "props").select(
        "event_id",
        jsonpath.get_int("props", "$.k").alias("k"),
        jsonpath.get_double("props", "$.k").alias("k_double"),
        jsonpath.get("props", "$.k").alias("k_text"),
        jsonpath.get("props", "$.missing").alias("absent"),
    )


def _lists(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a JSON list of its user, its property and its type."""
    return lens.events(spark, folder, "event_id", "user_id", "event_type", "props").select(
        "event_id",
        F.concat(
            F.lit("["), F.col("user_id"), F.lit(","), F.col("props"), F.lit(',"'), F.col("event_type"), F.lit('"]')
        ).alias("list"),
    )


@query(
    "SELECT event_id, user_id AS first, event_type AS third,"
    " CAST(json_extract_string(props, '$.k') AS INTEGER) AS nested FROM events"
)
def json_index_get(spark: SparkSession, folder: str) -> DataFrame:
    return _lists(spark, folder).select(
        "event_id",
        jsonpath.get("list", "$[0]", "bigint").alias("first"),
        jsonpath.get("list", "$[2]").alias("third"),
        jsonpath.get_int("list", "$[1].k").alias("nested"),
    )


@query(
    "SELECT event_id, CAST(3 + event_id % 5 AS INTEGER) AS items, CAST(1 + user_id % 3 AS INTEGER) AS entries FROM events"
)
def json_length(spark: SparkSession, folder: str) -> DataFrame:
    """Lists with as many numbers as the id says after three items, the second an object of one to three entries."""
    numbers = F.expr("repeat(',0', cast(event_id % 5 as int))")
    extra = F.expr("array_join(transform(sequence(0, cast(user_id % 3 as int)), i -> concat('\"x', i, '\":', i)), ',')")
    rows = lens.events(spark, folder, "event_id", "user_id").select(
        "event_id", F.concat(F.lit('["a",{'), extra, F.lit("},[1,2,3,4]"), numbers, F.lit("]")).alias("list")
    )
    entries = jsonpath.length(jsonpath.get("list", "$[1]"))
    return rows.select("event_id", jsonpath.length("list").alias("items"), entries.alias("entries"))


@query(
    "SELECT event_id, 0 AS pos, CAST(user_id AS VARCHAR) AS item FROM events"
    " UNION ALL SELECT event_id, 1, '{\"k\":' || json_extract_string(props, '$.k') || '}' FROM events"
    " UNION ALL SELECT event_id, 2, '\"' || event_type || '\"' FROM events"
)
def json_items(spark: SparkSession, folder: str) -> DataFrame:
    return jsonpath.items(_lists(spark, folder), "list", ["event_id"]).select("event_id", "pos", "item")


@query("SELECT event_id, user_id, event_type || '\"\\' AS name, value, 2 AS fields FROM events")
def json_dumps(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to JSON text, with text that needs escaping and a NULL field, and back."""
    awkward = F.concat("event_type", F.lit('"\\'))
    inner = F.struct(awkward.alias("name"), F.col("value"), F.lit(None).cast("int").alias("none"))
    row = F.struct("user_id", inner.alias("of"))
    text = lens.events(spark, folder).select("event_id", jsonpath.dumps(row).alias("text"))
    return text.select(
        "event_id",
        jsonpath.get("text", "$.user_id", "bigint").alias("user_id"),
        jsonpath.get("text", "$.of.name").alias("name"),
        jsonpath.get_double("text", "$.of.value").alias("value"),
        jsonpath.length(jsonpath.get("text", "$.of")).alias("fields"),
    )


# --- tables ----------------------------------------------------------------


@query(f"SELECT latitude AS lat, longitude AS lon FROM ({SQL_STATIONS}) ORDER BY latitude, longitude LIMIT 5")
def sample_limit(spark: SparkSession, folder: str) -> DataFrame:
    return tables.sample(lens.stations(spark, folder), 5, "lat", "lon")


@query("SELECT event_id, value * 2 AS doubled FROM events")
def table_scan_map(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.read_table(spark, f"{folder}/events.parquet", "parquet")
    return events.select("event_id", (F.col("value") * 2).alias("doubled"))


@query(f"SELECT latitude AS lat, longitude AS lon FROM ({SQL_STATIONS})")
def create_table_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Created, filled, and created again: the second statement leaves the rows alone."""
    place = new_folder(spark, "stations")
    name = f"{STATIONS.name}_{place.rsplit('-', 1)[1]}"
    STATIONS.create_if_absent(spark, place, name)
    lens.stations(spark, folder).write.insertInto(name)
    STATIONS.create_if_absent(spark, place, name)
    return spark.table(name)


@query(
    "SELECT fmt, event_id, CAST(epoch_us(ts) AS BIGINT) AS micros, user_id, event_type, value, props"
    " FROM events CROSS JOIN (VALUES ('orc'), ('json'), ('csv')) f(fmt)"
)
def read_other_formats(spark: SparkSession, folder: str) -> DataFrame:
    """One reader for any format: the events written in three others and read back, all columns."""
    events = lens.table(spark, folder, "events")
    exact = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
    options = {"csv": {"escape": '"', **exact}, "json": exact, "orc": {}}
    found = []
    for fmt, how in options.items():
        path = new_folder(spark, fmt)
        events.write.format(fmt).options(**how).save(path)
        back = tables.read_table(spark, path, fmt, events.schema, **how)
        micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").alias("micros")
        found.append(back.select(F.lit(fmt).alias("fmt"), "event_id", micros, "user_id", "event_type", "value", "props"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "SELECT count(*) AS readings, CAST(0 AS BIGINT) AS out_of_order, true AS apart"
    f" FROM (SELECT DISTINCT latitude, longitude, timestamp FROM ({SQL_READINGS}))"
)
def files_in_key_order(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table written in key order: rows in order inside each file, and no two files overlapping."""
    path = new_folder(spark, "ordered")
    readings = jobs.raw_readings(lens.messages(spark, folder), ["event_id"])
    latest.in_key_order(readings, RAW_READINGS.key, RAW_READINGS.newest_first).write.parquet(path)
    place = F.struct("latitude", "longitude", (-F.col("timestamp")).alias("age"))
    rows = spark.read.parquet(path).select(
        place.alias("place"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    # The files of a table are of bounded size, and so are these windows; the last one has a row per file.
    in_file = Window.partitionBy("file").orderBy("row")
    steps = rows.withColumn("wrong", F.lag("place").over(in_file) >= F.col("place"))
    files = steps.groupBy("file").agg(
        F.count("*").alias("n"),
        F.count_if("wrong").alias("wrong"),
        F.min("place").alias("low"),
        F.max("place").alias("high"),
    )
    apart = F.lag("high").over(Window.orderBy("low")) < F.col("low")
    by_range = files.withColumn("apart", F.coalesce(apart, F.lit(True)))
    return by_range.agg(
        F.sum("n").alias("readings"), F.sum("wrong").alias("out_of_order"), F.min("apart").alias("apart")
    )


@query(
    "SELECT c_custkey, CAST(round_even(((c_custkey * 611953) % 17000000 - 8500000 + 3e-2) / 100000, 5) AS DOUBLE) AS lat_key,"
    " n_name AS city, r_name AS country, replace(c_mktsegment || '+' || c_name, ' ', '+') AS joined, true AS header,"
    " CAST(c_custkey AS VARCHAR) AS inner_key, 2 AS fields"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
)
def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """The library's expressions by their names in SQL."""
    sqlnames.register_functions(spark, "sl_")
    view = f"places_{new_folder(spark, 'view').rsplit('-', 1)[1]}"
    body = F.to_json(F.struct(F.struct(F.col("c_custkey").alias("k")).alias("of"), F.col("n_name")))
    address = F.concat("n_name", F.lit(", Somewhere, "), "r_name", F.lit(",,"))
    rows = lens.places(spark, folder).withColumns({"latitude": lens.latitude("c_custkey"), "address": address, "body": body})
    rows.createOrReplaceTempView(view)
    return spark.sql(
        "SELECT c_custkey, CAST(sl_coord_key(latitude) AS DOUBLE) AS lat_key, sl_city_of(address) AS city,"
        " sl_country_of(address) AS country, sl_plus_joined(c_mktsegment, c_name) AS joined, sl_is_header(n_name) AS header,"
        f" sl_json_text(body, '$.of.k') AS inner_key, sl_json_length(body) AS fields FROM {view}"
    )


# --- streams and the keyed log ---------------------------------------------


# Messages of a landed file, and the files that a batch of a stream takes for each core at most.
FILE_MESSAGES = 50_000
FILES_PER_CORE = 4


def _as_many_buckets_as_cores(spark: SparkSession, table: Table, root: str) -> None:
    """An empty log whose views have a task for each core."""
    keyed.create_log(spark, table, root, max(keyed.BUCKETS, spark.sparkContext.defaultParallelism))


def _halves(df: DataFrame) -> list[DataFrame]:
    """The odd messages, then the even ones: keys recur with other values, and arrival contradicts the order."""
    return [df.filter(F.col("event_id") % 2 == rest) for rest in (1, 0)]


def _two_waves(spark: SparkSession, folder: str, run: Callable[[DataFrame, int], None]) -> None:
    """Land the messages in two waves, and run the stream to its end after each."""
    landing = new_folder(spark, "landing")
    for number, wave in enumerate(_halves(lens.messages(spark, folder)), 1):
        wave.select("event_id", "value").write.mode("append").parquet(landing)
        arrived = streams.file_stream(spark, landing, "event_id BIGINT, value STRING")
        run(streams.numbered_messages(arrived, "value", "event_id"), number)


@query(SQL_RAW)
def stream_raw_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The stream is stopped and restarted from its checkpoint between the waves."""
    root, checkpoint = new_folder(spark, "raw"), new_folder(spark, "raw-checkpoint")
    _two_waves(
        spark, folder, lambda arrived, _: ingest.raw_ingest(arrived, root, checkpoint, ingest.CATCH_UP).awaitTermination()
    )
    return flat_raw(keyed.current_view(spark, RAW_READINGS, root))


@query(SQL_ENRICHED)
def stream_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary as it was at the start."""
    root, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "enriched-checkpoint")
    names = lens.dictionary(spark, folder)

    def run(arrived: DataFrame, _: int) -> None:
        ingest.enriched_stream(arrived, names, root, checkpoint, ingest.CATCH_UP).awaitTermination()

    _two_waves(spark, folder, run)
    return flat_enriched(keyed.current_view(spark, ENRICHED_READINGS, root))


@query(
    f"SELECT city, country, latitude, longitude, timestamp, {_sql_fields(GEO_COLUMNS, True)}"
    " FROM (SELECT r.*, CASE WHEN event_id % 2 = 1 THEN lower(city) ELSE city END AS city, country"
    f" FROM ({SQL_READINGS}) r JOIN ({SQL_DICTIONARY}) d ON c_custkey = user_id)"
    " QUALIFY row_number() OVER (PARTITION BY city, country, timestamp ORDER BY event_id DESC) = 1"
)
def stream_enriched_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary gets another version between the waves, and each wave the names of its own."""
    root, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "enriched-checkpoint")
    place = new_folder(spark, "dictionary")
    names = lens.dictionary(spark, folder)
    for column in set(GEO_DICTIONARY.columns) - set(names.columns):
        names = names.withColumn(column, F.lit(None).cast("string"))

    def run(arrived: DataFrame, wave: int) -> None:
        called = names.withColumn("city", F.lower("city")) if wave == 1 else names
        tables.replace_table(called, GEO_DICTIONARY, place, wave)
        versions = ingest.dictionary_versions(spark, place)
        ingest.enriched_stream(arrived, versions, root, checkpoint, ingest.CATCH_UP).awaitTermination()

    _two_waves(spark, folder, run)
    return flat_enriched(keyed.current_view(spark, ENRICHED_READINGS, root))


@query(SQL_ENRICHED)
def stream_enriched_spread(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary that is not broadcast: the second wave knows the busy stations from the first."""
    root, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "enriched-checkpoint")
    names = lens.dictionary(spark, folder)

    def run(arrived: DataFrame, _: int) -> None:
        ingest.enriched_stream(arrived, names, root, checkpoint, ingest.CATCH_UP, max_broadcast_bytes=0).awaitTermination()

    _two_waves(spark, folder, run)
    return flat_enriched(keyed.current_view(spark, ENRICHED_READINGS, root))


def _named_places(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary with all columns of its table."""
    names = lens.dictionary(spark, folder)
    for column in set(GEO_DICTIONARY.columns) - set(names.columns):
        names = names.withColumn(column, F.lit(None).cast("string"))
    return names


@query(
    f"SELECT city, country, latitude, longitude, timestamp, {_sql_fields(GEO_COLUMNS, True)}"
    " FROM (SELECT r.*, CASE WHEN event_id % 2 = 1 THEN lower(city) ELSE city END AS city, country"
    f" FROM ({SQL_READINGS}) r JOIN ({SQL_DICTIONARY}) d ON c_custkey = user_id)"
    " QUALIFY row_number() OVER (PARTITION BY city, country, timestamp ORDER BY event_id DESC) = 1"
)
def replay_after_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The first batch fails after its choice of a version and runs again when there is a newer one: the choice stands."""
    root, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "enriched-checkpoint")
    place = new_folder(spark, "dictionary")
    names = _named_places(spark, folder)

    def broken(version: int) -> DataFrame:
        raise RuntimeError(f"version {version} cannot be read just now")

    def run(arrived: DataFrame, wave: int) -> None:
        called = names.withColumn("city", F.lower("city")) if wave == 1 else names
        tables.replace_table(called, GEO_DICTIONARY, place, wave)
        versions = ingest.dictionary_versions(spark, place)
        if wave == 1:
            failing = ingest.enriched_stream(arrived, ingest.Versions(versions.current, broken), root, checkpoint, ingest.CATCH_UP)
            try:
                failing.awaitTermination()
            except StreamingQueryException:
                tables.replace_table(names, GEO_DICTIONARY, place, 2)
        ingest.enriched_stream(arrived, versions, root, checkpoint, ingest.CATCH_UP).awaitTermination()

    _two_waves(spark, folder, run)
    return flat_enriched(keyed.current_view(spark, ENRICHED_READINGS, root))


@query(SQL_ENRICHED)
def unmatched_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the places are known while the stream runs; the others' readings are named afterwards, twice."""
    root, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "enriched-checkpoint")
    _as_many_buckets_as_cores(spark, ENRICHED_READINGS, root)
    place = new_folder(spark, "dictionary")
    names = _named_places(spark, folder)
    versions = ingest.dictionary_versions(spark, place)
    tables.replace_table(names.filter(F.pmod(F.xxhash64("latitude"), F.lit(2)) == 0), GEO_DICTIONARY, place, 1)

    def run(arrived: DataFrame, _: int) -> None:
        ingest.enriched_stream(arrived, versions, root, checkpoint, ingest.CATCH_UP).awaitTermination()

    _two_waves(spark, folder, run)
    tables.replace_table(names, GEO_DICTIONARY, place, 2)
    for _ in range(2):
        ingest.enrich_unmatched(spark, versions, root, 1, 2)
    keyed.compact(spark, ENRICHED_READINGS, root)
    return flat_enriched(keyed.current_view(spark, ENRICHED_READINGS, root))


@query(
    f"SELECT 'raw' AS kind, latitude, longitude, timestamp, overall_data_pi AS pi, 'known' AS state FROM ({SQL_RAW})"
    f" UNION ALL SELECT 'named', latitude, longitude, timestamp, overall_data_pi, city FROM ({SQL_ENRICHED})"
    f" UNION ALL SELECT 'rejected', latitude, longitude, timestamp, CAST(CAST(value AS FLOAT) AS DOUBLE), 'unmatched' FROM ({SQL_READINGS})"
    f" WHERE user_id NOT IN (SELECT c_custkey FROM ({SQL_DICTIONARY}))"
)
def both_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Raw and enriched table from one stream that parses each payload once, with what found no name."""
    raw, enriched, checkpoint = (new_folder(spark, name) for name in ("raw", "enriched", "both-checkpoint"))
    names = lens.dictionary(spark, folder)

    def run(arrived: DataFrame, _: int) -> None:
        ingest.both_tables(arrived, names, raw, enriched, checkpoint, ingest.CATCH_UP).awaitTermination()

    _two_waves(spark, folder, run)
    place = ["latitude", "longitude", "timestamp", F.col("overall_data.pi").cast("double").alias("pi")]
    parts = (
        keyed.current_view(spark, RAW_READINGS, raw).select(F.lit("raw").alias("kind"), *place, F.lit("known").alias("state")),
        keyed.current_view(spark, ENRICHED_READINGS, enriched).select(F.lit("named").alias("kind"), *place, F.col("city").alias("state")),
        keyed.quarantine(spark, ENRICHED_READINGS, enriched).select(F.lit("rejected").alias("kind"), *place, F.col(REASON).alias("state")),
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"SELECT batches, v.* FROM ({SQL_RAW}) v CROSS JOIN (VALUES (1), (2), (5)) b(batches)")
def raw_in_any_batching(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages cut into one, two and five batches, against their order, half of them compacted."""
    rows = to_raw_columns(
        parse_forecast(streams.numbered_messages(lens.messages(spark, folder), "value", "event_id"))
    )
    # Parsed once for all eight batches.
    parsed = new_folder(spark, "parsed")
    rows.write.parquet(parsed)
    rows = spark.read.schema(rows.schema).parquet(parsed)
    views = []
    for count in (1, 2, 5):
        root = new_folder(spark, "cut")
        _as_many_buckets_as_cores(spark, RAW_READINGS, root)
        for number in range(count):
            part = F.pmod(-F.col("write_order.pos"), F.lit(count)) == number
            keyed.write_batch(rows.filter(part), RAW_READINGS, root, number)
            if number == count // 2:
                keyed.compact(spark, RAW_READINGS, root)
        view = flat_raw(keyed.current_view(spark, RAW_READINGS, root))
        views.append(view.withColumn("batches", F.lit(count)))
    return views[0].unionByName(views[1]).unionByName(views[2])


def _spoiled_log(spark: SparkSession, folder: str, times: int) -> str:
    root = new_folder(spark, "replayed")
    rows = to_raw_columns(
        parse_forecast(streams.numbered_messages(lens.spoiled_messages(spark, folder), "value", "event_id"))
    )
    for _ in range(times):
        keyed.write_batch(rows, RAW_READINGS, root, 7)
    return root


@query(SQL_SPOILED)
def replay_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """A batch written twice counts once, good rows and rejected ones alike."""
    return _spoiled_rows(keyed.read_log(spark, RAW_READINGS, _spoiled_log(spark, folder, 2)))


@query(
    f"SELECT reason, latitude, longitude, begins, ends, count(*) AS n FROM ({SQL_SPOILED}) WHERE reason <> 'none'"
    " GROUP BY reason, latitude, longitude, begins, ends"
)
def quarantine_table(spark: SparkSession, folder: str) -> DataFrame:
    rejected = keyed.quarantine(spark, RAW_READINGS, _spoiled_log(spark, folder, 1))
    begins, ends = F.left("payload", F.lit(12)).alias("begins"), F.right("payload", F.lit(1)).alias("ends")
    kinds = rejected.groupBy(F.col(REASON).alias("reason"), "latitude", "longitude", begins, ends)
    return kinds.agg(F.count("*").alias("n"))


@query(
    "SELECT count(*) AS messages, count(*) FILTER (reason <> 'none') AS rejected, count(*) AS logged,"
    f" count(*) FILTER (reason <> 'none') AS quarantined FROM ({SQL_SPOILED})"
)
def stream_health(spark: SparkSession, folder: str) -> DataFrame:
    """What a listener counted while the batches passed, beside what the log holds."""
    root, landing, checkpoint = (new_folder(spark, name) for name in ("raw", "landing", "health-checkpoint"))
    messages = lens.spoiled_messages(spark, folder).select("event_id", "value")
    messages.write.option("maxRecordsPerFile", FILE_MESSAGES).parquet(landing)
    # A batch has work for all cores once there are many files, and is one of several when there are few.
    landed = len(spark.read.parquet(landing).inputFiles())
    each = max(3, min(landed // 3, FILES_PER_CORE * spark.sparkContext.defaultParallelism))
    arrived = streams.file_stream(spark, landing, "event_id BIGINT, value STRING", maxFilesPerTrigger=str(each))
    seen = health.Health()
    spark.streams.addListener(seen)
    try:
        ingest.raw_ingest(streams.numbered_messages(arrived, "value", "event_id"), root, checkpoint, ingest.CATCH_UP).awaitTermination()
        seen.ended.wait(30)
    finally:
        spark.streams.removeListener(seen)
    messages, rejected = seen.totals()
    log = keyed.read_log(spark, RAW_READINGS, root)
    counted = log.agg(F.count("*").alias("logged"), F.count_if(F.col(REASON).isNotNull()).alias("quarantined"))
    return counted.select(
        F.lit(messages).cast("long").alias("messages"), F.lit(rejected).cast("long").alias("rejected"), "logged", "quarantined"
    )


@query(SQL_RAW)
def compacted_view(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, the second one a replay of the first, read after two compactions and one more replay."""
    root = new_folder(spark, "log")
    odd, even = [
        to_raw_columns(parse_forecast(streams.numbered_messages(half, "value", "event_id")))
        for half in _halves(lens.messages(spark, folder))
    ]
    keyed.write_batch(odd, RAW_READINGS, root, 0)
    keyed.write_batch(odd, RAW_READINGS, root, 1)
    keyed.compact(spark, RAW_READINGS, root)
    keyed.write_batch(even, RAW_READINGS, root, 2)
    keyed.compact(spark, RAW_READINGS, root)
    keyed.write_batch(even, RAW_READINGS, root, 2)
    return flat_raw(keyed.current_view(spark, RAW_READINGS, root))


@query(SQL_RAW)
def expired_view(spark: SparkSession, folder: str) -> DataFrame:
    """Four batches in two compactions; what these made useless is removed before the view is read."""
    root = new_folder(spark, "expired")
    rows = to_raw_columns(
        parse_forecast(streams.numbered_messages(lens.messages(spark, folder), "value", "event_id"))
    )
    for number in range(4):
        keyed.write_batch(rows.filter(F.pmod(F.col("write_order.pos"), F.lit(4)) == number), RAW_READINGS, root, number)
        if number % 2:
            keyed.compact(spark, RAW_READINGS, root)
    keyed.expire(spark, root, grace_seconds=0)
    return flat_raw(keyed.current_view(spark, RAW_READINGS, root))


@query(
    f"SELECT {_sql_place('c_custkey')}, CASE WHEN c_mktsegment = 'BUILDING' THEN n_name ELSE lower(n_name) END AS city,"
    " r_name AS country FROM customer"
    " JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
)
def dictionary_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All places, and then some of them once more under another name."""
    root = new_folder(spark, "upserted")
    rows = lens.places(spark, folder).select(
        lens.latitude("c_custkey").alias("latitude"),
        lens.longitude("c_custkey").alias("longitude"),
        F.col("n_name").alias("city"),
        F.concat_ws(", ", "n_name", "r_name").alias("locality"),
        F.col("r_name").alias("country"),
        F.lit(None).cast("string").alias("geometry"),
        F.lit(None).cast("string").alias("rawgeo"),
        "c_mktsegment",
    )
    keyed.write_rows(rows.withColumn("city", F.lower("city")), GEO_DICTIONARY, root, 0)
    keyed.write_rows(rows.filter("c_mktsegment = 'BUILDING'"), GEO_DICTIONARY, root, 1)
    view = keyed.current_view(spark, GEO_DICTIONARY, root)
    return view.select("latitude", "longitude", "city", "country")


def _forecast(keys: pd.DataFrame) -> pd.Series:
    # A forecast service that answers with the coordinates it was asked for.
    found = keys["request"].str.extract(r"lat=(\S+)&lon=(\S+)")
    return '{"latitude":' + found[0] + ',"longitude":' + found[1] + ',"hourly":[{"timestamp":1700000000,"avg":{}}]}'


@query(f"SELECT latitude, longitude, CAST(1700000000 AS BIGINT) AS timestamp FROM ({SQL_STATIONS})")
def publish_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """One forecast per station, sent to a text sink and read as messages."""
    path = new_folder(spark, "published")
    jobs.publish_forecasts(
        lens.stations(spark, folder), _forecast, "lat={lat}&lon={lon}", "text", path,
        spark.sparkContext.defaultParallelism,
    )
    sent = accepted(parse_forecast(tables.read_table(spark, path, "text")))
    return sent.select("latitude", "longitude", "timestamp")


@query(f"SELECT latitude, longitude, CAST(2 AS BIGINT) AS times FROM ({SQL_STATIONS})")
def publish_once(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of forecasts, each fetched and sent again after its end: every station has one message for each run."""
    root, path, checkpoint = (new_folder(spark, name) for name in ("outbox", "published", "outbox-checkpoint"))
    cores = spark.sparkContext.defaultParallelism
    for run in ("first", "second"):
        for _ in range(2):
            jobs.fill_outbox(lens.stations(spark, folder), _forecast, "lat={lat}&lon={lon}", root, run, cores)
            jobs.send_outbox(spark, root, "text", checkpoint, path).awaitTermination()
    sent = accepted(parse_forecast(tables.read_table(spark, path, "text")))
    return sent.groupBy("latitude", "longitude").agg(F.count("*").alias("times"))
