"""The pipeline's inputs, expressed over the star-schema test tables.

Events become forecast messages, event users become stations, and customers
become the places a geocoder knows. Payload text is made here and parsed back
by the library, while the SQL in ``queries`` computes from the source columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.schemas import PAYLOAD_POLLUTANTS

# Coordinates by id, in units of the fifth decimal plus 0.03 of one, so that no
# value lies on a rounding tie; distinct for 10^14 ids. {div} is integer division.
LATITUDE = "(({id} * 611953) % 17000000 - 8500000 + 3e-2) / 100000"
LONGITUDE = "(({id} * 1299709 + {id} {div} 17000000) % 34000000 - 17000000 + 3e-2) / 100000"

HOUR = (
    "extract(DAY FROM ts - TIMESTAMP_NTZ '1970-01-01 00:00:00') * 86400L"
    " + extract(HOUR FROM ts - TIMESTAMP_NTZ '1970-01-01 00:00:00') * 3600L"
)

# Values of one pollutant; {i} is its place in the payload.
VALUES = {"value_upm": "value / 2", "pi": "value", "aqi": "value + {i}", "aqi_cn": "value + {i} + 10"}
# This pollutant comes without the field; PM and `overall` have it, and lose it when enriched.
WITHOUT_MEASURE = "NO2"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores on a plain scan of fewer splits than cores; a larger one stays as it is split.

    For work that costs more than moving the rows, such as making and parsing text.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def events(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Events for work on text, on all cores; by default without their own JSON column."""
    return spread(table(spark, folder, "events").select(*(columns or ("event_id", "ts", "user_id", "event_type", "value"))))


def latitude(key: str) -> Column:
    return F.expr(LATITUDE.format(id=key))


def longitude(key: str) -> Column:
    return F.expr(LONGITUDE.format(id=key, div="div"))


def _pollutant(place: int, name: str) -> str:
    fields = [
        f"{text.format(i=place)} AS {field}"
        for field, text in VALUES.items()
        if not (name == WITHOUT_MEASURE and field == "value_upm")
    ]
    return f"struct({', '.join(fields)})"


def payload() -> Column:
    """One forecast as JSON text: the reading's hour first, then a later hour that must not be used."""
    now = ", ".join(f"{_pollutant(place, name)} AS {name}" for place, name in enumerate(PAYLOAD_POLLUTANTS))
    later = ", ".join(
        # Typed NULLs, which to_json leaves out: the later hour has one pollutant only.
        f"if({str(name == 'overall').lower()}, {_pollutant(place + 100, name)}, NULL) AS {name}"
        for place, name in enumerate(PAYLOAD_POLLUTANTS)
    )
    hours = (
        f"array(struct({HOUR} AS timestamp, struct({now}) AS avg), "
        f"struct({HOUR} + 3600L AS timestamp, struct({later}) AS avg))"
    )
    place = [latitude("user_id").alias("latitude"), longitude("user_id").alias("longitude")]
    return F.to_json(F.struct(*place, F.expr(hours).alias("hourly")))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """``event_id``, ``ts``, ``event_type`` and the payload as ``value``."""
    return events(spark, folder).select("event_id", "ts", "event_type", payload().alias("value"))


def spoiled_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages broken in five ways, by event type; a part of the views stays whole."""
    place = F.struct(latitude("user_id").alias("latitude"), longitude("user_id").alias("longitude"))
    text = (
        F.when(F.col("event_type") == "click", F.replace(payload(), F.lit(":"), F.lit(";")))
        .when(F.col("event_type") == "error", F.concat(F.lit("["), payload(), F.lit("]")))
        .when(F.col("event_type") == "purchase", F.to_json(F.struct(place.latitude.alias("latitude"))))
        .when(F.col("event_type") == "signup", F.lit(None))
        .when(F.col("value") < 10, F.replace(F.to_json(place), F.lit("}"), F.lit(',"hourly":[]}')))
        .otherwise(payload())
    )
    return events(spark, folder).select("event_id", "ts", "event_type", text.alias("value"))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.select(latitude("user_id").alias("lat"), longitude("user_id").alias("lon"))


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the names of their nation and region."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The stored dictionary: customers in debit have no entry."""
    known = places(spark, folder).filter("c_acctbal >= 0")
    return known.select(
        latitude("c_custkey").alias("latitude"),
        longitude("c_custkey").alias("longitude"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
    )


def geocode_responses(spark: SparkSession, folder: str) -> DataFrame:
    """A response per customer: a region result first, then a locality, for builders a second one.

    Customers in debit have no locality.
    """
    geometry = "struct(struct(c_custkey AS lat, c_nationkey AS lng) AS location) AS geometry"
    region = f"struct(array('country', 'political') AS types, r_name AS formatted_address, {geometry})"
    town = (
        "struct(array('locality', 'political') AS types,"
        f" concat(n_name, ', ', r_name) AS formatted_address, {geometry})"
    )
    quarter = (
        "struct(array('political', 'locality') AS types,"
        f" concat(c_name, ', ', n_name, ', ', r_name, ',') AS formatted_address, {geometry})"
    )
    results = (
        f"CASE WHEN c_acctbal < 0 THEN array({region}) WHEN c_mktsegment = 'BUILDING'"
        f" THEN array({region}, {town}, {quarter}) ELSE array({region}, {town}) END"
    )
    return places(spark, folder).select(
        latitude("c_custkey").alias("latitude"),
        longitude("c_custkey").alias("longitude"),
        F.to_json(F.struct(F.expr(results).alias("results"))).alias("response"),
    )


def spoiled_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Responses spoiled in five ways, by customer; every sixth is sound."""
    town = "struct(array('locality') AS types, concat(n_name, ', ', r_name) AS formatted_address)"
    sound = F.to_json(F.struct(F.expr(f"array({town})").alias("results")))
    bare = F.to_json(F.struct(F.expr("array(struct(array('locality') AS types))").alias("results")))
    kind = F.col("c_custkey") % 6
    text = (
        F.when(kind == 0, bare)
        .when(kind == 1, F.replace(sound, F.lit("}]}"), F.lit('},{"types":7,"formatted_address":"Elsewhere, Far"}]}')))
        .when(kind == 2, F.left(sound, F.lit(20)))
        .when(kind == 3, F.lit(None))
        .when(kind == 4, F.replace(sound, F.lit("locality"), F.lit("country")))
        .otherwise(sound)
    )
    return places(spark, folder).select(
        latitude("c_custkey").alias("latitude"), longitude("c_custkey").alias("longitude"), text.alias("response")
    )


def city_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as upper-case lines, each followed by its customers in order of key."""
    return city_lines_by_nation(spark, folder).orderBy("n_name", "place").select("line")


def city_lines_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines with nation and place, unordered."""
    members = places(spark, folder).select(
        "n_name", F.col("c_custkey").alias("place"), F.concat_ws(" ", "c_mktsegment", "c_name").alias("line")
    )
    headers = table(spark, folder, "nation").select(
        "n_name", F.lit(-1).cast("bigint").alias("place"), F.col("n_name").alias("line")
    )
    return headers.unionByName(members)
