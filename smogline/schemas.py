"""Payload schemas and table definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Field, table and column names and their types, as found in the
# payloads and in the stored tables. The rest of the package derives from these.
POLLUTANT = "STRUCT<value_upm: FLOAT, pi: FLOAT, aqi: FLOAT, aqi_cn: FLOAT>"
POLLUTANT_FIELDS = ("value_upm", "pi", "aqi", "aqi_cn")
PAYLOAD_POLLUTANTS = ("PM", "NO2", "PM10", "PM2_5", "O3", "overall")
RAW_COLUMNS = {
    "PM": "pm_data",
    "NO2": "nitrous_data",
    "PM10": "pm_data_ten",
    "PM2_5": "pm_data_twenty_five",
    "O3": "ozone_data",
    "overall": "overall_data",
}
GEO_COLUMNS = {
    "overall": "overall_data",
    "NO2": "nitrous_data",
    "O3": "ozone_data",
    "PM": "particulate_matter",
    "PM10": "particulate_matter_ten",
    "PM2_5": "particulate_matter_twenty_five",
}
# The enriched table drops this field of these two pollutants, whatever came in.
UNMEASURED_FIELD = "value_upm"
UNMEASURED_POLLUTANTS = ("overall", "PM")
LOCALITY_TYPE = "locality"
COORDINATE_PATTERN = "#.#####"
# End of fixed values.

CORRUPT = "_corrupt_record"

FORECAST = (
    "latitude DOUBLE, longitude DOUBLE, hourly ARRAY<STRUCT<timestamp: DOUBLE, avg: STRUCT<"
    + ", ".join(f"{name}: {POLLUTANT}" for name in PAYLOAD_POLLUTANTS)
    + f">>>, {CORRUPT} STRING"
)

# `geometry` is declared as text: from_json then keeps the sub-object as written.
GEOCODE = (
    "results ARRAY<STRUCT<types: ARRAY<STRING>, formatted_address: STRING, geometry: STRING>>, "
    f"{CORRUPT} STRING"
)

FORWARD_GEOCODE = (
    "results ARRAY<STRUCT<geometry: STRUCT<location: STRUCT<lat: DOUBLE, lng: DOUBLE>>>>, "
    f"{CORRUPT} STRING"
)


@dataclass(frozen=True)
class Table:
    """A keyed table: its columns, primary key, and order of rows inside a file."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    newest_first: str | None = None

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns.items())

    def create_if_absent(self, spark: SparkSession, location: str, name: str | None = None) -> str:
        """Register the table in the session catalog over a shared folder; a no-op if it exists."""
        name = name or self.name
        place = location.replace("'", "''")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self.ddl}) USING parquet LOCATION '{place}'")
        return name

    def select_from(self, df: DataFrame, *extra: str) -> DataFrame:
        """The table's columns, in its order, plus any extra ones."""
        return df.select(*self.columns, *extra)


RAW_READINGS = Table(
    "pollution_data_by_lat_lon",
    {"latitude": "DOUBLE", "longitude": "DOUBLE", "timestamp": "BIGINT"}
    | {column: POLLUTANT for column in RAW_COLUMNS.values()},
    key=("latitude", "longitude", "timestamp"),
    newest_first="timestamp",
)

ENRICHED_READINGS = Table(
    "pollution_data_by_geo",
    {
        "city": "STRING",
        "country": "STRING",
        "latitude": "DOUBLE",
        "longitude": "DOUBLE",
        "timestamp": "BIGINT",
    }
    | {column: POLLUTANT for column in GEO_COLUMNS.values()},
    key=("city", "country", "timestamp"),
    newest_first="timestamp",
)

GEO_DICTIONARY = Table(
    "geodatadictionary",
    {
        "latitude": "DOUBLE",
        "longitude": "DOUBLE",
        "city": "STRING",
        "locality": "STRING",
        "country": "STRING",
        "geometry": "STRING",
        "rawgeo": "STRING",
    },
    key=("latitude", "longitude"),
)

# Responses that gave no dictionary entry, and why.
REJECTED_RESPONSES = Table(
    "rejected_responses",
    {"latitude": "DOUBLE", "longitude": "DOUBLE", "payload": "STRING", "reject_reason": "STRING"},
    key=("latitude", "longitude"),
)

STATIONS = Table("location_lat_lon", {"lat": "DOUBLE", "lon": "DOUBLE"}, key=("lat", "lon"))
