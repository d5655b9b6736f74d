"""The library's expressions as SQL functions, for notebooks and ``spark.sql``.

They are defined in SQL, so the optimizer puts their bodies into the query: no
Python runs, and filters and pruning work through them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from smogline.schemas import COORDINATE_PATTERN

# An address may end in commas; the empty pieces after them do not count.
_PIECES = "regexp_replace(address, ',+$', '')"

FUNCTIONS = {
    "coord_key(degrees DOUBLE) RETURNS DECIMAL(9, 5)": f"try_cast(format_number(degrees, '{COORDINATE_PATTERN}') AS DECIMAL(9, 5))",
    "city_of(address STRING) RETURNS STRING": f"split_part({_PIECES}, ',', 1)",
    "country_of(address STRING) RETURNS STRING": f"trim(split_part({_PIECES}, ',', -1))",
    "is_header(line STRING) RETURNS BOOLEAN": "upper(line) = line AND lower(line) <> line",
    "plus_joined(first STRING, second STRING) RETURNS STRING": "concat_ws('+', replace(first, ' ', '+'), replace(second, ' ', '+'))",
    "json_text(body STRING, path STRING) RETURNS STRING": "get_json_object(body, path)",
    "json_length(body STRING) RETURNS INT": "coalesce(json_array_length(body), array_size(json_object_keys(body)))",
    "last_reading(hourly STRING) RETURNS STRING": "get_json_object(hourly, '$[0]')",
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the functions known to the session, under their names with a prefix; returns the names."""
    names = []
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURN {body}")
        names.append(prefix + signature.split("(")[0])
    return names
