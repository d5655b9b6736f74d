"""Forecast JSON to typed readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.functions.pollutants import first_hour, pollutant_columns, up_to_first_hour, without_measure
from smogline.schemas import (
    CORRUPT,
    FORECAST,
    GEO_COLUMNS,
    RAW_COLUMNS,
    UNMEASURED_POLLUTANTS,
)

MALFORMED = "malformed"
INCOMPLETE = "incomplete"
UNMATCHED = "unmatched"
REASON = "reject_reason"
PAYLOAD = "payload"


def parse_json(
    df: DataFrame, text: str, schema: str, keep: list[str], relevant: Column | None = None
) -> DataFrame:
    """The kept columns and the fields of the parsed text.

    ``relevant`` is the part of the text that has to fit the schema. It is only
    computed, and parsed instead, for records that do not fit as a whole.

    ``inline`` over a one-element array gives the same columns as selecting the
    fields of a struct, but predicates stay above it: Catalyst would push a
    filter on struct fields below the projection and parse every text twice.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.array(F.from_json(text, schema, options))
    if relevant is not None:
        part = F.from_json(relevant, schema, options)
        parsed = F.transform(
            parsed, lambda whole: F.when(whole[CORRUPT].isNull(), whole).otherwise(F.coalesce(part, whole))
        )
    return df.select(*keep, F.inline(parsed))


def parse_forecast(df: DataFrame, text: str = "value") -> DataFrame:
    """Flatten each payload; rows that cannot be a reading carry a ``reject_reason``.

    Columns of ``df`` stay, except the text, which becomes ``payload`` and is
    kept for rejected rows only.
    """
    keep = [name for name in df.columns if name != text]
    hours = parse_json(df, text, FORECAST, [*keep, text], up_to_first_hour(text)).select(
        *keep, text, "latitude", "longitude", CORRUPT, first_hour().alias("hour")
    )
    readings = hours.select(
        *keep,
        text,
        "latitude",
        "longitude",
        CORRUPT,
        F.col("hour.timestamp").try_cast("bigint").alias("timestamp"),
        *pollutant_columns("hour"),
    )
    absent = F.col("latitude").isNull() | F.col("longitude").isNull() | F.col("timestamp").isNull()
    reason = F.when(F.col(CORRUPT).isNotNull(), MALFORMED).when(absent, INCOMPLETE)
    flagged = readings.withColumn(REASON, reason)
    return flagged.withColumn(PAYLOAD, F.when(F.col(REASON).isNotNull(), F.col(text))).drop(CORRUPT, text)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON, PAYLOAD)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def to_raw_columns(df: DataFrame) -> DataFrame:
    """Name the pollutants as in the raw table."""
    return df.withColumnsRenamed(RAW_COLUMNS)


def to_geo_columns(df: DataFrame) -> DataFrame:
    """Name the pollutants as in the enriched table, and null the unmeasured fields."""
    nulled = df.withColumns({name: without_measure(name) for name in UNMEASURED_POLLUTANTS})
    return nulled.withColumnsRenamed(GEO_COLUMNS)
