"""Expressions on the parsed forecast and its four-number pollutant structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.schemas import PAYLOAD_POLLUTANTS, POLLUTANT_FIELDS, UNMEASURED_FIELD


def first_hour(hourly: str = "hourly") -> Column:
    """The most recent hour; NULL for an empty list (``[0]`` would raise under ANSI)."""
    return F.get(hourly, 0)


def up_to_first_hour(text: str) -> Column:
    """The payload without later hours, which nobody reads; NULL when it is not JSON or has no hour."""
    tree = F.try_parse_json(text)
    fields = {
        '{"latitude":': "$.latitude",
        ',"longitude":': "$.longitude",
        ',"hourly":[': "$.hourly[0]",
    }
    pieces = [
        piece
        for prefix, path in fields.items()
        for piece in (F.lit(prefix), F.to_json(F.try_variant_get(tree, path, "variant")))
    ]
    return F.concat(*pieces, F.lit("]}"))


def pollutant_columns(hour: str) -> list[Column]:
    """One struct column per pollutant; a missing pollutant or field is NULL."""
    return [F.col(f"{hour}.avg.{name}").alias(name) for name in PAYLOAD_POLLUTANTS]


def without_measure(pollutant: str) -> Column:
    """Null the unmeasured field, keeping a NULL struct NULL."""
    return F.col(pollutant).withField(UNMEASURED_FIELD, F.lit(None).cast("float"))


def flat_fields(pollutant: str) -> list[Column]:
    """``<pollutant>_<field>`` doubles, for reports and comparisons."""
    return [F.col(f"{pollutant}.{field}").cast("double").alias(f"{pollutant}_{field}") for field in POLLUTANT_FIELDS]
