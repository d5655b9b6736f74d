"""Rounded coordinates and request text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.schemas import COORDINATE_PATTERN


def coord_key(degrees: str | Column) -> Column:
    """Round to five decimals for lookups; NULL when the value is no coordinate.

    ``format_number`` rounds the exact binary value half-even, as a decimal
    formatter with the same pattern does on stored keys; the cast to
    DECIMAL(9,5) gives an 8-byte key in which -0 and 0 are the same.
    """
    text = F.call_function("format_number", _column(degrees), F.lit(COORDINATE_PATTERN))
    return text.try_cast("decimal(9,5)")


def coordinate_request(latitude: str | Column, longitude: str | Column, template: str) -> Column:
    """Fill ``{lat}`` and ``{lon}`` of a request template; credentials stay out of columns."""
    return _fill(template, {"lat": _column(latitude), "lon": _column(longitude)})


def address_request(address: str | Column, template: str) -> Column:
    """Fill ``{address}`` of a request template with already ``+``-joined words."""
    return _fill(template, {"address": _column(address)})


def _fill(template: str, values: dict[str, Column]) -> Column:
    filled = F.lit(template)
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value.cast("string"))
    return filled


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
