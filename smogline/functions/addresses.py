"""Expressions on addresses, city lists and other text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pieces_end(text: str) -> Column:
    # An address may end in commas; the empty pieces after them do not count.
    return F.regexp_replace(F.col(text), ",+$", "")


def city_of(address: str) -> Column:
    """Text before the first comma."""
    return F.split_part(_pieces_end(address), F.lit(","), F.lit(1))


def country_of(address: str, trim: bool = True) -> Column:
    """Text after the last comma; ``trim=False`` keeps the blank that follows the comma."""
    last = F.split_part(_pieces_end(address), F.lit(","), F.lit(-1))
    return F.trim(last) if trim else last


def is_header(line: str | Column) -> Column:
    """True for a line whose letters are all upper case, and that has a letter."""
    line = F.col(line) if isinstance(line, str) else line
    return (F.upper(line) == line) & (F.lower(line) != line)


def plus_joined(*columns: str) -> Column:
    """Blanks become ``+``, and the columns are joined by ``+``."""
    return F.concat_ws("+", *[F.replace(F.col(name), F.lit(" "), F.lit("+")) for name in columns])
