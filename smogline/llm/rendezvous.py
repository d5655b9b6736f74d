"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number from the hash of (key, shard), scaled by its weight;
the record goes to the shard with the greatest draw. Draws of other shards do
not change when one is added or removed, so a new shard takes rows only into
itself, about its share of them, and a removed one loses only its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import in_order, small_or_shuffled, written

# Hex digits of the digest that make a draw: 52 bits, exact in a double.
DIGITS = 13
# Rows of a shard go by so many hex digits of the key's digest first.
PART_DIGITS = 3


def draw(key: Column, shard: Column | int, weight: float = 1.0) -> Column:
    """The shard's number for this key: weight / -ln(u), u between 0 and 1."""
    shard = F.lit(shard) if isinstance(shard, int) else shard
    digest = F.md5(F.concat_ws(":", key.cast("string"), shard.cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return F.lit(weight) / -F.log((number + 0.5) / float(16**DIGITS))


def greatest_draw(key: Column, weights: Sequence[float]) -> Column:
    """(draw, shard) of the winner; the greater number among equal draws. Weights must be positive."""
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    draws = (F.struct(draw(key, i, w).alias("draw"), F.lit(i).alias("shard")) for i, w in enumerate(weights))
    return F.array_max(F.array(*draws))


def numbered(rows: DataFrame, shard: str, key: str, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, 2 ... inside each shard, without gaps.

    All rows are put in one order, by shard, the key's digest, key and ties, and
    dealt to tasks by range; a shard's slots are counted from its first row. No
    task holds a whole shard, or all rows of a key that is on very many.
    """
    part = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, PART_DIGITS)
    parted = written(rows.withColumns({"part": part, "row": F.monotonically_increasing_id()}), "parted")
    placed = in_order(parted, *(F.asc_nulls_first(name) for name in (shard, "part", key, *ties, "row")))
    firsts = written(placed.groupBy(shard).agg(F.min("position").alias("first")), "firsts")
    slot = (F.col("position") - F.col("first")).cast("long")
    return placed.join(small_or_shuffled(firsts), shard).withColumn("slot", slot).drop("part", "row", "position", "first")


def place(docs: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard.

    ``shard`` follows from doc_id and the weights alone, ``grown_shard`` is the
    shard with one more of the last weight. ``size`` is the text's UTF-8 bytes
    and 16. A NULL or empty text has no bytes; a NULL id hashes as an empty
    text. Rows that repeat an id share its shard and are told apart by text.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    grown = len(weights)
    chosen = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        greatest_draw(key, weights).alias("best"),
        draw(key, grown, weights[-1]).alias("new"),
    )
    # Equal draws go to the greater number here as well.
    placed = chosen.select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("best.shard").alias("shard"),
        F.when(F.col("new") >= F.col("best.draw"), F.lit(grown)).otherwise(F.col("best.shard")).alias("grown_shard"),
    )
    return numbered(placed, "shard", "doc_id", ("text_crc32", "size"))
