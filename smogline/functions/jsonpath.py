"""Ad-hoc JSON access on text columns, through VARIANT.

Known payloads use a declared schema instead (see ``smogline.schemas``).
Lookups give NULL when the path is absent or the value has another type;
``strict=True`` raises for an unusable value, as a typed getter would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: str | Column) -> Column:
    """JSON text as VARIANT, NULL when it is not JSON."""
    return F.try_parse_json(text)


def get(text: str | Column, path: str, kind: str = "string", strict: bool = False) -> Column:
    """Value at ``$.key`` or ``$[index]``, as the given type."""
    return (F.variant_get if strict else F.try_variant_get)(parsed(text), path, kind)


def get_int(text: str | Column, path: str) -> Column:
    """Only whole numbers: a number in quotes, or one with a fraction, gives NULL."""
    return F.when(_kind(text, path) == "BIGINT", get(text, path, "int"))


def get_double(text: str | Column, path: str) -> Column:
    """Only numbers, whole ones included."""
    return F.when(_kind(text, path).rlike("^(DOUBLE|FLOAT|DECIMAL|BIGINT)"), get(text, path, "double"))


def length(text: str | Column) -> Column:
    """Items of an array, or entries of an object; NULL for anything else."""
    return F.coalesce(F.json_array_length(text), F.array_size(F.json_object_keys(text)))


def items(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per array item or object entry: ``pos``, ``key`` (objects only), ``item`` as JSON text."""
    entries = df.select(*keep, parsed(text).alias("tree")).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("tree").outer())
    )
    return entries.select(*keep, "pos", "key", F.to_json("value").alias("item"))


def dumps(value: str | Column) -> Column:
    """A struct, map, array or VARIANT as JSON text, with escaping."""
    return F.to_json(value)


def _kind(text: str | Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(parsed(text), path, "variant"))
