"""Batch reads, small previews and plain writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smogline.operators.latest import in_key_order
from smogline.schemas import Table
from smogline.sources.files import finished_numbers

VERSION = "version"


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Any batch source by format name and options; ``schema`` for formats that do not keep one."""
    reader = spark.read.format(fmt).options(**options)
    reader = reader if schema is None else reader.schema(schema)
    return reader.load(path) if path else reader.load()


def sample(df: DataFrame, rows: int = 5, *order: str) -> DataFrame:
    """A few rows to look at; which ones is only fixed when an order is given."""
    return (df.orderBy(*order) if order else df).limit(rows)


def preview(df: DataFrame, rows: int = 20) -> None:
    """Print a few rows."""
    df.show(rows, truncate=False)


def fixture(spark: SparkSession, rows: list[tuple], table: Table) -> DataFrame:
    """Hand-made rows as a DataFrame with the table's columns."""
    return spark.createDataFrame(rows, table.ddl)


def replace_table(df: DataFrame, table: Table, root: str, version: int) -> None:
    """Full refresh: write the rows as a new version, in key order.

    Readers of an older version are not disturbed, and ``df`` may itself be
    derived from one. Writing the same version again replaces it.
    """
    rows = in_key_order(table.select_from(df), table.key, table.newest_first)
    rows.write.mode("overwrite").parquet(f"{root}/{VERSION}={version}")


def latest_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """The greatest version whose write came to its end; only folders are listed.

    With ``below`` the greatest one before that, or None; else it is an error if there is none.
    """
    versions = finished_numbers(spark, root, VERSION)
    if below is not None:
        return max((version for version in versions if version < below), default=None)
    if not versions:
        raise ValueError(f"no finished version in {root}")
    return versions[-1]


def read_version(spark: SparkSession, table: Table, root: str, version: int | None = None) -> DataFrame:
    """The rows of one version, by default the latest."""
    version = latest_version(spark, root) if version is None else version
    return spark.read.schema(table.ddl).parquet(f"{root}/{VERSION}={version}")


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """The number of rows, as a one-row DataFrame."""
    return df.agg(F.count("*").alias(name))
