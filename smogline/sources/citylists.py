"""City lists: upper-case country lines, each followed by its cities; or one comma-joined line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SPLIT = ["file", "split_start"]


def read_lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """Lines with their place: file, start of the split they were read from, and order in it.

    A split is read front to back by one task, so the generated id orders its
    lines; splits of a file are ordered by their start. Nothing needs the whole
    file in one place. Files follow each other by path; the parts of one write
    by their numbers. Without another separator, lines end as Spark's do, by
    line feed, carriage return or both.
    """
    reader = spark.read if separator == "\n" else spark.read.option("lineSep", separator)
    file = F.col("_metadata.file_path")
    folder = F.regexp_extract(file, r"^(.*/)[^/]*$", 1)
    name = F.regexp_extract(file, r"([^/]*)$", 1)
    part = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint")
    return reader.text(path).select(
        F.col("value").alias("line"),
        # Numbers of more than five digits would sort before shorter ones as text.
        F.struct(
            folder.alias("folder"),
            F.when(part.isNotNull(), F.lit("part-")).otherwise(name).alias("name"),
            part.alias("part"),
            file.alias("path"),
        ).alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
    )


def write_joined(entries: DataFrame, entry: str, position: str, path: str) -> None:
    """The entries in order, each followed by a comma, over as many files as it takes."""
    entries.orderBy(position).select(entry).write.option("lineSep", ",").mode("overwrite").text(path)


def read_joined(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a comma-joined list; line breaks inside it and empty entries do not count."""
    pieces = read_lines(spark, path, ",")
    return pieces.select(
        F.regexp_replace("line", "[\r\n]", "").alias("entry"), "file", "split_start", "row"
    ).filter(F.col("entry") != "")
