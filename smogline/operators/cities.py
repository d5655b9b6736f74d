"""City lists to ``City+Words+COUNTRY`` entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.addresses import is_header, plus_joined
from smogline.sources.citylists import FILE_SPLIT


def fill_countries(lines: DataFrame) -> DataFrame:
    """Cities with the country line above them, and their position in the list.

    The last country of each split and its number of cities are carried over
    to the later splits, so every task fills one split of the input only. The
    window without partitions sees one row per split.
    """
    header = F.when(is_header("line"), F.col("line"))
    marked = lines.withColumn("header", header)
    # Numbers only are aggregated; the few texts wanted are fetched by their rows.
    counted = marked.groupBy(*FILE_SPLIT).agg(
        F.max(F.when(F.col("header").isNotNull(), F.col("row"))).alias("row"),
        F.count_if(F.col("header").isNull()).alias("cities"),
    )
    headers = marked.filter(F.col("header").isNotNull()).select(*FILE_SPLIT, "row", F.col("header").alias("last_header"))
    per_split = counted.join(headers, [*FILE_SPLIT, "row"], "left")
    earlier = Window.orderBy(*FILE_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_split.select(
        *FILE_SPLIT,
        F.last("last_header", ignorenulls=True).over(earlier).alias("country_before"),
        F.coalesce(F.sum("cities").over(earlier), F.lit(0)).alias("cities_before"),
    )
    in_split = Window.partitionBy(*FILE_SPLIT).orderBy("row")
    filled = marked.join(carried, FILE_SPLIT).select(
        F.col("line").alias("city"),
        "header",
        F.coalesce(F.last("header", ignorenulls=True).over(in_split), "country_before").alias("country"),
        (F.col("cities_before") + F.count_if(F.col("header").isNull()).over(in_split) - 1).alias("pos"),
    )
    return filled.filter(F.col("header").isNull()).drop("header")


def normalise_cities(lines: DataFrame) -> DataFrame:
    """One entry per city, with its position."""
    return fill_countries(lines).withColumn("entry", plus_joined("city", "country"))


def joined_lines(entries: DataFrame, per_line: int = 1000) -> DataFrame:
    """The comma-joined list in consecutive lines of at most ``per_line`` entries.

    Putting the lines together by ``line_no`` gives the whole list; a single
    string would have to pass through one task.
    """
    numbered = entries.withColumn("line_no", F.floor(F.col("pos") / per_line))
    joined = F.expr("listagg(entry, ',') WITHIN GROUP (ORDER BY pos)")
    return numbered.groupBy("line_no").agg(joined.alias("line"), F.count("*").alias("n_entries"))
