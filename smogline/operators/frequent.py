"""The stations with most readings, in a sketch that is merged from batch to batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.operators.enrich import KEYS, with_keys
from smogline.sources import files

# Stations that a sketch counts; a power of two. It takes some bytes for each.
TRACKED = 4096
STATE = "frequent"
# States of batches before the last are for one that runs again.
KEPT = 3


class FrequentStations:
    """States of the sketch below a log's root, one for each batch: that of the batch before, and its own readings."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/{STATE}"

    def _batches(self) -> list[int]:
        return files.finished_numbers(self.spark, self.folder, "batch_id")

    def _state(self, before: int) -> DataFrame | None:
        last = max((batch for batch in self._batches() if batch < before), default=None)
        return None if last is None else self.spark.read.parquet(f"{self.folder}/batch_id={last}").select("sketch")

    def before(self, batch_id: int, most: int) -> DataFrame:
        """(lat_key, lon_key) of the ``most`` stations with most readings before a batch; no rows if there is none."""
        state = self._state(batch_id)
        if state is None:
            return self.spark.createDataFrame([], "lat_key DECIMAL(9, 5), lon_key DECIMAL(9, 5)")
        found = state.selectExpr(f"explode(approx_top_k_estimate(sketch, {min(most, TRACKED // 2)})) AS top")
        place = F.split("top.item", "\\|")
        return found.select(*(place[i].cast("decimal(9, 5)").alias(name) for i, name in enumerate(KEYS)))

    def add(self, batch_id: int, readings: DataFrame) -> None:
        """Merge a batch's readings into the sketch; doing it again replaces it."""
        keyed = with_keys(readings).select(*KEYS).where("lat_key IS NOT NULL AND lon_key IS NOT NULL")
        counted = keyed.selectExpr(f"approx_top_k_accumulate(concat_ws('|', {', '.join(KEYS)}), {TRACKED}) AS sketch")
        state = self._state(batch_id)
        if state is not None:
            counted = state.unionByName(counted)
        merged = counted.selectExpr(f"approx_top_k_combine(sketch, {TRACKED}) AS sketch")
        merged.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch_id={batch_id}")
        for batch in self._batches()[:-KEPT]:
            files.delete(self.spark, f"{self.folder}/batch_id={batch}")
