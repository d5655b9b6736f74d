"""Resampling towards a target: hashed n-gram weights by bit-sliced aggregation.

A document's features are its runs of one to three words, hashed into buckets.
A bucket's gain is how much more frequent it is in the target than in the
corpus, as a whole number; a document's weight is the sum of its features'
gains. That sum is taken over bit planes: plane i of a document has a bit for
every bucket whose count has bit i, plane j of the gains one for every bucket
whose gain has bit j, apart for positive and negative gains. The ones of two
planes' conjunction, times 2 to the i + j, add up to the exact weight.

The drawn documents are those of the highest Gumbel-perturbed weights, which is
sampling without replacement in proportion to the importance weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, in_order, slices, written

BUCKETS = 10_000
RUN = 3
SCALE = 1000
SEED = 42
# Bytes to blanks and lower-case: letters, digits and all beyond ASCII make words.
PLAIN = bytes(
    code if code > 0x7F or 0x30 <= code <= 0x39 or 0x61 <= code <= 0x7A else code + 32 if 0x41 <= code <= 0x5A else 0x20
    for code in range(256)
)


def features(text: str | None, buckets: int = BUCKETS, run: int = RUN) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to ``run`` words, repeats included.

    A run's CRC goes on from the CRC of the run without its last word.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()
    hashes = list(map(crc32, words))
    found = [hashes]
    following = [b" " + word for word in words]
    for width in range(1, run):
        hashes = list(map(crc32, following[width:], hashes))
        found.append(hashes)
    return len(words), np.fromiter((h for part in found for h in part), np.int64, sum(map(len, found))) % buckets


def planes(counts: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers of one array, lowest bit first, each packed into 64-bit words."""
    bits = max(1, int(counts.max(initial=0)).bit_length())
    size = -(-len(counts) // 64) * 64
    out = np.zeros((bits, size // 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits((counts >> bit & 1).astype(bool))
        out[bit, : len(packed)] = packed
    return out.view(np.uint64)


@dataclass
class Gains:
    """Gain of each bucket, and the planes of the positive and the negative ones."""

    values: np.ndarray

    def __post_init__(self) -> None:
        self.up = planes(np.maximum(self.values, 0))
        self.down = planes(np.maximum(-self.values, 0))

    def weight(self, buckets: np.ndarray) -> int:
        """Sum of the gains of a document's features, by population counts."""
        if not len(buckets):
            return 0
        counts = planes(np.bincount(buckets, minlength=len(self.values)))
        total = 0
        for sign, sliced in ((1, self.up), (-1, self.down)):
            ones = np.bitwise_count(counts[:, None, :] & sliced[None, :, :]).sum(axis=2, dtype=np.int64)
            # Whole numbers of any size: a long text's planes may pass 64 bits together.
            total += sign * sum(int(ones[i, j]) << (i + j) for i, j in np.argwhere(ones))
        return total


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, run: int = RUN, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket. Each task sends one number for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                total += np.bincount(features(value, buckets, run)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    bounded_batches(texts.sparkSession)
    sums = texts.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> Gains:
    """Gains of the buckets from all texts of both tables; an empty table has no features."""
    corpus, wanted = bucket_counts(docs, buckets, run), bucket_counts(target, buckets, run)
    s_all, t_all = int(corpus.sum()), int(wanted.sum())
    values = [
        math.floor(SCALE * math.log((float(t + 1) * float(s_all + buckets)) / (float(s + 1) * float(t_all + buckets))))
        for s, t in zip(corpus.tolist(), wanted.tolist())
    ]
    return Gains(np.array(values, np.int64))


def weighed(docs: DataFrame, gained: Gains, run: int = RUN) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight. Texts are read where they lie."""
    shared = docs.sparkSession.sparkContext.broadcast(gained.values)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Gains(shared.value)
        for batch in slices(batches):
            rows = [(n, len(found), table.weight(found)) for n, found in (features(v, len(table.values), run) for v in batch.column(1).to_pylist())]
            columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], ["doc_id", "n_words", "n_features", "weight"])

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-float(SCALE) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = BUCKETS, run: int = RUN, seed: int = SEED
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank.

    Of the N documents with ``least_words`` words or more, those of the
    floor(percent * N / 100) highest scores are drawn and ranked from 1; the
    rest have a NULL rank. Equal scores go to the smaller id, a NULL id before
    all others; which of two rows of one id and score comes first is left open. A NULL id has the noise of
    an empty one. NULL and empty texts have no features and weigh 0. Other
    columns are not looked at.
    """
    weights = weighed(docs, gains(docs, target, buckets, run), run)
    scored = weights.select("*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), F.monotonically_increasing_id().alias("row"))
    scored = written(scored, "scored")
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    # The row's number spreads repeated rows over the ranges.
    placed = in_order(scored, F.when(able, 0).otherwise(1), F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row"))
    rank = F.when(able & (F.col("position") < percent * n // 100), F.col("position") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
