"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words and the beginnings of its longer words (compounds of
one stem share them), hashed into buckets. The machine scores a text by a
bias, a weight per bucket, and the inner product of two buckets' vectors for
each pair: so an insult next to a group counts for more, or less, than the sum.
The pairwise sum needs only the vectors' sum and the sum of their squares.

It is fitted on a bounded sample of labelled documents: ``per_label`` of each
label. Spark counts the sample's buckets, and those are kept that tell the
labels apart.
Everything else, scoring included, covers all texts, whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, labelled_texts, sample_ids, slices, written

WORD = re.compile(r"[^\W_]+")
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6)
# Labelled documents of each label that the machine is fitted on, at most.
PER_LABEL = 3000
THRESHOLD = 0.3
CACHE = 100_000


def buckets_of(word: str) -> list[int]:
    """The word's bucket and those of its beginnings."""
    data = word.encode("utf-8")
    found = [zlib.crc32(data, 1) % BUCKETS]
    found += [zlib.crc32(word[:n].encode("utf-8"), 2) % BUCKETS for n in PREFIXES if n < len(word)]
    return found


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass
class Machine:
    """A fitted factorization machine; ``place`` maps buckets to rows of weights and vectors."""

    place: dict[int, int]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def terms(self, text: str | None) -> list[int]:
        terms: set[int] = set()
        known = self.known
        for word in words_of(text):
            places = known.get(word)
            if places is None:
                if len(known) >= CACHE:
                    known.clear()
                places = known[word] = tuple(self.place[b] for b in buckets_of(word) if b in self.place)
            if places:
                terms.update(places)
        return sorted(terms)

    def score(self, text: str | None) -> float:
        terms = self.terms(text)
        total = self.bias
        if terms:
            vectors = self.vectors[terms]
            total += self.weights[terms].sum() + 0.5 * float((vectors.sum(axis=0) ** 2 - (vectors**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))

    def __getstate__(self):
        return {**self.__dict__, "known": {}}


def fit_machine(
    buckets: list[int],
    rows: np.ndarray,
    places: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray,
    factors: int = 4,
    rounds: int = 150,
    penalty: float = 1e-2,
    rate: float = 0.05,
) -> Machine:
    """Fit on texts given as (row, place of a bucket) pairs.

    ``weights`` restores the labels' shares before sampling. With one label
    only, or without buckets, the machine is its bias.
    """
    size, positive = len(labels), int(labels.sum())
    share = float((weights * labels).sum() / weights.sum()) if size else 0.0
    prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not positive or positive == size or not len(buckets):
        return Machine({}, prior, np.zeros(0), np.zeros((0, factors)))
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order]
    numbers = np.random.default_rng(7)
    w, v, b = np.zeros(len(buckets)), numbers.normal(0, 0.01, (len(buckets), factors)), 0.0
    # Both labels weigh the same while fitting; the bias is set back afterwards.
    even = np.where(labels == 1, 0.5 / positive, 0.5 / (size - positive))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, v, np.zeros(1))]
    for step in range(1, rounds + 1):
        vectors = v[places]
        sums = np.stack([np.bincount(rows, vectors[:, f], size) for f in range(factors)], axis=1)
        squares = np.bincount(rows, (vectors**2).sum(axis=1), size)
        score = b + np.bincount(rows, w[places], size) + 0.5 * ((sums**2).sum(axis=1) - squares)
        slope = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) * even
        at = slope[rows]
        pairwise = [np.bincount(places, at * (sums[rows, f] - vectors[:, f]), len(w)) for f in range(factors)]
        grads = (
            np.bincount(places, at, len(w)) + penalty * w / len(w) ** 0.5,
            np.stack(pairwise, axis=1) + penalty * v,
            np.array([slope.sum()]),
        )
        steps = []
        for grad, (first, second) in zip(grads, moments):
            first += 0.1 * (grad - first)
            second += 0.01 * (grad**2 - second)
            steps.append(rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8))
        w, v, b = w - steps[0], v - steps[1], b - float(steps[2][0])
    return Machine({bucket: i for i, bucket in enumerate(buckets)}, b + prior, w, v)


def _telling(terms: DataFrame, positive: int, size: int, most: int, least: int, evident: float) -> DataFrame:
    """The ``most`` buckets whose presence differs most between the labels, by half the likelihood ratio.

    A bucket must occur in ``least`` sampled texts and tell more than ``evident``.
    """
    hits, total = F.col("hits"), F.col("total")
    expected = total * positive / size

    def part(seen: Column, due: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)

    told = part(hits, expected) + part(total - hits, total - expected)
    counted = terms.groupBy("bucket").agg(F.sum("label").alias("hits"), F.count("*").alias("total"))
    return (
        counted.where(total >= least)
        .withColumn("told", told)
        .where(F.col("told") > evident)
        .orderBy(F.desc("told"), "bucket")
        .limit(most)
        .select("bucket")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    per_label: int = PER_LABEL,
    label: str = "toxic",
    terms: int = 4000,
    least: int = 4,
    evident: float = 10.0,
) -> Machine:
    """Fit on documents whose row of ``labels`` satisfies ``learn``.

    Other than 0 and 1, NULL and contradicting labels are passed over, and so are
    NULL texts; of an id on several rows one text is taken. Without usable labels every text gets one low score. The driver
    gets labels and kept buckets of the sample: at most 2 * per_label * terms numbers.
    """

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found = [sorted({b for w in words_of(text) for b in buckets_of(w)}) for text in texts]
            columns = [batch.column(name) for name in ("row", "label", "weight")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(pa.int32()))], ["row", "label", "weight", "bag"]
            )

    bounded_batches(docs.sparkSession)
    texts = labelled_texts(docs, sample_ids(labels, label, learn, per_label))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    sampled = written(texts.mapInArrow(bags, "row long, label int, weight double, bag array<int>"), "term-bags")
    heads = sampled.select("row", "label", "weight").orderBy("row").toPandas()
    y, weights = heads["label"].to_numpy(float), heads["weight"].to_numpy(float)
    exploded = sampled.select("row", "label", F.explode("bag").alias("bucket"))
    kept = _telling(exploded, int(y.sum()), max(1, len(y)), terms, least, evident) if len(y) else None
    buckets = sorted(row["bucket"] for row in kept.collect()) if kept is not None else []
    if not buckets:
        return fit_machine([], np.zeros(0, int), np.zeros(0, int), y, weights)
    session = docs.sparkSession
    chosen = session.createDataFrame(list(zip(buckets, range(len(buckets)))), "bucket int, place int")
    pairs = exploded.join(F.broadcast(chosen), "bucket").select("row", "place").toPandas()
    rows = np.searchsorted(heads["row"].to_numpy(), pairs["row"].to_numpy())
    return fit_machine(buckets, rows, pairs["place"].to_numpy(), y, weights)


def score(machine: Machine, text: Column | str) -> Column:
    """Chance between 0 and 1 that the text is toxic; NULL and empty texts get the bias.

    Words of very long texts all count. Every row is scored by its own text.
    """
    shared = machine

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([shared.score(value.as_py()) for value in texts], pa.float64())

    return scored(text)
