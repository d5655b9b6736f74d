"""Quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label. Each passage is
encoded from the shares of its character classes and the repetition of its
words; gated attention (a tanh and a sigmoid of the code, multiplied) gives
every passage a weight, learned from the documents' labels alone; the weighted
sum of the codes is what gets scored. So one bad passage can decide over a long
document, and its weight tells which passage it was.

The network is fitted on a bounded sample of labelled documents; every passage
of every document is encoded when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, labelled_texts, sample_ids

PASSAGE = 2000
# Labelled documents of each label to fit on at most, and passages of all of them together.
PER_LABEL = 2000
PASSAGES_TO_FIT = 128_000
CLASSES = ("upper", "lower", "letter", "digit", "blank", "line", "symbol", "bar", "shout", "stop", "other")
FEATURES = len(CLASSES) + 6


def _class_of(code: int) -> int:
    character = chr(code)
    if character in "\n\r":
        return 5
    if character.isspace():
        return 4
    if character in "#*$%&<>@^~=_\\{}[]":
        return 6
    if character == "|":
        return 7
    if character in "!?":
        return 8
    if character in ".,;:":
        return 9
    if character.isdigit():
        return 3
    if not character.isalpha():
        return 10
    return 0 if character.isupper() else 1 if character.islower() else 2


_TABLE: list[np.ndarray] = []


def _classes(text: str) -> np.ndarray:
    """The class of every character; those beyond the basic plane are ``letter``."""
    if not _TABLE:
        _TABLE.append(np.array([_class_of(code) if not 0xD800 <= code < 0xE000 else 10 for code in range(0x10000)], np.uint8))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.minimum(codes, 0xFFFF)
    classes = _TABLE[0][known]
    classes[codes > 0xFFFF] = 2
    return classes


def encode(text: str | None, size: int = PASSAGE) -> np.ndarray:
    """One row of features per passage of ``size`` characters; one empty passage without text."""
    text = text or ""
    count = max(1, -(-len(text) // size))
    out = np.zeros((count, FEATURES), np.float32)
    if not text:
        return out
    classes = _classes(text)
    place = np.repeat(np.arange(count), size)[: len(text)] * len(CLASSES) + classes
    tally = np.bincount(place, minlength=count * len(CLASSES)).reshape(count, -1)
    lengths = tally.sum(axis=1)
    out[:, : len(CLASSES)] = tally / lengths[:, None]
    for row in range(count):
        words = text[row * size : (row + 1) * size].split()
        if not words:
            continue
        distinct = len(set(words))
        twins = sum(map(str.__eq__, words, words[1:]))
        out[row, len(CLASSES) :] = (
            len(words) / lengths[row],
            distinct / len(words),
            (len(words) - distinct) / (len(words) + 20),
            twins / len(words),
            np.log1p(len(words)) / 6,
            1.0,
        )
    return out


@dataclass
class Network:
    """Standardisation, encoder, gated attention and the bag's score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    shift: float

    def look(self, passages: np.ndarray) -> tuple[float, np.ndarray]:
        """Score of a bag, and the attention of its passages."""
        w = self.weights
        x = (passages - self.mean) / self.scale
        codes = np.tanh(x @ w["encode"] + w["encode_bias"])
        gate = np.tanh(codes @ w["tanh"]) / (1 + np.exp(-codes @ w["sigmoid"]))
        energy = gate @ w["attend"]
        attention = np.exp(energy - energy.max())
        attention /= attention.sum()
        total = float(attention @ codes @ w["score"]) + float(w["score_bias"][0]) + self.shift
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30)))), attention


def fit_network(
    bags: list[np.ndarray],
    labels: np.ndarray,
    weights: np.ndarray,
    hidden: int = 16,
    gates: int = 8,
    rounds: int = 300,
    rate: float = 0.02,
    penalty: float = 1e-4,
) -> Network:
    """Fit by Adam on all bags at once. ``weights`` restores the labels' shares before sampling.

    With one label only, or no bags, the score is the share of label 1.
    """
    numbers = np.random.default_rng(3)
    shapes = {
        "encode": (FEATURES, hidden),
        "encode_bias": (hidden,),
        "tanh": (hidden, gates),
        "sigmoid": (hidden, gates),
        "attend": (gates,),
        "score": (hidden,),
        "score_bias": (1,),
    }
    w = {k: numbers.normal(0, 0.3, shape) if "bias" not in k else np.zeros(shape) for k, shape in shapes.items()}
    share = float((weights * labels).sum() / weights.sum()) if len(labels) else 0.5
    prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not 0 < labels.sum() < len(labels):
        w["score"][:] = 0
        return Network(np.zeros(FEATURES), np.ones(FEATURES), w, prior)
    x = np.concatenate(bags).astype(float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    sizes = np.array([len(bag) for bag in bags])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    bag = np.repeat(np.arange(len(bags)), sizes)
    positive = labels.sum()
    even = np.where(labels == 1, 0.5 / positive, 0.5 / (len(labels) - positive))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, rounds + 1):
        codes = np.tanh(x @ w["encode"] + w["encode_bias"])
        t = np.tanh(codes @ w["tanh"])
        s = 1 / (1 + np.exp(-codes @ w["sigmoid"]))
        energy = (t * s) @ w["attend"]
        energy -= np.maximum.reduceat(energy, starts)[bag]
        attention = np.exp(energy)
        attention /= np.add.reduceat(attention, starts)[bag]
        pooled = np.add.reduceat(attention[:, None] * codes, starts)
        total = pooled @ w["score"] + w["score_bias"]
        slope = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels) * even
        # Back through the pooled code to attention, gates and encoder.
        d_pooled = slope[:, None] * w["score"]
        d_attention = (codes * d_pooled[bag]).sum(axis=1)
        d_energy = attention * (d_attention - np.add.reduceat(attention * d_attention, starts)[bag])
        d_gate = d_energy[:, None] * w["attend"]
        d_t, d_s = d_gate * s * (1 - t**2), d_gate * t * s * (1 - s)
        d_codes = attention[:, None] * d_pooled[bag] + d_t @ w["tanh"].T + d_s @ w["sigmoid"].T
        d_inner = d_codes * (1 - codes**2)
        grads = {
            "encode": x.T @ d_inner,
            "encode_bias": d_inner.sum(axis=0),
            "tanh": codes.T @ d_t,
            "sigmoid": codes.T @ d_s,
            "attend": (t * s).T @ d_energy,
            "score": pooled.T @ slope,
            "score_bias": np.array([slope.sum()]),
        }
        for k, grad in grads.items():
            first, second = moments[k]
            grad = grad + penalty * w[k]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad**2 - second)
            w[k] = w[k] - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Network(mean, scale, w, prior)


def _fitting(docs: DataFrame, sample: DataFrame, most: int) -> DataFrame:
    """The sample, or so many of its ids in the order of their hash that they have ``most`` passages at most.

    Half of these are for each label. An id with more than that alone is passed
    over, whatever its label. Weights follow the number of ids left.
    """
    passages = F.greatest(F.lit(1), F.ceil(F.length("text") / PASSAGE))
    sample = sample.withColumn("order", F.xxhash64("doc_id"))
    counted = (
        labelled_texts(docs, sample)
        .groupBy("doc_id", "label", "weight", "order")
        .agg(F.sum(passages).alias("passages"))
        .toPandas()
    )
    if counted["passages"].sum() <= most:
        return sample.select("doc_id", "label", "weight")
    few = counted[counted["passages"] <= most // 2].sort_values(["order", "doc_id"])
    few = few[few.groupby("label")["passages"].cumsum() <= most // 2]
    stand_for = counted.groupby("label").size() / few.groupby("label").size()
    rows = [(int(i), int(y), float(w * stand_for[y])) for i, y, w in zip(few["doc_id"], few["label"], few["weight"])]
    return docs.sparkSession.createDataFrame(rows, "doc_id long, label int, weight double")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = PER_LABEL, label: str = "quality") -> Network:
    """Fit on documents whose row of ``labels`` satisfies ``learn``.

    Labels other than 0 and 1 and contradicting ones are passed over, and so are
    NULL texts; of an id on several rows one text is taken. The driver gets all passages of the sampled documents, one row of
    features each; where these would be more than PASSAGES_TO_FIT, fewer
    documents are drawn.
    """

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coded = [encode(text).ravel() for text in batch["text"]]
            yield batch[["doc_id", "label", "weight"]].assign(bag=coded)

    bounded_batches(docs.sparkSession)
    sample = _fitting(docs, sample_ids(labels, label, learn, per_label), PASSAGES_TO_FIT)
    texts = labelled_texts(docs, sample)
    rows = texts.mapInPandas(bags, "doc_id long, label int, weight double, bag array<float>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    sampled = [np.asarray(bag, np.float32).reshape(-1, FEATURES) for bag in rows["bag"]]
    return fit_network(sampled, rows["label"].to_numpy(float), rows["weight"].to_numpy(float))


def score(network: Network, text: Column | str) -> Column:
    """(score, passages, passage, attention): chance of label 1, number of passages, the most attended one and its weight.

    NULL and empty texts are one empty passage; a very long one has as many
    passages as it takes. Every row has a score of its own, whatever its id.
    """

    @F.pandas_udf("score double, passages long, passage long, attention double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            chance, attention = network.look(encode(value))
            top = int(attention.argmax())
            rows.append((chance, len(attention), top, float(attention[top])))
        return pd.DataFrame(rows, columns=["score", "passages", "passage", "attention"])

    return scored(text)
