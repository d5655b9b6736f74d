"""A causal self-attention model over subword ids, trained and applied in numpy.

Texts become subword ids word by word, with an end id. A token's code attends
to the codes of the tokens up to it, with a learned bias for each distance,
and a softmax over output classes gives the next token.
Frequent ids are classes of their own; the others share classes, inside which
counts over all training texts decide, so every id has a probability and they
add up to one.

Long texts are scored in overlapping windows: each has SPAN new tokens, scored
once, behind the SPAN tokens before them, which only lend context. Windows of
many documents go through the network together, under one causal mask.

Training is spread: in each round every task takes the common weights, runs Adam
over the round's windows among its own rows, and sends the weights back; Spark
averages them. Every window of every training text is in one of the rounds. So a
round's work grows with the corpus and nothing but weights comes to the driver.
Word and subword counts are taken over all training texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from smogline.llm.common import bounded_batches, kept_memory, slices, written

# New tokens of a window; as many before them are context.
SPAN = 16
WIDTH = 16
HEADS = 1
# Ids with a class of their own, and classes for all others: of a token that is read, and of one that is predicted.
READ = (1024, 64)
PREDICTED = (96, 32)
# The windows of a text are dealt to the rounds by turns, so that each is learned from once.
ROUNDS = 4
# Windows of one step, and the steps that a task should have windows for; one with fewer goes over them again.
BATCH = 128
LEAST_STEPS = 24
RATE = 0.02
ABSENT = 0xFFFFFFFF
# Words whose counts go to all workers, and their greatest length; the other words' counts are joined.
FREQUENT = 1 << 18
FREQUENT_BYTES = 64
# Rows of distinct words that a worker sums before it sends them on, and windows that it holds.
COUNTED = 1_000_000
HELD = 1 << 14
NOTHING = pa.table({"word": pa.array([], pa.large_string()), "n": pa.array([], pa.int64())})
# Windows of one row, and bytes of a row group: whoever reads a round holds a group at a time, and a writer a page of 100 rows at least.
ROW_WINDOWS = 512
GROUP_BYTES = 4 << 20
# Below this, exponents of float32 numbers can be added up.
STEEP = 60
# Windows that are scored together.
STEP = 128
FIXED_POINT = 1 << 20


@dataclass
class Words:
    """The words of a batch of texts: distinct ones, the number of each word in a row, and where each text begins.

    Every text ends with a word of its own, numbered after the distinct ones.
    """

    distinct: pa.Array
    numbers: np.ndarray
    begins: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.append(self.begins, len(self.numbers))[1:]


def words_of(texts: pa.Array) -> Words:
    """Runs without ASCII white space, A-Z lower-cased; NULL has none."""
    # A copy of its own: Arrow's casts of a part of an array do not keep its place.
    texts = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(plain)
    lengths = np.where(pc.equal(plain, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(split).to_numpy())
    values = split.flatten()
    coded = values.filter(pc.not_equal(values, "")).dictionary_encode()
    words = coded.indices.to_numpy()
    begins = np.cumsum([0, *(lengths + 1)])
    numbers = np.full(begins[-1], len(coded.dictionary))
    numbers[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)] = words
    return Words(coded.dictionary, numbers, begins[:-1])


class Subwords:
    """Subword ids of words, by a vocabulary."""

    def __init__(self, model_path: str):
        self.model = SentencePieceProcessor(model_file=model_path)
        self.size = self.model.vocab_size()
        self.start, self.end = self.model.bos_id(), self.model.eos_id()
        # Windows are written down in two bytes a place if these tell all ids from an absent one.
        self.kind = np.dtype(np.uint16 if self.size < 0xFFFF else np.uint32)

    def spelled(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids one after the other, and how many each has."""
        found = self.model.encode(words.to_pylist(), num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes

    def sequences(self, words: Words, known: np.ndarray | None = None, spelling: Spelling | None = None) -> list[np.ndarray]:
        """Ids of each text, the end included. Each distinct word is looked up once.

        ``known`` tells which of them ``spelling`` has already, and where; -1 is none.
        """
        if not len(words.begins):
            return []
        if known is None:
            ids, sizes = self.spelled(words.distinct)
            firsts = np.cumsum(sizes) - sizes
        else:
            new = known < 0
            ids, own = self.spelled(words.distinct.filter(pa.array(new)))
            sizes, firsts = spelling.sizes[known], spelling.firsts[known] + len(ids)
            sizes[new], firsts[new] = own, np.cumsum(own) - own
            ids = np.concatenate([ids, spelling.ids])
        sizes, firsts = np.append(sizes, 1), np.append(firsts, len(ids))
        ids = np.append(ids, np.uint32(self.end))
        each = sizes[words.numbers]
        ends = np.cumsum(each)
        places = np.arange(ends[-1])
        places += np.repeat(firsts[words.numbers] - ends + each, each)
        return np.split(ids.take(places), ends[words.ends - 1][:-1])


@dataclass
class Spelling:
    """Words that every worker gets, the log of the count of each, and their ids; one more entry of nought for all other words."""

    words: pa.Array
    logs: np.ndarray
    ids: np.ndarray
    firsts: np.ndarray
    sizes: np.ndarray


def passages(words: Words, begins: list[int], ends: list[int]) -> Words:
    """Some stretches of the words as texts; one that goes up to a text's end has its last word."""
    numbers = np.concatenate([words.numbers[begin:end] for begin, end in zip(begins, ends)] or [words.numbers[:0]])
    last = len(words.distinct)
    used = np.unique(numbers)
    used = used[used < last]
    sizes = np.array(ends, np.int64) - np.array(begins, np.int64)
    return Words(words.distinct.take(pa.array(used)), np.searchsorted(used, numbers), np.cumsum(sizes) - sizes)


@lru_cache(maxsize=1)
def subwords(model_path: str) -> Subwords:
    """One vocabulary per worker process."""
    return Subwords(model_path)


def classes(counts: np.ndarray, own: int, shared: int) -> np.ndarray:
    """Class of each id: the ``own`` most frequent alone, the rest in bands of about equal mass by frequency."""
    order = np.argsort(-counts, kind="stable")
    rest = counts[order[own:]].astype(float)
    before = np.concatenate([[0.0], np.cumsum(rest)[:-1]]) if len(rest) else rest
    band = np.minimum(shared - 1, (before / max(1.0, rest.sum()) * (shared - 1)).astype(int))
    band[rest == 0] = shared - 1
    out = np.empty(len(counts), np.int64)
    out[order[:own]] = np.arange(min(own, len(counts)))
    out[order[own:]] = own + band
    return out


def inside(counts: np.ndarray, of: np.ndarray, number: int) -> np.ndarray:
    """Log probability of each id among those of its class, half a count added to each."""
    smooth = counts + 0.5
    return np.log(smooth / np.bincount(of, smooth, number)[of]).astype(np.float32)


@dataclass
class Network:
    """The weights, and the classes that ids are read and predicted by."""

    weights: dict[str, np.ndarray]
    read: np.ndarray
    predicted: np.ndarray
    within: np.ndarray
    start: int
    tables: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    @classmethod
    def untrained(cls, counts: np.ndarray, start: int) -> Network:
        """From the subwords' counts: before any training it predicts by their frequency."""
        numbers = np.random.default_rng(11)
        read, predicted = classes(counts, *READ), classes(counts, *PREDICTED)
        mass = np.bincount(predicted, counts + 0.5, sum(PREDICTED)) + 1e-9
        shapes = {"code": (sum(READ), WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "m": (WIDTH, WIDTH)}
        weights = {name: numbers.normal(0, 1.0 if name == "code" else WIDTH**-0.5, shape) for name, shape in shapes.items()}
        weights["m_bias"] = np.zeros(WIDTH)
        # Nearer tokens count for more to begin with.
        weights["distance"] = np.outer(np.linspace(1.0, 0.2, HEADS), -np.arange(2.0 * SPAN) / 2)
        weights["out"] = np.zeros((WIDTH, sum(PREDICTED)))
        weights["out_bias"] = np.log(mass / mass.sum())
        weights = {name: value.astype(np.float32) for name, value in weights.items()}
        return cls(weights, read, predicted, inside(counts, predicted, sum(PREDICTED)), start)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[name].ravel() for name in sorted(self.weights)])

    def with_flat(self, values: np.ndarray) -> Network:
        weights, at = {}, 0
        for name in sorted(self.weights):
            size = self.weights[name].size
            weights[name] = values[at : at + size].reshape(self.weights[name].shape).astype(np.float32, copy=True)
            at += size
        return Network(weights, self.read, self.predicted, self.within, self.start)

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """(context, new tokens, token after them) of each window of a text; ABSENT where there is none."""
        count = -(-len(ids) // SPAN)
        padded = np.full((count + 1) * SPAN + 1, ABSENT, np.uint32)
        padded[SPAN] = self.start
        padded[SPAN + 1 : SPAN + 1 + len(ids)] = ids
        return np.lib.stride_tricks.sliding_window_view(padded, 2 * SPAN + 1)[:: SPAN][:count]

    def forward(self, windows: np.ndarray) -> dict[str, np.ndarray]:
        """All intermediate values for a batch of windows."""
        w, n = self.weights, len(windows)
        present = windows[:, :-1] != ABSENT
        read = self.read[np.where(present, windows[:, :-1], 0)]
        x = w["code"][read]

        def heads(name: str, part: np.ndarray) -> np.ndarray:
            return (part.reshape(-1, WIDTH) @ w[name]).reshape(n, -1, HEADS, WIDTH // HEADS).transpose(0, 2, 1, 3)

        new = x[:, SPAN:]
        q, k, v = heads("q", new), heads("k", x), heads("v", x)
        apart = np.arange(SPAN, 2 * SPAN)[:, None] - np.arange(2 * SPAN)
        bias = np.where(apart >= 0, w["distance"][:, np.maximum(apart, 0)], np.float32(-1e9))
        energy = q @ k.transpose(0, 1, 3, 2)
        energy *= np.float32((WIDTH // HEADS) ** -0.5)
        energy += bias
        if not present.all():
            energy += np.where(present, np.float32(0), np.float32(-1e9))[:, None, None, :]
        energy -= energy.max(axis=-1, keepdims=True)
        np.exp(energy, out=energy)
        energy /= energy.sum(axis=-1, keepdims=True)
        mixed = (energy @ v).transpose(0, 2, 1, 3).reshape(-1, WIDTH)
        flat = new.reshape(-1, WIDTH)
        bend = np.tanh(flat @ w["m"] + mixed @ w["o"] + w["m_bias"])
        hidden = flat + bend
        logits = hidden @ w["out"]
        logits += w["out_bias"]
        return {"read": read, "x": x, "q": q, "k": k, "v": v, "apart": apart, "attention": energy, "mixed": mixed, "bend": bend, "hidden": hidden, "logits": logits}

    def log_probability(self, windows: np.ndarray) -> np.ndarray:
        """Natural log of each window's new tokens' joint probability.

        The same as ``forward``, from tables by class that are made once.
        """
        if not self.tables:
            self.tables = self._tabled()
        t, n = self.tables, len(windows)
        first = np.flatnonzero(windows[:, 0] == ABSENT)
        read = t["read"].take(windows[:, :-1], mode="clip")
        x, bend, q = (t[name].take(read[:, SPAN:], axis=0) for name in ("x", "m", "q"))
        kv = t["kv"].take(read, axis=0)
        size = WIDTH // HEADS
        mixed = np.empty((n, SPAN, WIDTH), np.float32)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            for head in range(HEADS):
                k, v = kv[:, :, head, :size], kv[:, :, head, size:]
                energy = q[:, :, head * size : (head + 1) * size] @ k.transpose(0, 2, 1)
                np.exp(energy, out=energy)
                energy *= t["near"][head]
                energy[first, :, :SPAN] = 0
                # The values' last column is one, which adds the shares up.
                shares = energy @ v
                np.divide(shares[:, :, :size], shares[:, :, size:], out=mixed[:, :, head * size : (head + 1) * size])
            bend = bend.reshape(-1, WIDTH)
            bend += mixed.reshape(-1, WIDTH) @ self.weights["o"]
            np.tanh(bend, out=bend)
            bend += x.reshape(-1, WIDTH)
            logits = bend @ self.weights["out"]
            targets = windows[:, SPAN + 1 :].ravel()
            there = targets != ABSENT
            aimed = t["predicted"].take(targets, mode="clip")
            found = logits[np.arange(len(logits)), aimed] + t["out_bias"].take(aimed) + t["within"].take(targets, mode="clip")
            np.exp(logits, out=logits)
            logs = found - np.log(logits @ t["out_mass"])
        if not np.isfinite(logs[there]).all():
            logs = self._carefully(windows)
        return np.where(there, logs, 0).reshape(n, SPAN).sum(axis=1, dtype=np.float64)

    def _tabled(self) -> dict[str, np.ndarray]:
        """What depends on a token's class alone, for every class."""
        w, size = self.weights, WIDTH // HEADS
        apart = np.arange(SPAN, 2 * SPAN)[:, None] - np.arange(2 * SPAN)
        k, v = ((w["code"] @ w[name]).reshape(-1, HEADS, size) for name in ("k", "v"))
        ones = np.ones((*v.shape[:2], 1), np.float32)
        return {
            "read": self.read.astype(np.int32),
            "predicted": self.predicted.astype(np.int32),
            "within": self.within,
            "x": w["code"],
            "m": w["code"] @ w["m"] + w["m_bias"],
            "q": w["code"] @ w["q"] * np.float32(size**-0.5),
            "kv": np.ascontiguousarray(np.concatenate([k, v, ones], axis=2)),
            "near": np.where(apart >= 0, np.exp(w["distance"][:, np.maximum(apart, 0)]), np.float32(0)),
            "out_bias": w["out_bias"],
            "out_mass": np.exp(w["out_bias"]),
        }

    def _carefully(self, windows: np.ndarray) -> np.ndarray:
        """Logs for weights that leave the range of the short way."""
        logits = self.forward(windows)["logits"].astype(np.float64)
        targets = np.where(windows[:, SPAN + 1 :] != ABSENT, windows[:, SPAN + 1 :], 0).ravel()
        top = logits.max(axis=1)
        norm = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        return logits[np.arange(len(logits)), self.predicted[targets]] - norm + self.within[targets]

    def slopes(self, windows: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean loss of the windows' new tokens."""
        w, s, n = self.weights, self.forward(windows), len(windows)
        targets = windows[:, SPAN + 1 :].ravel()
        there = targets != ABSENT
        logits = s["logits"]
        if not abs(logits).max() < STEEP:
            logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        share = (there / max(1, there.sum())).astype(logits.dtype)
        logits *= (share / (logits @ np.ones(logits.shape[1], logits.dtype)))[:, None]
        logits[np.arange(len(logits)), self.predicted[np.where(there, targets, 0)]] -= share
        d_hidden = logits @ w["out"].T
        d_bend = d_hidden * (1 - s["bend"] ** 2)
        flat = s["x"][:, SPAN:].reshape(-1, WIDTH)
        out = {"out": s["hidden"].T @ logits, "out_bias": np.ones(len(logits), logits.dtype) @ logits, "m": flat.T @ d_bend, "o": s["mixed"].T @ d_bend, "m_bias": d_bend.sum(axis=0)}
        d_new = d_hidden + d_bend @ w["m"].T
        d_mixed = (d_bend @ w["o"].T).reshape(n, SPAN, HEADS, -1).transpose(0, 2, 1, 3)
        attention = s["attention"]
        d_v = attention.transpose(0, 1, 3, 2) @ d_mixed
        d_attention = d_mixed @ s["v"].transpose(0, 1, 3, 2)
        d_energy = attention * (d_attention - (d_attention * attention).sum(axis=-1, keepdims=True))
        by_place = d_energy.sum(axis=0)
        out["distance"] = np.stack([np.bincount(np.maximum(s["apart"], 0).ravel(), (by_place[h] * (s["apart"] >= 0)).ravel(), 2 * SPAN) for h in range(HEADS)])
        d_energy *= np.float32((WIDTH // HEADS) ** -0.5)
        d_q, d_k = d_energy @ s["k"], d_energy.transpose(0, 1, 3, 2) @ s["q"]

        def back(names: str, part: np.ndarray, *slopes: np.ndarray) -> np.ndarray:
            """Slopes of some maps of one input, and of that input."""
            slope = np.concatenate([slope.transpose(0, 2, 1, 3).reshape(-1, WIDTH) for slope in slopes], axis=1)
            out.update(zip(names, np.split(part.reshape(-1, WIDTH).T @ slope, len(names), axis=1)))
            return (slope @ np.concatenate([w[name].T for name in names])).reshape(part.shape)

        d_x = back("kv", s["x"], d_k, d_v)
        d_x[:, SPAN:] += back("q", s["x"][:, SPAN:], d_q) + d_new.reshape(n, SPAN, WIDTH)
        code = np.zeros_like(w["code"])
        read, d_flat = s["read"].ravel(), d_x.reshape(-1, WIDTH)
        for column in range(WIDTH):
            code[:, column] = np.bincount(read, d_flat[:, column], len(code))
        out["code"] = code
        return out


class Adam:
    """One task's steps from the common weights."""

    def __init__(self, network: Network, rate: float = RATE):
        self.network, self.rate, self.steps = network, rate, 0
        self.first = {name: np.zeros_like(value) for name, value in network.weights.items()}
        self.second = {name: np.zeros_like(value) for name, value in network.weights.items()}

    def step(self, windows: np.ndarray) -> None:
        self.steps += 1
        warm = self.rate * min(1.0, self.steps / 8)
        for name, slope in self.network.slopes(windows).items():
            first, second = self.first[name], self.second[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            change = (first / (1 - 0.9**self.steps)) / (np.sqrt(second / (1 - 0.99**self.steps)) + 1e-8)
            self.network.weights[name] -= (warm * change).astype(np.float32)


def _prepare(model_path: str):
    """Counts of the words, and each round's windows, packed: all windows of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = subwords(model_path)
        cutter = Network({}, *[np.empty(0)] * 3, coder.start)
        counted: list[pa.Table] = []
        gathered: list[list[np.ndarray]] = [[] for _ in range(ROUNDS)]

        def rows(total: pa.Table) -> pa.RecordBatch:
            numbers, packed = [], []
            for number, part in enumerate(gathered):
                whole = np.concatenate(part).astype(coder.kind) if part else []
                for at in range(0, len(whole), ROW_WINDOWS):
                    numbers.append(number)
                    packed.append(whole[at : at + ROW_WINDOWS].tobytes())
                part.clear()
            word, n = (total.column(name).combine_chunks() for name in ("word", "n"))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([-1] * len(word) + numbers), pa.int32()),
                    pa.concat_arrays([word.cast(pa.string()), pa.nulls(len(numbers), pa.string())]),
                    pa.concat_arrays([n, pa.array([0] * len(numbers), pa.int64())]),
                    pa.concat_arrays([pa.nulls(len(word), pa.binary()), pa.array(packed, pa.binary())]),
                ],
                ["round", "word", "n", "windows"],
            )

        def summed() -> pa.Table:
            return pa.concat_tables([NOTHING, *counted]).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        held = 0
        for batch in slices(batches, 1024):
            words = words_of(batch.column("text"))
            n = np.bincount(words.numbers, minlength=len(words.distinct) + 1)[:-1]
            counted.append(pa.table({"word": words.distinct, "n": n}, NOTHING.schema))
            for name, ids in zip(batch.column("doc_id").to_pylist(), coder.sequences(words)):
                windows = cutter.windows(ids)
                turn = crc32(str(name).encode()) % ROUNDS
                for number in range(ROUNDS):
                    gathered[number].append(windows[(number - turn) % ROUNDS :: ROUNDS])
                held += len(windows)
            total = NOTHING
            if sum(map(len, counted)) >= COUNTED:
                total = summed()
                if len(total) < COUNTED // 2:
                    counted, total = [total], NOTHING
                else:
                    counted = []
            if len(total) or held >= HELD:
                held = 0
                yield rows(total)
        yield rows(summed())

    return run


def _unpacked(packed: bytes, kind: np.dtype) -> np.ndarray:
    windows = np.frombuffer(packed, kind).reshape(-1, 2 * SPAN + 1)
    return np.where(windows == np.iinfo(kind).max, np.uint32(ABSENT), windows.astype(np.uint32))


def _train(shared, number: int, kind: np.dtype):
    """One task's weights after its windows of the round, as whole numbers times the tokens behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A step's arrays are of the same sizes as those of the step before.
        with kept_memory():
            yield from learned(batches)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        network = network.with_flat(network.flat())
        descent = Adam(network, RATE / (1 + number / 2))
        first: list[np.ndarray] = []
        tokens, left = 0, np.empty((0, 2 * SPAN + 1), np.uint32)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                new = _unpacked(packed, kind)
                tokens += int((new[:, SPAN + 1 :] != ABSENT).sum())
                left = np.concatenate([left, new])
                if len(first) < LEAST_STEPS:
                    first += [left[at : at + BATCH] for at in range(0, len(left) - BATCH + 1, BATCH)][:LEAST_STEPS]
                while len(left) >= BATCH:
                    descent.step(left[:BATCH])
                    left = left[BATCH:]
        if len(left):
            descent.step(left)
            first.append(left)
        while first and descent.steps < LEAST_STEPS:
            descent.step(first[descent.steps % len(first)])
        if tokens:
            values = np.rint(network.flat().astype(np.float64) * FIXED_POINT).astype(np.int64) * tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values)), pa.int32()), pa.array(values), pa.array(np.full(len(values), tokens, np.int64))],
                ["place", "value", "tokens"],
            )

    return run


@dataclass
class LanguageModel:
    """A network with its vocabulary, and the counts of the words it has seen."""

    network: Network
    model_path: str
    counts: DataFrame
    tokens: int
    distinct: int
    texts: int


def fit(docs: DataFrame, learn: Column, model_path: str) -> LanguageModel:
    """Learn from the documents that satisfy ``learn``.

    NULL and empty texts are an end alone. Rows that repeat are learned from as
    often. Without any documents every id is equally likely.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    taught = docs.where(learn).select("doc_id", "text")
    prepared = written(taught.mapInArrow(_prepare(model_path), "round int, word string, n long, windows binary"), "prepared", group_bytes=GROUP_BYTES)
    counts = written(prepared.where("round = -1").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    texts = taught.count()
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = subwords(model_path)
        total = np.zeros(coder.size, np.int64)
        for batch in slices(batches, 4096):
            ids, sizes = coder.spelled(batch.column("word"))
            np.add.at(total, ids, np.repeat(batch.column("n").to_numpy(), sizes))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["id", "n"])

    coder = subwords(model_path)
    frequency = np.zeros(coder.size, np.int64)
    frequency[coder.end] = texts
    # One row for each id of the vocabulary at most.
    for row in counts.mapInArrow(split, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        frequency[row["id"]] += row["n"]
    network = Network.untrained(frequency, coder.start)
    packed = prepared.where("round >= 0").groupBy("round").agg(F.sum(F.octet_length("windows")).alias("bytes"))
    sizes = {row["round"]: row["bytes"] // (coder.kind.itemsize * (2 * SPAN + 1)) for row in packed.collect()}
    files = len(prepared.inputFiles())
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(network)
        # As many tasks as there are windows for, at most one for each file, however many row groups it has: more tasks learn less each.
        tasks = max(1, min(files, sizes.get(number, 0) // (BATCH * LEAST_STEPS)))
        own = prepared.where(F.col("round") == number).select("windows").coalesce(tasks)
        learned = own.mapInArrow(_train(shared, number, coder.kind), "place int, value long, tokens long")
        means = learned.groupBy("place").agg((F.sum("value") / F.sum("tokens") / FIXED_POINT).alias("value")).toPandas()
        if len(means):
            network = network.with_flat(means.sort_values("place")["value"].to_numpy())
    return LanguageModel(network, model_path, counts, int(sums["n"]) + texts, int(sums["v"]) + bool(texts), texts)


def _frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[DataFrame, Column]:
    """The words that go to all workers, ``most`` at the most, and the condition that tells them: by count and length."""
    short = F.octet_length("word") <= FREQUENT_BYTES
    step = F.floor(F.log2("n") * 8)
    least, total = None, 0
    for row in counts.where(short).groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    known = short & (step >= least) if least is not None else F.lit(False)
    return counts.where(known), known


def _score(model_path: str, shared, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_memory():
            yield from scored(batches)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, network = subwords(model_path), shared.value
        spelling = frequent.value
        for batch in slices(batches, 1024):
            words = words_of(batch.column("text"))
            begins, count = words.begins, len(words.distinct)
            known = pc.fill_null(pc.index_in(words.distinct, value_set=spelling.words), -1).to_numpy().astype(np.int64)
            at = np.append(known, -1)[words.numbers]
            rare = (at < 0) & (words.numbers < count)
            rarely = np.add.reduceat(rare.astype(np.int64), begins)
            sizes = words.ends - begins
            windows = [network.windows(ids) for ids in coder.sequences(words, known, spelling)]
            firsts = np.cumsum([0, *map(len, windows[:-1])])
            windows = np.concatenate(windows)
            each = np.concatenate([network.log_probability(windows[at : at + STEP]) for at in range(0, len(windows), STEP)])
            ends = pa.array(np.append(0, np.cumsum(rarely)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("held_out"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sizes - 1 - rarely),
                    pa.array(np.add.reduceat(spelling.logs[at], begins)),
                    pa.ListArray.from_arrays(ends, words.distinct.take(pa.array(words.numbers[rare])).cast(pa.string())),
                    pa.array(np.add.reduceat(each, firsts) / math.log(10)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "rare", "score"],
            )

    return run


def score(docs: DataFrame, model: LanguageModel, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words and one end. ``base_score`` is the sum of the tokens'
    log10 frequencies in training, half a count added to each and to an unseen
    one; ``score`` is the model's log10 probability of the text's subwords and
    the end. A NULL or empty text has the end alone. Counts of frequent words
    go to all workers, which look most words up where the texts are; the other
    words are joined to their counts. Other columns are not looked at.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    frequent, known = _frequent(model.counts)
    # Bounded by FREQUENT words of FREQUENT_BYTES each.
    rows = frequent.collect()
    logs = np.log10(np.array([row["n"] for row in rows] + [0]) + 0.5)
    logs[-1] = 0.0
    words = pa.array([row["word"] for row in rows], pa.large_string())
    ids, sizes = subwords(model.model_path).spelled(words)
    words = spark.sparkContext.broadcast(Spelling(words, logs, ids, np.append(np.cumsum(sizes) - sizes, 0), np.append(sizes, 0)))
    shared = spark.sparkContext.broadcast(model.network)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, rare array<string>, score double"
    looked = docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(_score(model.model_path, shared, words), schema)
    looked = written(looked.withColumn("row", F.monotonically_increasing_id()), "scored")
    asked = looked.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    seen = model.counts.where(~known).select("word", "n")
    rare = (
        asked.join(seen, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("rare_base"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    norm = math.log10(model.tokens + 0.5 * (model.distinct + 1))
    end = math.log10(model.texts + 0.5)
    return looked.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + int(model.texts > 0)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + end - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )
