"""Language identification: family first, then pairs of languages within it.

Texts are hashed letter n-grams of one to three. Linear support vector machines
tell language families apart, one against one; inside a family another set of
them, one for each pair of its languages, only has to separate close relatives.

The machines are fitted on a bounded sample, so many documents of each language;
prediction covers whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, one_text, small_or_shuffled, written

BUCKET_BITS = 11
BUCKETS = 1 << BUCKET_BITS
# Documents of each language to fit on at most, and of all together.
PER_LANGUAGE = 1500
SAMPLE = 9000
BLOCK = 1 << 20
UNDETERMINED = "und"

# Families of language codes. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk", "bg"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "gd", "cy", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "semitic": ("ar", "he", "am", "mt"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne", "si"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "sinitic": ("zh", "yue"),
    "malayic": ("id", "ms", "jv", "su"),
}


def family_of(language: str) -> str:
    base = language.lower().split("-")[0].split("_")[0]
    return next((family for family, codes in FAMILIES.items() if base in codes), f"only:{language}")


_LETTERS: list[np.ndarray] = []


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str | None) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length one; anything but letters is one blank."""
    if not _LETTERS:
        codes = np.arange(0x10000)
        letter = np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in codes])
        _LETTERS.append(np.where(letter, codes, 32).astype(np.uint32))
    out = np.zeros(BUCKETS)
    text = (text or "").lower()
    shift = np.uint32(32 - BUCKET_BITS)
    # Blocks bound the memory; each one takes the last two characters of the one before along.
    tail = np.empty(0, np.uint32)
    for start in range(0, len(text), BLOCK):
        part = text[start : start + BLOCK]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(codes < 0x10000, _LETTERS[0][np.minimum(codes, 0xFFFF)], codes)
        blank = codes == 32
        codes = codes[~(blank & np.concatenate([[len(tail) > 0 and tail[-1] == 32], blank[:-1]]))]
        joined = np.concatenate([tail, codes])
        one = joined * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (joined[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (joined[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        for grams, old in ((one, len(tail)), (two, max(0, len(tail) - 1)), (three, 0)):
            out += np.bincount((grams[old:] >> shift).astype(np.int64), minlength=BUCKETS)
        tail = joined[-2:]
    out = np.sqrt(out)
    return (out / max(1e-9, np.sqrt((out**2).sum()))).astype(np.float32)


@dataclass
class Pairs:
    """One linear machine for each pair of classes; the class with most wins, then margins, is taken."""

    classes: list[str]
    weights: np.ndarray
    biases: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Class, and the least chance with which it beat another one (1 if it is alone)."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margins = self.weights @ x + self.biases
        wins, sums = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), margin in zip(combinations(range(len(self.classes)), 2), margins):
            wins[a if margin >= 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
        best = max(range(len(self.classes)), key=lambda i: (wins[i], sums[i], -i))
        own = [m if a == best else -m for (a, b), m in zip(combinations(range(len(self.classes)), 2), margins) if best in (a, b)]
        return self.classes[best], float(1 / (1 + np.exp(-2 * np.clip(min(own), -15, 15))))


def fit_pair(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 120, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias of a squared-hinge machine; y is 1 or -1. Both sides weigh the same."""
    w, b = np.zeros(x.shape[1]), 0.0
    even = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        short = np.maximum(0, 1 - y * (x @ w + b)) * y * even
        grad = np.append(penalty * w - 2 * (short @ x), -2 * short.sum())
        first += 0.1 * (grad - first)
        second += 0.01 * (grad**2 - second)
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w.astype(np.float32), b


def fit_pairs(x: np.ndarray, names: np.ndarray) -> Pairs:
    classes = sorted(set(names))
    fitted = []
    for a, b in combinations(classes, 2):
        chosen = (names == a) | (names == b)
        fitted.append(fit_pair(x[chosen], np.where(names[chosen] == a, 1.0, -1.0)))
    weights = np.array([f[0] for f in fitted], np.float32).reshape(-1, x.shape[1])
    return Pairs(classes, weights, np.array([f[1] for f in fitted]))


@dataclass
class Hierarchy:
    families: Pairs
    languages: dict[str, Pairs]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        x = features(text)
        family, sure = self.families.predict(x)
        language, within = self.languages[family].predict(x)
        return language, sure * within


def sampled(rows: DataFrame, each: int) -> DataFrame:
    """(lang, doc_id): the first ``each`` ids of every language by a hash of id and language.

    Only ids below a bound on the hash are ranked. It follows from the number of
    the language's ids, so that about twice as many as wanted stay, whatever
    share of the rows a language or an id has.
    """
    hashed = rows.select("lang", "doc_id", F.xxhash64("doc_id", "lang").alias("order"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    bounds = sizes.select("lang", (F.lit(float(2 * each + 64)) / F.greatest("ids", F.lit(1))).alias("share"))
    low = F.shiftrightunsigned("order", 11) / float(1 << 53) < F.col("share")
    few = hashed.join(small_or_shuffled(written(bounds, "languages")), "lang").where(low)
    ranked = Window.partitionBy("lang").orderBy("order", "doc_id")
    few = few.select("lang", "doc_id", "order").distinct().withColumn("rank", F.row_number().over(ranked))
    return few.where(F.col("rank") <= each).select("lang", "doc_id")


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Hierarchy:
    """Fit on documents that satisfy ``learn`` and have lang.

    Of each language the first ``per_language`` ids by a hash are taken, fewer if
    ``sample`` would not suffice for all languages, and one text of each id;
    texts without a letter teach nothing. The driver gets ``sample`` rows at
    most, so of more languages than that some are not learned. Without documents
    to learn from everything is undetermined. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    languages = rows.agg(F.count_distinct("lang")).first()[0]
    each = min(per_language, max(1, sample // max(1, languages)))
    ids = sampled(rows, each).orderBy("doc_id", "lang").limit(sample)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "lang"]].assign(x=[features(text).tobytes() for text in batch["text"]])

    lettered = rows.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(ids), ["lang", "doc_id"])
    lettered = one_text(lettered, "lang", "doc_id")
    chosen = lettered.mapInPandas(hashed, "doc_id long, lang string, x binary").toPandas()
    if not len(chosen):
        return Hierarchy(Pairs([], np.zeros((0, BUCKETS)), np.zeros(0)), {})
    chosen = chosen.sort_values(["doc_id", "lang"], kind="stable")
    x = np.frombuffer(b"".join(chosen["x"]), np.float32).reshape(-1, BUCKETS)
    names = chosen["lang"].to_numpy(str)
    families = np.array([family_of(name) for name in names])
    return Hierarchy(
        fit_pairs(x, families),
        {family: fit_pairs(x[families == family], names[families == family]) for family in sorted(set(families))},
    )


def identify(hierarchy: Hierarchy, text: Column | str) -> Column:
    """(lang, score): a learned language, or ``und`` with score 0 for NULL and texts without a letter.

    Very long texts count whole, in blocks. Every row is predicted by its own text.
    """

    @F.pandas_udf("lang string, score double")
    def identified(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([hierarchy.predict(value) for value in texts], columns=["lang", "score"])

    return identified(text)
