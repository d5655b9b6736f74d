"""Importance resampling against plain sums."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, items, percent=5, least=20):
    s = Counter(bucket(f) for _, text in docs for f in runs(text)[1])
    t = Counter(bucket(f) for text in items for f in runs(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        n, found = runs(text)
        weight = sum(gain[bucket(f)] for f in found)
        draw = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((draw + 0.5) / 4294967296)))])
    able = sorted((row for row in rows if row[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    ranks = {id(row): at + 1 for at, row in enumerate(drawn)}
    return sorted(((*row, ranks.get(id(row))) for row in rows), key=str)


def found(docs, items):
    return sorted((tuple(row) for row in importance.resample(docs, items).collect()), key=str)


def test_words_and_runs():
    text = "Ab, cd-EF 12 é ü\t_x  ÀB"
    count, plain = runs(text)
    n, buckets = importance.features(text)
    assert n == count and sorted(buckets) == sorted(map(bucket, plain))
    assert importance.features(None)[0] == 0 and len(importance.features("one")[1]) == 1


@pytest.mark.parametrize("most", [1, 2, 7, 1000, 10**7])
def test_planes_add_up(most):
    numbers = np.random.default_rng(most)
    gained = importance.Gains(numbers.integers(-20_000, 20_000, 10_000))
    buckets = np.repeat(numbers.integers(0, 10_000, 50), numbers.integers(0, min(most, 10**5) + 1, 50))
    assert gained.weight(buckets) == int(gained.values[buckets].sum())
    counts = numbers.integers(0, most, 130)
    sliced = importance.planes(counts)
    bits = np.unpackbits(sliced.view(np.uint8), axis=1)[:, :130].astype(np.int64)
    assert (sum(bits[b] << b for b in range(len(bits))) == counts).all()


def test_whole_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "benchmark"))
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()])
    assert found(docs, items) == expected
    assert sum(row[-1] is not None for row in expected) > 2


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(25))
    rows = [(None, words), (1, None), (2, ""), (3, "--- !!"), (4, "long " * 60_000), *[(5, words)] * 30, (6, words + " x")]
    rows += [(i, f"{words} {i}") for i in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumns({c: F.lit("clash") for c in ("weight", "score", "position", "row", "n_words")})
    items = spark.createDataFrame([(1, "w1 w2 w3"), (None, None), (2, "")], "item_id BIGINT, text STRING")
    assert found(docs, items) == brute(rows, ["w1 w2 w3"])
    assert found(docs.limit(0), items) == []
    assert found(docs, items.limit(0)) == brute(rows, [])
