import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm.components import connected
from smogline.llm.odd_sketch import BANDS, ROWS, Signatures, largest_distance, near_duplicates, shingle_set

DOCS = "doc_id BIGINT, text STRING"


def brute(docs, percent=85):
    """Component of each id, by comparing all pairs."""
    sets = [(doc_id, set(shingle_set(text).tolist())) for doc_id, text in docs if doc_id is not None]
    root = {doc_id: doc_id for doc_id, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, left), (b, right) in combinations(sets, 2):
        shared = len(left & right)
        if shared and 100 * shared >= percent * len(left | right):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {doc_id: find(doc_id) for doc_id, _ in sets}


def found(spark, docs, **options):
    rows = near_duplicates(spark.createDataFrame(docs, DOCS).repartition(5), **options).collect()
    assert len(rows) == len(docs)
    assert all(row.kept == (row.component_id is None or row.doc_id == row.component_id) for row in rows)
    return {row.doc_id: row.component_id for row in rows if row.doc_id is not None}


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def corpus(seed):
    """Singles, copies, a large group of near copies, chains, and a passage that many short texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(60)]
    texts += [texts[0]] * 20 + [texts[1].upper()] * 3
    base = rng.choices(vocabulary, k=200)
    texts += [mutated(rng, base, rng.randint(1, 4)) for _ in range(80)]
    step = rng.choices(vocabulary, k=150)
    for _ in range(25):
        step = mutated(rng, step, 2).split(" ")
        texts.append(" ".join(step))
    passage = " ".join(rng.choices(vocabulary, k=40))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) for _ in range(60)]
    texts += [None, "", "  \n", "one", "ONE", "one two", "one two three four five", "a b\x0bc d", "a b"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = corpus(seed)
    assert found(spark, docs) == brute(docs)


def test_other_threshold(spark):
    docs = corpus(3)
    assert found(spark, docs, percent=92) == brute(docs, 92)
    with pytest.raises(ValueError, match="0.8"):
        near_duplicates(spark.createDataFrame(docs[:1], DOCS), percent=50)


def test_nulls_repeats_and_other_columns(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(4, text), (None, text), (4, text), (9, text), (5, None)], DOCS)
    docs = docs.withColumns({name: F.lit(1) for name in ("id", "band", "kept", "component_id", "high")})
    rows = sorted((row.doc_id or -1, row.n_shingles, row.component_id, row.kept) for row in near_duplicates(docs).collect())
    assert rows == [(-1, 3, None, True), (4, 3, 4, True), (4, 3, 4, True), (5, 0, 5, True), (9, 3, 4, False)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_an_id_with_several_texts_is_one_node(spark):
    rng = random.Random(4)
    a, b, c, d = ([f"{name}{rng.random()}" for _ in range(80)] for name in "abcd")
    docs = [(3, " ".join(a)), (5, " ".join(a)), (5, " ".join(b)), (7, " ".join(b)), (7, None), (8, mutated(rng, b, 1)), (8, " ".join(c))]
    docs += [(2, mutated(rng, c, 1)), (11, " ".join(d)), (11, ""), (12, ""), (13, mutated(rng, d, 1))] + [(20, " ".join(d))] * 60
    # Texts of one id are linked with each other, whatever they are.
    rows = near_duplicates(spark.createDataFrame(docs, DOCS).repartition(3)).collect()
    assert len(rows) == len(docs)
    assert {(row.doc_id, row.component_id) for row in rows} == {
        *((i, 2) for i in (2, 3, 5, 7, 8)), (11, 11), (12, 12), (13, 11), (20, 11)
    }
    assert all(row.kept == (row.doc_id == row.component_id) for row in rows)


def test_sketches_estimate_high_similarity():
    rng = np.random.default_rng(1)
    signatures = Signatures()
    bound = largest_distance(85, BANDS * ROWS)

    def distance(similarity):
        shared = round(600 * similarity)
        sets = rng.integers(0, 2**63, shared + 2 * (600 - shared)).astype(np.uint64)
        left = np.unique(sets[:600])
        right = np.unique(np.concatenate([sets[:shared], sets[600:]]))
        a, b = (signatures.bands_and_sketch(s)[1] for s in (left, right))
        return sum(bin(int(x) & (2**64 - 1)).count("1") for x in a ^ b)

    # A share s of 600 held in common is a Jaccard similarity of s / (2 - s).
    assert all(distance(2 * 0.85 / 1.85) <= bound for _ in range(40))
    assert all(distance(2 * 0.4 / 1.4) > bound for _ in range(40))


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (5, 5), (2, 1), (20, 30), (30, 25)]
    links += [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(1, 60)]
    rows = connected(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    got = {row.id: row.component for row in rows}
    assert len(rows) == len(got)
    assert {got[i] for i in (1, 2, 3, 4)} == {1} and {got[i] for i in (10, 11, 12)} == {10} and got[25] == got[30] == 20
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(200, 260)} == {200} and 5 not in got
    assert connected(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0
