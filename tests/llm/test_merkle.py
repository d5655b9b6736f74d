"""The Merkle manifest against a plain recursive tree."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from smogline.llm import merkle
from smogline.llm.common import in_order

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, text, lang, source, n):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def grown(level):
    """All levels of a tree from its leaves."""
    levels = [level]
    while len(level) > 1:
        level = [h(*level[at : at + 8]) for at in range(0, len(level), 8)]
        levels.append(level)
    return levels


def siblings(levels, place):
    for level in levels[:-1]:
        run = place // 8 * 8
        yield "".join(level[run:place]), "".join(level[place + 1 : run + 8])
        place //= 8


def brute(rows, changed=lambda i, text: text):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root)."""
    langs = sorted({row[2] for row in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((row for row in rows if row[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees.append((own, grown([leaf_of(*row) for row in own])))
    top = grown([levels[-1][0] for _, levels in trees])
    out = []
    for number, (own, levels) in enumerate(trees):
        for place, row in enumerate(own):
            steps = [*siblings(levels, place), *siblings(top, number)]
            i, text, *others = row
            acc = leaf_of(i, changed(i, text), *others)
            for left, right in steps:
                acc = h(left, acc, right)
            proof = h(*(left + right for left, right in steps))
            out.append((i, levels[0][place], levels[-1][0], top[-1][0], proof, acc))
    return sorted(out, key=str)


def lower_some(i, text):
    if i is None or text is None or zlib.crc32(str(i).encode()) % 3:
        return text
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def found(docs, seen=None):
    rows = merkle.manifest(docs, seen).collect()
    assert all(row.verified == (row.folded_root == row.root) for row in rows)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in rows), key=str)


@pytest.mark.parametrize("count", [1, 2, 7, 8, 9, 64, 65, 513, 4096, 4097])
def test_sweeps_are_a_tree(count):
    leaves = [h(str(i)) for i in range(count)]
    levels = grown(leaves)
    root, nodes = merkle.forward(leaves, merkle.height(count))
    assert root == levels[-1][0] and merkle.height(count) == len(levels) - 1
    assert {(level, index) for level, index, _ in nodes} == {(k, i) for k in range(1, len(levels)) for i in range(len(levels[k]))}
    proofs = dict(merkle.backward(nodes, count, None))
    assert sorted(proofs) == list(range(count))
    for place in {0, count // 2, count - 1}:
        assert [(s["left"], s["right"]) for s in merkle._listed(proofs[place])] == list(siblings(levels, place))
        assert merkle.folded(leaves[place], proofs[place])[0] == root


def test_the_queue_holds_few_messages(monkeypatch):
    most = 0
    push = merkle.heapq.heappush

    def counted(queue, item):
        nonlocal most
        push(queue, item)
        most = max(most, len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", counted)
    merkle.forward([h(str(i)) for i in range(4096)], 4)
    assert most <= merkle.FAN * merkle.LEVELS


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    seen = merkle.lowered(F.col("doc_id"), F.col("text"))
    assert found(docs, seen) == brute(rows, lower_some)
    assert all(row[5] == row[3] for row in found(docs))


def test_blocks_of_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FAN)
    rows = [(i * 7 % 1000, f"Text {i}", "en" if i % 3 else f"l{i % 30}", "s", i) for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    seen = merkle.lowered(F.col("doc_id"), F.col("text"))
    # Workers import the module anew: forward() there climbs as many levels as the blocks say.
    blocks, nodes = merkle._climb(
        in_order(docs.select("doc_id", merkle.leaf(F.col("text")).alias("digest")), F.col("doc_id"), position="place").select(
            F.lit(0).cast("long").alias("tree"), "place", F.lit(1).alias("levels"), "digest"
        )
    )
    assert len(blocks) == 1 and nodes.count() == -(-700 // 8)
    del seen


def test_large_language_takes_two_rounds(spark):
    rows = [(i, f"T{i}", "en", None, None) for i in range(9000)] + [(i, None, None, "s", i) for i in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    seen = merkle.lowered(F.col("doc_id"), F.col("text"))
    assert found(docs, seen) == brute(rows, lower_some)


def test_odd_rows(spark):
    rows = [
        (None, "no id", "en", "s", 5),
        (1, None, "en", "s", None),
        (1, "", "en", "s", 0),
        *[(2, "Twice", "en", None, 5)] * 9,
        (3, "É Ü ß", None, "s", 5),
        (4, "LONG " * 100_000, "ß", "s", 500_000),
        (5, "x", "", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("leaf", "tree", "place", "levels", "digest", "position", "row")})
    seen = merkle.lowered(F.col("doc_id"), F.col("text"))
    assert found(docs, seen) == brute(rows, lower_some)
    assert found(docs.where("doc_id = 5"), seen) == brute(rows[-1:], lower_some)
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_places_are_gapless(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") % 40).alias("k"), F.xxhash64("id").alias("v"))
    placed = in_order(rows, F.desc("k"), F.asc("v")).toPandas()
    assert placed.sort_values(["k", "v"], ascending=[False, True]).position.tolist() == list(range(5000))
