"""Merkle manifest of a table by time-forward processing.

Each row is a leaf; rows of one language, in the order of their ids, make a
tree of fan-out eight, and the languages' roots make one more. Nodes are
processed in the order of their labels, children before parents: a node takes
its children's digests from a priority queue ordered by label and sends its own
to its parent's label. The reversed sweep takes a node's proof suffix from the
queue and sends each child the same with the child's siblings in front.

The queue is external. Inside a block of 8^4 consecutive nodes it is a heap,
which holds a few messages for each level; between blocks the messages are
rows, which Spark deals by label. So a round climbs four levels, and no task
holds more than a block, whatever the sizes of languages are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, in_order, small_or_shuffled, written

FAN = 8
# Levels that a block climbs in a round, and the nodes it starts from.
LEVELS = 4
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left: string, right: string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Node = tuple[int, int, list[str]]


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def height(nodes: int) -> int:
    """Levels above so many nodes, up to a single one."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def _label(level: int, index: int, leaves: int) -> tuple[int, int, int]:
    """Nodes by the last leaf below them, lower ones first: children go before their parents."""
    return min((index + 1) * FAN**level, leaves), level, index


def forward(leaves: Sequence[str], levels: int) -> tuple[str, list[Node]]:
    """Root of the leaves after so many levels, and (level, index, children's digests) of each node by label."""
    queue: list[tuple[tuple[int, int, int], int, str]] = []
    nodes: list[Node] = []
    root = leaves[0]

    def send(level: int, index: int, value: str) -> None:
        heapq.heappush(queue, (_label(level + 1, index // FAN, len(leaves)), index, value))

    def deliver(until: int) -> None:
        """Process the nodes whose leaves have all come."""
        nonlocal root
        while queue and queue[0][0][0] <= until:
            label = queue[0][0]
            children = []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            _, level, index = label
            nodes.append((level, index, children))
            root = digest(*children)
            if level < levels:
                send(level, index, root)

    for place, leaf in enumerate(leaves):
        deliver(place)
        if levels:
            send(0, place, leaf)
    deliver(len(leaves))
    return root, nodes


def backward(nodes: list[Node], leaves: int, suffix: tuple | None) -> Iterator[tuple[int, tuple | None]]:
    """(place, proof) of each leaf, last first. A proof is (left, right, the rest), shared with the nodes above."""
    if not nodes:
        yield 0, suffix
        return
    top = _label(nodes[-1][0], nodes[-1][1], leaves)
    queue = [((-top[0], -top[1], -top[2]), suffix)]
    for level, index, children in reversed(nodes):
        _, above = heapq.heappop(queue)
        for at in reversed(range(len(children))):
            child = index * FAN + at
            proof = ("".join(children[:at]), "".join(children[at + 1 :]), above)
            if level == 1:
                yield child, proof
            else:
                end, down, number = _label(level - 1, child, leaves)
                heapq.heappush(queue, ((-end, -down, -number), proof))


def folded(leaf: str, proof: tuple | None) -> tuple[str, str]:
    """The root that a leaf and its siblings give, and the digest of the siblings, lowest level first."""
    siblings = sha256()
    while proof is not None:
        left, right, proof = proof
        siblings.update(f"{left}{right}".encode("ascii"))
        leaf = digest(left, leaf, right)
    return leaf, siblings.hexdigest()


def _chained(steps: list[dict]) -> tuple | None:
    proof = None
    for step in reversed(steps):
        proof = (step["left"], step["right"], proof)
    return proof


def _listed(proof: tuple | None) -> list[dict]:
    steps = []
    while proof is not None:
        left, right, proof = proof
        steps.append({"left": left, "right": right})
    return steps


def leaf(text: Column) -> Column:
    """Digest of a row: each field by its bytes' count and value, ``-`` where it is NULL."""
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time as Python objects."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _blocks(nodes: DataFrame, *values: str) -> DataFrame:
    """One row per block: tree, block, levels left above its nodes, and its nodes' values in order."""
    gathered = F.array_sort(F.collect_list(F.struct("place", *values)))
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.first("levels").alias("levels"), gathered.alias("nodes")
    )
    return written(grouped.select("tree", "block", "levels", *(F.col(f"nodes.{name}").alias(name) for name in values)), "blocks")


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        here = min(LEVELS, row["levels"])
        root, _ = forward(row["digest"], here)
        yield pa.RecordBatch.from_pylist(
            [{"tree": row["tree"], "place": row["block"], "levels": row["levels"] - here, "digest": root}],
            pa.schema([("tree", pa.int64()), ("place", pa.int64()), ("levels", pa.int32()), ("digest", pa.string())]),
        )


def _climbed(blocks: DataFrame) -> DataFrame:
    """The blocks' roots as nodes of the next round."""
    return written(blocks.select("tree", "block", "levels", "digest").mapInArrow(_up, "tree long, place long, levels int, digest string"), "nodes")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of each round, lowest first, and one node for each tree."""
    rounds = []
    while (nodes.agg(F.max("levels")).first()[0] or 0) > 0:
        rounds.append(_blocks(nodes, "digest"))
        nodes = _climbed(rounds[-1])
    return rounds, nodes


def _with_messages(blocks: DataFrame, messages: DataFrame) -> DataFrame:
    return blocks.join(small_or_shuffled(messages.withColumnRenamed("place", "block"), 20_000), ["tree", "block"])


MESSAGE = f"tree long, place long, subroot string, root string, steps {STEPS}"
STEP_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("tree", pa.int64()), ("place", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("steps", STEP_TYPE)])
    for row in _rows(batches):
        leaves = row["digest"]
        _, nodes = forward(leaves, min(LEVELS, row["levels"]))
        out = []
        for place, proof in backward(nodes, len(leaves), _chained(row["steps"])):
            node = row["block"] * BLOCK + place
            out.append({"tree": row["tree"], "place": node, "subroot": row["subroot"], "root": row["root"], "steps": _listed(proof)})
            if len(out) == 256:
                yield pa.RecordBatch.from_pylist(out, kind)
                out = []
        yield pa.RecordBatch.from_pylist(out, kind)


def _descend(rounds: list[DataFrame], messages: DataFrame) -> DataFrame:
    """Messages for the nodes that the climb started from."""
    for blocks in reversed(rounds):
        messages = written(_with_messages(blocks, messages).mapInArrow(_down, MESSAGE), "messages")
    return messages


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        leaves, count = row["digest"], len(row["digest"])
        _, nodes = forward(leaves, min(LEVELS, row["levels"]))
        proofs, roots = [""] * count, [""] * count
        for place, proof in backward(nodes, count, _chained(row["steps"])):
            roots[place], proofs[place] = folded(row["seen"][place], proof)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["doc_id"], pa.int64()),
                pa.array(leaves, pa.string()),
                pa.array([row["subroot"]] * count, pa.string()),
                pa.array([row["root"]] * count, pa.string()),
                pa.array(proofs, pa.string()),
                pa.array(roots, pa.string()),
                pa.array([root == row["root"] for root in roots], pa.bool_()),
            ],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def manifest(docs: DataFrame, seen: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``seen`` is the text as it is found when the manifest is checked, by default
    the text itself: ``folded_root`` is worked out from it and the siblings on
    record, and a row is verified if that is the root. Languages go by their
    UTF-8 bytes, NULL first, and rows by id, NULL first, then by digest; equal
    rows are leaves of their own. NULL and empty texts are told apart. An empty
    table has no rows. Other columns than the five of a leaf are not looked at.
    """
    bounded_batches(docs.sparkSession)
    seen = F.col("text") if seen is None else seen
    leaves = written(
        docs.select("doc_id", "lang", leaf(F.col("text")).alias("digest"), leaf(seen).alias("seen"), F.monotonically_increasing_id().alias("row")),
        "leaves",
    )
    placed = in_order(leaves, F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("row"))
    # A tree is named by the place of its first leaf, which keeps the order of the languages.
    trees = placed.groupBy("lang").agg(F.min("position").alias("tree"), F.count("*").alias("size"))
    levels = F.lit(0)
    for power in range(1, 22):
        levels = levels + F.when(F.col("size") > FAN ** (power - 1), 1).otherwise(0)
    trees = trees.select(F.col("lang").alias("tree_lang"), "tree", levels.alias("levels"))
    named = placed.join(small_or_shuffled(written(trees, "trees")), F.col("lang").eqNullSafe(F.col("tree_lang")))
    lowest = _blocks(named.withColumn("place", F.col("position") - F.col("tree")), "doc_id", "digest", "seen")
    rounds, subroots = _climb(_climbed(lowest))

    ordered = in_order(subroots.select("tree", "digest"), F.col("tree"), position="place")
    count = subroots.count()
    tops = ordered.select(F.lit(0).cast("long").alias("tree"), "place", F.lit(height(count)).alias("levels"), "digest")
    top_rounds, root = _climb(written(tops, "tops"))
    none = F.array().cast(STEPS)
    first = root.select("tree", "place", F.lit("").alias("subroot"), F.col("digest").alias("root"), none.alias("steps"))
    told = _descend(top_rounds, first).select("place", "root", "steps")
    messages = ordered.join(told, "place").select(
        "tree", F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), "root", "steps"
    )
    messages = _descend(rounds, written(messages, "messages"))
    return _with_messages(lowest, messages).mapInArrow(_prove, RESULT)


def lowered(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where 3 divides the CRC-32 of the id; a NULL id changes nothing."""
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return F.when(hit, F.translate(text, UPPER, LOWER)).otherwise(text)
