"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Items are cut into windows of ten words. Each window, normalised to words
between single blanks, is one pattern of the automaton; each document is
normalised the same way, scanned once, and its hits are mapped back to word and
character positions of the original text.

Windows go to the executors in blocks of bounded size, one automaton and one
scan for each block, so that a benchmark of any size passes. Documents are never
shuffled while the windows fit in one block; beyond that, only the hits are.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, slices, text_key, written

WORDS_IN_WINDOW = 10
# Bytes of windows in one automaton; a trie node takes some 30 bytes for each.
BLOCK_BYTES = 8 << 20
# Runs of digits, a-z and everything beyond ASCII, once A-Z is lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
HITS = "doc_id long, key long, row long, n_words long, hit_words array<struct<first: long, last: long>>, hit_spans array<struct<start: long, end: long>>, items array<string>"


def windows_of(text: str | None, width: int = WORDS_IN_WINDOW) -> list[str]:
    """Every run of ``width`` words; all the words of a shorter text; nothing without words."""
    words = WORD.findall((text or "").translate(LOWER))
    last = max(0, len(words) - width)
    return [" ".join(words[i : i + width]) for i in range(last + 1)] if words else []


class Scanner:
    """The automaton over (window, ids of the items that have it)."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.items = [ids for _, ids in windows]
        self.automaton = ahocorasick.Automaton()
        for number, (window, _) in enumerate(windows):
            self.automaton.add_word(f" {window} ", (number, window.count(" ") + 1))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]], list[str]]:
        """Number of words; runs of hit words and the characters they cover, end exclusive; items."""
        found = list(WORD.finditer((text or "").translate(LOWER)))
        if not found or not len(self.automaton):
            return len(found), [], [], []
        starts, length = [], 1
        for match in found:
            starts.append(length)
            length += match.end() - match.start() + 1
        plain = " " + " ".join(match.group() for match in found) + " "
        numbers: set[int] = set()
        runs: list[list[int]] = []
        # Matches come by their ends, so a longer one may reach back over earlier runs.
        for end, (number, width) in self.automaton.iter(plain):
            numbers.add(number)
            last = bisect.bisect_left(starts, end)
            first = last - width
            while runs and runs[-1][1] > first:
                first = min(first, runs.pop()[0])
            runs.append([first, last])
        items = sorted({item for number in numbers for item in self.items[number]})
        spans = [(found[first].start(), found[last - 1].end()) for first, last in runs]
        return len(found), [(first, last) for first, last in runs], spans, items


def _windows(items: DataFrame, width: int) -> DataFrame:
    """(window, items): every distinct window with the sorted ids that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs = [
                (item, window)
                for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist())
                for window in set(windows_of(text, width))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
                ["item", "window"],
            )

    texts = items.select(F.col("item_id").cast("string").alias("item"), "text").where("item is not null")
    pairs = texts.mapInArrow(run, "item string, window string")
    return pairs.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _merged_runs(column: str, start: str, end: str):
    """Runs of several blocks as disjoint runs, in order; runs that only touch stay apart, as in a scan."""
    kind = f"array<struct<{start}: bigint, {end}: bigint>>"
    return F.expr(f"""
        aggregate(array_sort(flatten(collect_list({column}))), cast(array() as {kind}), (runs, run) ->
            if(size(runs) > 0 and element_at(runs, -1).{end} > run.{start},
               concat(slice(runs, 1, size(runs) - 1),
                      array(named_struct('{start}', element_at(runs, -1).{start},
                                         '{end}', greatest(element_at(runs, -1).{end}, run.{end})))),
               concat(runs, array(run))))
    """)


def find_leaks(docs: DataFrame, items: DataFrame, width: int = WORDS_IN_WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, key (a hash of the text), n_words, hit_words, hit_spans, items.

    ``hit_words`` and ``hit_spans`` are disjoint runs in order (overlapping hits joined), of word numbers
    and of characters of the original text, ends exclusive. ``items`` are the
    ids, as text, with a window in the document. NULL and empty texts have no
    words. Items without id or words are passed over; rows that repeat an
    item_id add up; without items nothing is hit. Repeated documents are rows
    of their own, and very long texts are scanned whole. Other columns are not
    looked at.
    """
    bounded_batches(docs.sparkSession)
    windows = written(_windows(items, width), "windows")
    size = windows.agg(F.coalesce(F.sum(F.octet_length("window") + 16 * F.size("items") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    docs = docs.select("doc_id", "text", text_key().alias("key"))
    if blocks > 1:
        # Each block's hits are joined by row, as ids may repeat.
        docs = written(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    else:
        docs = docs.withColumn("row", F.lit(0).cast("long"))
    parts = []
    for number in range(blocks):
        block = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number) if blocks > 1 else windows
        # Bounded: a block holds about ``block_bytes``.
        shared = docs.sparkSession.sparkContext.broadcast([(r.window, r["items"]) for r in block.collect()])
        parts.append(docs.mapInArrow(_scan_with(shared), HITS))
    if blocks == 1:
        return parts[0].drop("row")
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("key").alias("key"),
            F.first("n_words").alias("n_words"),
            _merged_runs("hit_words", "first", "last").alias("hit_words"),
            _merged_runs("hit_spans", "start", "end").alias("hit_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .drop("row")
    )


def _scan_with(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        spans = [
            pa.list_(pa.struct([(name, pa.int64()) for name in names])) for names in (("first", "last"), ("start", "end"))
        ]
        for batch in slices(batches):
            found = [scanner.scan(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("key"),
                    batch.column("row"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([[{"first": a, "last": b} for a, b in f[1]] for f in found], spans[0]),
                    pa.array([[{"start": a, "end": b} for a, b in f[2]] for f in found], spans[1]),
                    pa.array([f[3] for f in found], pa.list_(pa.string())),
                ],
                ["doc_id", "key", "row", "n_words", "hit_words", "hit_spans", "items"],
            )

    return run
