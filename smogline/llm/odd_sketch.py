"""Near-duplicates by MinHash bands, checked with odd sketches, confirmed on full sets.

1. Each text becomes its set of distinct word shingles (64-bit hashes), a digest
   of that set, MinHash samples, band keys over the samples, and an odd sketch:
   a bitmap whose bits are flipped once per sample. In the XOR of two sketches
   the equal samples cancel, so its population count estimates how many samples
   differ, and is precise where similarity is high.
2. Equal sets are one class, named after its least document; only classes go on.
   So copies are linked by one aggregation, however many there are.
3. Bands have pivots, and every class is paired with the pivot that it shares
   most bands with, so pairs grow with the classes and not with the square of a
   group. Sketches throw out the pairs that cannot reach the threshold; the rest
   is confirmed on the full sets, and the links make components. Two more rounds
   compare classes with pivots of other components, a dozen at most.
4. Whatever still shares a band across two components is then searched for all
   its pairs that can be linked, by the rarest of its shingles, and those are
   sifted and confirmed as well, so that no link is lost to the choice of pivots.

With 48 bands of 6 rows, two sets at a similarity of 0.85 share no band once in
10^10 pairs, and the sketch's bound lies 6.5 standard deviations out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, slices, small_or_shuffled, text_key, written
from smogline.llm.components import connected

WORDS_IN_SHINGLE = 5
PERCENT = 85
BANDS = 48
ROWS = 6
SKETCH_BITS = 1024
# Pivots that a class is compared with in a round; the search for open pairs finds what others would link.
PIVOTS = 12
# Pairs with one pivot that go to one task.
SPREAD = 32
# Orders of ids, by XOR with these, that bands take their pivots from.
ORDERS = (0x2545F4914F6CDD1D, 0x1B873593CC9E2D51)
MULTIPLIER = 0x9E3779B97F4A7C15


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, width: int = WORDS_IN_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. A
    text of fewer words than a shingle has one shingle, all its words.
    """
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    sums = np.full(len(words) - size + 1, size, np.uint64)
    for offset in range(size):
        sums = sums * np.uint64(MULTIPLIER) + hashes[offset : len(hashes) - size + offset + 1]
    return np.unique(_mixed(sums))


class Signatures:
    """MinHash samples of shingle sets, their band keys and odd sketches."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS):
        self.bands, self.rows, self.bits = bands, rows, bits
        numbers = np.random.default_rng(20240229)
        size = bands * rows
        self.factors = numbers.integers(0, 2**32, size, np.uint32) | np.uint32(1)
        self.terms = numbers.integers(0, 2**32, size, np.uint32)
        self.places = np.arange(size, dtype=np.uint64) << np.uint64(32)

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), 0xFFFFFFFF, np.uint32)
        for start in range(0, len(low), 2048):
            part = low[start : start + 2048]
            np.minimum(least, (self.factors[:, None] * part + self.terms[:, None]).min(axis=1), out=least)
        return least

    def bands_and_sketch(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        placed = _mixed(self.samples(shingles).astype(np.uint64) | self.places)
        keys = np.zeros(self.bands, np.uint64)
        for row in placed.reshape(self.bands, self.rows).T:
            keys = keys * np.uint64(MULTIPLIER) + row
        flips = np.bincount((placed >> np.uint64(17)).astype(np.int64) % self.bits, minlength=self.bits) & 1
        return _mixed(keys).view(np.int64), np.packbits(flips.astype(np.uint8)).view(np.int64)


def largest_distance(percent: int, samples: int, deviations: float = 6.5) -> int:
    """Bits that sketches of a linked pair can differ in: each differing sample flips at most two."""
    share = percent / 100
    differing = samples * (1 - share) + deviations * math.sqrt(samples * share * (1 - share))
    return 2 * math.ceil(differing)


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, key of the text, n_shingles, high and low half of the set's digest, band keys, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures()
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, width)
                if len(shingles):
                    digest = np.frombuffer(xxhash.xxh128_digest(shingles.tobytes()), np.int64)
                    rows.append((len(shingles), int(digest[0]), int(digest[1]), *signatures.bands_and_sketch(shingles)))
                else:
                    rows.append((0, None, None, None, None))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("key"),
                    *(pa.array(column, pa.int64()) for column in columns[:3]),
                    *(pa.array(column, pa.list_(pa.int64())) for column in columns[3:]),
                ],
                ["doc_id", "key", "n_shingles", "high", "low", "bands", "sketch"],
            )

    return docs.select("doc_id", "text", text_key().alias("key")).mapInArrow(
        run, "doc_id long, key long, n_shingles long, high long, low long, bands array<long>, sketch array<long>"
    )


def _sets(docs: DataFrame, ids: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of the wanted classes, written; each from the text of its first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(text, width).view(np.int64) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    first = written(nodes.select("id", "doc_id", "key").join(small_or_shuffled(ids), "id", "left_semi"), "firsts")
    texts = docs.select("doc_id", "text", text_key().alias("key")).join(small_or_shuffled(first), ["doc_id", "key"])
    sets = written(texts.select("id", "text").mapInArrow(run, "id long, shingles array<long>"), "shingle-sets")
    if sets.count() > first.count():
        # Rows that repeat an id and its text.
        sets = written(sets.groupBy("id").agg(F.first("shingles").alias("shingles")), "shingle-sets")
    return sets


def _both(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) with the columns of both classes, named _a and _b.

    Many classes are paired with one pivot. Such pairs are dealt in parts by a
    hash of b, and each part gets the pivot's columns: about one copy for SPREAD
    pairs, so no task has all pairs of a pivot.
    """
    hot = pairs.groupBy("a").agg(F.count("*").alias("pairs")).where(F.col("pairs") > SPREAD)
    hot = written(hot.select("a", F.ceil(F.col("pairs") / SPREAD).cast("int").alias("parts")), "hot-pivots")
    part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int")
    dealt = pairs.join(small_or_shuffled(hot), "a", "left").withColumn("part", part).drop("parts")
    pivots = rows.join(small_or_shuffled(hot.withColumnRenamed("a", "id")), "id", "left")
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    pivots = pivots.toDF(*("a" if name == "id" else name if name == "part" else f"{name}_a" for name in pivots.columns))
    return dealt.join(_side(rows, "b"), "b").join(pivots, ["a", "part"]).drop("part")


def _distance(left: str, right: str, bits: int = SKETCH_BITS) -> Column:
    """Population count of the XOR of two sketches."""
    words = (F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(bits // 64))
    return reduce(lambda a, b: a + b, words)


def _near(percent: int) -> Column:
    """What a linked pair must fulfil: sizes, and sketches."""
    sizes = F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    return sizes & (_distance("sketch_a", "sketch_b") <= largest_distance(percent, BANDS * ROWS))


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.toDF(*(side if name == "id" else f"{name}_{side}" for name in df.columns))


def _confirmed(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "candidates")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - shared
    both = _both(pairs, _sets(docs, ids, nodes, width))
    return both.where(100 * shared >= percent * union).select("a", "b").distinct()


def _labelled(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """band, id, component: an id without links is its own."""
    return crowded.join(labels, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))


def _first_pairs(crowded: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class b with the one pivot a that it shares most bands with.

    A band's pivot is the first of its classes in one order of all ids, so the
    bands of a group agree on few pivots.
    """
    order = F.lit(ORDERS[0])
    pivots = crowded.groupBy("band").agg(F.min(F.col("id").bitwiseXOR(order)).bitwiseXOR(order).alias("pivot"))
    counted = crowded.join(pivots, "band").where("id <> pivot").groupBy("id", "pivot").agg(F.count("*").alias("bands"))
    best = counted.groupBy("id").agg(F.max_by("pivot", F.struct("bands", "pivot")).alias("a"))
    return written(_sifted(best.select("a", F.col("id").alias("b")), nodes, percent).select("a", "b"), "first-pairs")


def _more_pairs(crowded: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, order: int) -> DataFrame:
    """(a, b): each class b with the nearest by sketch of its bands' pivots a, where these are of other components.

    Here every band has an order of its own, so a class meets as many pivots as
    it has bands, and takes at most PIVOTS of them.
    """
    rows = _labelled(crowded, labels)
    scramble = F.col("band").bitwiseXOR(F.lit(order))
    pivots = rows.groupBy("band").agg(F.min(F.col("id").bitwiseXOR(scramble)).alias("first"))
    pivots = pivots.select("band", F.col("first").bitwiseXOR(scramble).alias("pivot"))
    owners = rows.select("band", F.col("id").alias("pivot"), F.col("component").alias("owner"))
    met = rows.join(pivots.join(owners, ["band", "pivot"]), "band").where("component <> owner")
    sifted = _sifted(met.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), nodes, percent)
    nearest = Window.partitionBy("b").orderBy("distance", "a")
    return written(
        sifted.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= PIVOTS).select("a", "b"), "more-pairs"
    )


def _sifted(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, distance) of the pairs whose sizes and sketches allow a link."""
    both = _both(written(pairs, "pairs"), nodes.select("id", "n", "sketch"))
    return both.where(_near(percent)).select("a", "b", _distance("sketch_a", "sketch_b").alias("distance"))


def _across(docs: DataFrame, crowded: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, width: int) -> DataFrame:
    """Every pair of two components that may be linked, among the classes that still share a band across them.

    Of their shingles, put in one order from rare to frequent, two linked sets
    share one near the beginning: within the first ``n - ceil(t n) + 1`` of the
    larger set, and ``n - ceil(2 t n / (1 + t)) + 1`` of the smaller one. Shingles
    of one set only come first and match nothing, so a group of texts that are
    alike, but not enough, makes no pairs: each has too many of its own.
    """
    rows = _labelled(crowded, labels)
    split = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    unsettled = rows.join(split.select("band"), "band", "left_semi").select("id", "component").distinct()
    unsettled = written(unsettled, "unsettled")
    sets = written(
        _sets(docs, written(unsettled.select("id").distinct(), "unsettled-ids"), nodes, width)
        .join(unsettled, "id")
        .select(F.monotonically_increasing_id().alias("row"), "id", "component", F.size("shingles").alias("n"), "shingles"),
        "unsettled-sets",
    )
    tokens = sets.select("row", F.explode("shingles").alias("shingle"))
    common = tokens.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    ranked = tokens.join(common, "shingle").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("holders", "shingle"))).alias("ranked"))
    own = F.col("n") - F.size("ranked")
    longest = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    shortest = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)).cast("int") + 1
    heads = sets.drop("shingles").join(ranked, "row").where(longest > own)
    prefixes = written(
        heads.select("id", "component", "n", own.alias("own"), shortest.alias("short"), F.posexplode(F.slice("ranked", F.lit(1), longest - own)))
        .select("id", "component", "n", "short", F.col("col.shingle").alias("shingle"), (F.col("own") + F.col("pos")).alias("at")),
        "prefixes",
    )
    small = prefixes.where("at < short").drop("short").toDF("a", "part_a", "n_a", "shingle", "at_a")
    large = prefixes.drop("short").toDF("b", "part_b", "n_b", "shingle", "at_b")
    in_order = (F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))
    sizes = 100 * F.col("n_a") >= percent * F.col("n_b")
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = left * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))
    apart = (F.col("part_a") != F.col("part_b")) & (F.col("a") != F.col("b"))
    return written(small.join(large, "shingle").where(in_order & sizes & apart & enough).select("a", "b").distinct(), "open-pairs")


def _bridged(profiles: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, high, low, linked, component) of the classes: by links alone, and after joining what one doc_id has texts in."""
    linked = F.coalesce("component", "id")
    components = classes.select("id", "high", "low").join(labels, "id", "left")
    components = written(components.select("id", "high", "low", linked.alias("linked"), linked.alias("component")), "components")
    rows = profiles.where("high is not null and doc_id is not null")
    digest = F.struct("high", "low")
    several = rows.groupBy("doc_id").agg(F.min(digest).alias("least"), F.max(digest).alias("most")).where("least <> most")
    several = written(several.select("doc_id"), "several-texts")
    if several.isEmpty():
        return components
    meeting = rows.join(small_or_shuffled(several), "doc_id", "left_semi").join(components, ["high", "low"])
    meeting = written(meeting.select("doc_id", "component").distinct(), "meeting")
    first = meeting.groupBy("doc_id").agg(F.min("component").alias("a"))
    bridges = connected(meeting.join(first, "doc_id").select("a", F.col("component").alias("b")), "bridges")
    joined = bridges.select(F.col("id").alias("component"), F.col("component").alias("joined"))
    return components.join(joined, "component", "left").withColumn("component", F.coalesce("joined", "component")).drop("joined")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WORDS_IN_SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, key (a hash of the text), text_kept.

    Documents are linked if 100 * shared shingles >= percent * all shingles of
    the two; ``component_id`` is the least doc_id reachable over links. A
    document without words has no shingles and stands alone. Rows that repeat a
    doc_id are one node, linked by any of its texts; a row without doc_id
    stands alone and is kept. ``text_kept`` looks at the row's text alone: it is
    true for the rows of the least doc_id of those whose texts are linked, so of
    an id with several texts some may stay. Very long texts are whole sets like
    others. Other columns are not looked at.

    A link of similarity 0.8 is missed once in two million, one of 0.85 once in
    10^10; ``percent`` must be 80 or more.
    """
    if percent < 80:
        raise ValueError("bands are laid out for similarities of 0.8 and more")
    bounded_batches(docs.sparkSession)
    profiles = written(_profiles(docs, width), "profiles")
    grouped = profiles.where("high is not null and doc_id is not null").groupBy("high", "low")
    first = grouped.agg(F.min(F.struct("doc_id", "key", "n_shingles", "sketch", "bands")).alias("first"))
    # A class is named by a number of its own: an id may have texts in several of them.
    nodes = written(
        first.select(
            F.monotonically_increasing_id().alias("id"),
            "high",
            "low",
            F.col("first.doc_id").alias("doc_id"),
            F.col("first.key").alias("key"),
            F.col("first.n_shingles").alias("n"),
            F.col("first.sketch").alias("sketch"),
            F.col("first.bands").alias("bands"),
        ),
        "classes",
    )
    members = nodes.select("id", F.explode("bands").alias("band"))
    # Bands of more than one class: the other ones link nothing.
    shared = written(
        members.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("band"),
        "shared-bands",
    )
    crowded = written(members.join(small_or_shuffled(shared), "band"), "crowded-bands")
    links = written(_confirmed(docs, _first_pairs(crowded, nodes, percent), nodes, percent, width), "links")
    labels = written(connected(links), "labels")
    for order in ORDERS:
        found = _confirmed(docs, _more_pairs(crowded, labels, nodes, percent, order), nodes, percent, width)
        links = written(links.unionByName(found), "links")
        labels = written(connected(links), "labels")
    open_pairs = _across(docs, crowded, labels, nodes, percent, width)
    likely = written(_sifted(open_pairs, nodes, percent).select("a", "b"), "likely-pairs")
    all_labels = connected(links.unionByName(_confirmed(docs, likely, nodes, percent, width)))

    components = written(_bridged(profiles, nodes, all_labels), "bridged")
    least = nodes.select("id", "doc_id").join(components, "id").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_text = nodes.select("id", "doc_id").join(components, "id").groupBy("linked").agg(F.min("doc_id").alias("text_id"))
    named = components.join(least, "component").join(by_text, "linked").select("high", "low", "component_id", "text_id")
    named = written(named, "named")
    told = profiles.join(named, ["high", "low"], "left")
    wordless = profiles.where("high is null and doc_id is not null").select("doc_id").distinct()
    # An id without words on one row may have some on another.
    also = told.where("high is not null").join(small_or_shuffled(written(wordless, "wordless")), "doc_id", "left_semi")
    also = written(also.groupBy("doc_id").agg(F.min("component_id").alias("other")), "also")
    told = told.join(small_or_shuffled(also), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "other", "doc_id"))
    return told.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "key",
        F.coalesce(F.col("doc_id") == F.col("text_id"), F.lit(True)).alias("text_kept"),
    )
