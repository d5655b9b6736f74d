"""Personal data: checked patterns as seeds, and identifiers found by bootstrapped contexts.

1. Emails, IP addresses, cards and phone numbers are found by patterns with
   checks (number ranges, Luhn, digit counts). So are account numbers with their
   check digits, keys of documented formats, and digests whose digits are spread
   as random ones. They are the seed instances.
2. Tokens that look like identifiers and are none of these are the candidates.
   The words beside an instance are its lexical patterns: the one before, the
   two before, the one before with what stands between, the one after, and the
   ones on both sides.
3. Patterns and instances form a graph. A pattern is trusted by the share of its
   occurrences that hold a trusted instance, among all occurrences in all texts,
   whatever word stands there; a candidate by its patterns, as the chance that
   not all of them are wrong. Both are worked out in turn, so candidates that
   got trusted lend it to further patterns, but never to themselves.
4. Candidates over the threshold are found identifiers, wherever they occur.

Scores are shares alone, so a table of twice the size and the same shares gets
the same verdicts. Everything is SQL functions and joins: the text is read twice,
and only mentions, their context words and the counts of these are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import small_or_shuffled, written

# Kinds in the order in which spans that begin together are listed.
KINDS = ("email", "ip", "card", "phone", "id")
# Equal in what they match to the plain forms; the look-behinds and possessive
# quantifiers only keep the search linear in long runs.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = "(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
IP_IN_RANGE = rf"^{BYTE}(?:\.{BYTE}){{3}}$"
# Seeds that are no base kind: digests, account numbers, and keys of documented formats.
DIGEST = r"(?<![A-Za-z0-9])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?![A-Za-z0-9])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# How services mark their keys.
KEY = (
    r"(?<![A-Za-z0-9_-])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|AIza[A-Za-z0-9_-]{35}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_(?:live|test)_[A-Za-z0-9]{16,}+)(?![A-Za-z0-9_-])"
)
# Bits for each hexadecimal digit that a digest has at least; random ones of 32 digits have 3.5 or so.
DIGEST_BITS = 2.8
# At least six letters, digits, marks, with a letter and a digit. Numbers alone
# are left to the checked kinds, which have turned them down.
CANDIDATE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{6,}+"
# Words next to a match, read from it outwards; the text before it is read in reverse.
NEXT_WORD = r"^[^\p{L}\p{N}_]*+([\p{L}\p{N}_]++)"
SECOND_WORD = r"^[^\p{L}\p{N}_]*+[\p{L}\p{N}_]++[^\p{L}\p{N}_]++([\p{L}\p{N}_]++)"
NO_WORD = r"^[^\p{L}\p{N}_]*+"
# Matches whose lengths are added up one by one; whole blocks are added up first.
BLOCK = 256

WORD = r"[\p{L}\p{N}_]+"
WORD_AND_REST = r"[\p{L}\p{N}_]++[^\p{L}\p{N}_]*+"

ROUNDS = 3
THRESHOLD = 0.8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, length: total + length)


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


FOUND = "struct<start:bigint,end:bigint,value:string,before:string,second:string,gap:string,after:string>"


def matches(text: Column, pattern: str, contexts: bool = False) -> Column:
    """All matches with code point offsets, leftmost first: start, end, value, and the text beside.

    The texts between the matches give the offsets. Sums run over blocks of
    matches, so their cost stays near linear.
    """

    def located(parts: Column) -> Column:
        values, between = parts["values"], parts["between"]
        lengths = F.transform(values, lambda v, i: (F.length(v) + F.length(F.get(between, i))).cast("long"))
        return _let(lengths, lambda lengths: with_blocks(values, between, lengths))

    def with_blocks(values: Column, between: Column, lengths: Column) -> Column:
        count = F.floor((F.size(values) - 1) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count), lambda b: _total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
        return _let(
            sums,
            lambda sums: _let(
                F.transform(sums, lambda _, b: _total(F.slice(sums, F.lit(1), b))),
                lambda offsets: F.transform(values, lambda v, i: place(values, v, i, between, lengths, offsets)),
            ),
        )

    def place(values: Column, value: Column, i: Column, between: Column, lengths: Column, offsets: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        earlier = F.get(offsets, block) + _total(F.slice(lengths, block * BLOCK + 1, i % BLOCK))
        start = earlier + F.length(F.get(between, i))
        sides = (F.lit(None).cast("string") for _ in range(4)) if not contexts else beside(values, between, i)
        return F.struct(
            start.alias("start"),
            (start + F.length(value)).alias("end"),
            value.alias("value"),
            *(side.alias(name) for side, name in zip(sides, ("before", "second", "gap", "after"))),
        )

    def beside(values: Column, between: Column, i: Column) -> tuple[Column, ...]:
        """The word before, the one before that, what stands between it and the match, and the word after.

        Words are those of the whole text: where none stands between two
        matches, the other match has them.
        """
        left = F.reverse(F.concat(F.when(i > 0, F.get(values, i - 1)).otherwise(""), F.get(between, i)))
        right = F.concat(F.get(between, i + 1), F.coalesce(F.get(values, i + 1), F.lit("")))
        return (
            F.reverse(F.regexp_extract(left, NEXT_WORD, 1)),
            F.reverse(F.regexp_extract(left, SECOND_WORD, 1)),
            F.reverse(F.regexp_extract(left, NO_WORD, 0)),
            F.regexp_extract(right, NEXT_WORD, 1),
        )

    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern).alias("between")
    )
    return _let(parts, lambda p: F.when(F.size(p["values"]) == 0, _none(FOUND)).otherwise(located(p)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        return F.when(i % 2 == 0, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2).cast("long")

    return _total(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), term)) % 10 == 0


def _card(value: Column) -> Column:
    return _let(_digits(value), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))


def _spread_digits(value: Column) -> Column:
    """Whether hexadecimal digits come as evenly as random ones: their entropy."""

    def bits(lower: Column) -> Column:
        size = F.length(lower)
        counts = F.transform(F.split(F.lit(" ".join("0123456789abcdef")), " "), lambda c: size - F.length(F.replace(lower, c, F.lit(""))))
        part = lambda n: F.when(n > 0, n / size * F.log2(size / n)).otherwise(0.0)
        return F.aggregate(counts, F.lit(0.0), lambda total, n: total + part(n))

    return _let(F.lower(value), bits) >= DIGEST_BITS


def _remainder_one(value: Column) -> Column:
    """Whether an account number leaves 1 by 97: the first four characters last, letters as 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97).cast("int")

    return F.length(plain).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


CHECKS: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "email": (EMAIL, lambda text: F.contains(text, F.lit("@")), lambda value: F.lit(True)),
    "ip": (IP, lambda text: text.rlike(r"[0-9]\.[0-9]"), lambda value: value.rlike(IP_IN_RANGE)),
    "card": (CARD, lambda text: text.rlike("[0-9]"), _card),
    "phone": (PHONE, lambda text: F.contains(text, F.lit("+")), lambda value: F.length(_digits(value)).between(9, 15)),
}
# Kinds that are listed as identifiers.
OWN_CHECKS: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "digest": (DIGEST, lambda text: text.rlike("[0-9a-fA-F]{32}"), _spread_digits),
    "account": (ACCOUNT, lambda text: text.rlike("[A-Z]{2}[0-9]{2}"), _remainder_one),
    "secret": (KEY, lambda text: text.rlike("A[KS]IA|gh[pousr]_|glpat-|AIza|xox[abprs]-|sk_(?:live|test)_"), lambda value: F.lit(True)),
}


def _profiles(docs: DataFrame) -> DataFrame:
    """Base spans per kind and identifier candidates of every row, without the text.

    ``key`` tells rows apart that repeat a doc_id with another text.
    """
    text = F.coalesce("text", F.lit(""))

    def checked(kind: str) -> Column:
        pattern, holds, check = (CHECKS | OWN_CHECKS)[kind]
        passed = F.filter(matches(text, pattern, contexts=True), lambda m: check(m["value"]))
        return F.when(holds(text), passed).otherwise(_none(FOUND)).alias(kind)

    candidates = F.when(text.rlike("[0-9]"), matches(text, CANDIDATE, contexts=True)).otherwise(_none(FOUND))
    return docs.select("doc_id", F.xxhash64(text).alias("key"), *map(checked, CHECKS | OWN_CHECKS), candidates.alias("candidates"))


def _apart(spans: Column | str, others: Column) -> Column:
    """The matches that overlap none of the others."""
    return F.filter(spans, lambda c: ~F.exists(others, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))


def _mentions(profiles: DataFrame) -> DataFrame:
    """One row per mention: row, span, value, kind (NULL for a candidate), seed or not, and its context."""
    base = F.concat(*(F.col(kind) for kind in CHECKS))
    own = {kind: _apart(kind, base) for kind in OWN_CHECKS}
    seeds = {**{kind: F.col(kind) for kind in CHECKS}, **own}
    clear = _apart("candidates", F.concat(base, *(F.col(kind) for kind in OWN_CHECKS)))

    def tagged(spans: Column, kind: str | None) -> Column:
        return F.transform(spans, lambda m: F.struct(m.alias("m"), F.lit(kind).cast("string").alias("kind")))

    every = F.concat(*(tagged(spans, kind) for kind, spans in seeds.items()), tagged(clear, None))
    return profiles.select("doc_id", "key", F.inline(every)).select(
        "doc_id",
        "key",
        F.col("m.start").alias("start"),
        F.col("m.end").alias("end"),
        F.col("m.value").alias("instance"),
        "kind",
        F.col("kind").isNotNull().alias("seed"),
        *(F.lower(f"m.{name}").alias(name) for name in ("before", "second", "gap", "after")),
    )


# Kinds of patterns.
PATTERN_KINDS = BEFORE, TWO_BEFORE, GAP, AFTER, BOTH = range(5)


def _pattern(kind: int, *words: Column | str) -> Column:
    return F.xxhash64(F.lit(kind), *words)


def _edges(mentions: DataFrame) -> DataFrame:
    """(pattern, instance, seed, times, wide): how often, and how often in a pair that a value of one word would not show.

    Patterns are hashes of their kind and words; instances without words beside
    them have no edge.
    """
    one_word = F.size(F.regexp_extract_all("instance", F.lit(WORD), F.lit(0))) == 1
    kind = "struct<pattern:bigint,wide:boolean>"
    before, second, after = (F.col(name) != "" for name in ("before", "second", "after"))
    plain = (
        (before, _pattern(BEFORE, "before")),
        (before & second, _pattern(TWO_BEFORE, "second", "before")),
        (before, _pattern(GAP, "before", "gap")),
        (after, _pattern(AFTER, "after")),
    )
    patterns = F.array(
        *(F.when(there, F.struct(pattern, F.lit(False)).cast(kind)) for there, pattern in plain),
        F.when(before & after, F.struct(_pattern(BOTH, "before", "after"), ~one_word).cast(kind)),
    )
    exploded = mentions.select(F.explode(patterns).alias("p"), "instance", "seed").where("p is not null")
    return exploded.groupBy("p.pattern", "instance", "seed").agg(
        F.count("*").alias("times"), F.count_if("p.wide").alias("wide")
    )


def _occurrences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pattern, words): how often words of all texts stand in the wanted patterns, each between its neighbours."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(WORD_AND_REST), F.lit(0))
    words = docs.where("text is not null").select(found.alias("words"))
    rest = lambda n: F.slice("words", F.lit(n), F.size("words"))
    zipped = words.select(
        F.explode(F.arrays_zip(*(part.alias(name) for part, name in zip((F.col("words"), rest(2), rest(3)), "abc")))).alias("w")
    )
    # Of three words in a row: what follows the first, what is before the second, what is between the first and the third.
    word = lambda name: F.regexp_extract(f"w.{name}", WORD, 0)
    split = zipped.select(*(F.when(F.col(f"w.{n}").isNotNull(), word(n)).alias(n) for n in "abc"), F.regexp_replace("w.a", WORD, "").alias("gap_a"))
    there = lambda name, pattern: F.when(F.col(name).isNotNull(), pattern)
    patterns = F.array(
        there("b", _pattern(BEFORE, "a")),
        there("b", _pattern(GAP, "a", "gap_a")),
        there("c", _pattern(TWO_BEFORE, "a", "b")),
        there("b", _pattern(AFTER, "b")),
        there("c", _pattern(BOTH, "a", "c")),
    )
    every = split.select(F.explode(patterns).alias("pattern")).where("pattern is not null")
    few = small_or_shuffled(wanted)
    # A broadcast drops other patterns before they are counted; else counting comes before the join.
    if few is not wanted:
        return every.join(few, "pattern").groupBy("pattern").agg(F.count("*").alias("words"))
    return every.groupBy("pattern").agg(F.count("*").alias("words")).join(wanted, "pattern")


def trusted_instances(docs: DataFrame, mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, trust) of every candidate, after so many rounds over the graph.

    Seeds are trusted throughout, so they count once per pattern; only edges of
    candidates are gone over again. What a candidate lends a pattern does not
    come back to it.
    """
    edges = written(_edges(mentions), "pattern-edges", len(PATTERN_KINDS) * mentions.count())
    links = written(edges.where("not seed").select("pattern", "instance", "times"), "candidate-edges")
    most = links.count()
    wanted = written(links.select("pattern").distinct(), "candidate-patterns", most)
    words = _occurrences(docs, wanted)
    held = edges.join(wanted, "pattern", "left_semi").groupBy("pattern").agg(
        F.sum(F.when(F.col("seed"), F.col("times")).otherwise(0)).alias("seeds"),
        F.sum("times").alias("mentions"),
        F.sum("wide").alias("wide"),
    )
    # Values that begin or end within a word are not among the words; they count all the same.
    total = F.greatest(F.coalesce("words", F.lit(0)) + F.col("wide"), F.col("mentions"))
    totals = written(held.join(words, "pattern", "left").select("pattern", "seeds", total.alias("total")), "pattern-totals", most)
    trust = links.select("instance").distinct().withColumn("trust", F.lit(0.0))
    for _ in range(rounds):
        own = links.join(trust, "instance").select("pattern", "instance", (F.col("trust") * F.col("times")).alias("own"))
        lent = own.groupBy("pattern").agg(F.sum("own").alias("lent")).join(totals, "pattern")
        share = F.greatest((F.col("seeds") + F.col("lent") - F.col("own")) / F.col("total"), F.lit(0.0))
        doubt = F.sum(F.log1p(-F.least(share, F.lit(0.999999))))
        trust = written(own.join(lent, "pattern").groupBy("instance").agg((F.lit(1.0) - F.exp(doubt)).alias("trust")), "trust", most)
    return trust


def personal_data(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, key, base, spans.

    ``base`` and ``spans`` are lists of (start, rank, end, kind) in that order,
    offsets in code points, end exclusive. ``base`` has the checked kinds,
    ``spans`` also identifiers (kind id): account numbers, keys and digests that
    pass their checks, and what contexts of the corpus vouch for; these overlap
    no base span. NULL and empty texts have none; repeated rows
    get the same spans each. ``key`` is a hash of the text. Other columns are
    not looked at.
    """
    profiles = written(_profiles(docs), "personal-data")
    mentions = written(_mentions(profiles), "mentions")
    trusted = trusted_instances(docs, mentions, rounds).where(F.col("trust") >= threshold).select("instance")
    found = (
        mentions.where("not seed")
        .join(trusted, "instance", "left_semi")
        .unionByName(mentions.where(F.col("kind").isin(*OWN_CHECKS)))
        .groupBy("doc_id", "key")
        .agg(F.collect_set(_span("id")).alias("found"))
        .withColumnsRenamed({"doc_id": "found_id", "key": "found_key"})
    )
    base = F.concat(*(_spans(kind) for kind in CHECKS))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    return (
        profiles.select("doc_id", "key", F.array_sort(base).alias("base"))
        .join(found, same, "left")
        .select(
            "doc_id",
            "key",
            "base",
            F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "found"))).alias("spans"),
        )
    )


def _spans(kind: str) -> Column:
    return F.transform(kind, lambda match: _span(kind, match))


def _span(kind: str, match: Column | None = None) -> Column:
    start, end = (F.col("start"), F.col("end")) if match is None else (match["start"], match["end"])
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind")
    )


def listed(spans: Column | str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by their kinds in brackets; overlapping spans as the first of them."""
    kind = "struct<at:bigint,out:string>"
    start = F.expr(f"cast(named_struct('at', 0L, 'out', '') as {kind})")

    def step(done: Column, span: Column) -> Column:
        between = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        replaced = F.struct(
            span["end"].alias("at"),
            F.concat(done["out"], between, F.lit("<"), F.upper(span["kind"]), F.lit(">")).alias("out"),
        )
        inside = F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["out"].alias("out"))
        return F.when(span["start"] >= done["at"], replaced).otherwise(inside)

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
