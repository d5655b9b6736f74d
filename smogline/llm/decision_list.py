"""Quality rules: a decision list learned by sequential covering, as Spark conditions.

Statistics of a text are Spark expressions. From the labelled ones a list of
rules is learned: each rule is a conjunction of thresholds, grown condition by
condition on two thirds of the labelled rows by FOIL's gain, then pruned from
its end on the other third. Rows that a rule covers are set aside before the
next one is grown. The list comes out as ordered ``CASE WHEN`` conditions.

Every count is a Spark aggregation over all labelled rows; what comes to the
driver is one count per statistic, threshold and label. There is no Python on
the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import fold, written

SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEATED_PERCENT = 50

# Thresholds are these quantiles of the good and of the bad rows.
QUANTILES = [0.005, 0.01, 0.02, 0.05, *[i / 10 for i in range(1, 10)], 0.95, 0.98, 0.99, 0.995]
MAX_CONDITIONS = 4
MAX_RULES = 20
PRECISION = 0.9
# Bad rows of the pruning set that a rule must cover.
SUPPORT = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice."""
    window = lambda w, i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def covered(starts: Column) -> Column:
        """Starts in order: each covers three words, less where the next one begins sooner."""
        width = lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3)))
        return F.aggregate(F.transform(starts, width), F.lit(0).cast("long"), lambda total, w: total + w)

    def repeated(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return _let(placed, lambda p: _let(F.array_sort(starts_of(p)), covered))

    def starts_of(placed: Column) -> Column:
        """Equal windows are neighbours once sorted."""

        def same(i: Column, other: Column) -> Column:
            return F.coalesce(F.get(placed, i)["w"] == F.get(placed, other)["w"], F.lit(False))

        flagged = F.transform(
            placed,
            lambda p, i: F.when(same(i, i + 1) | F.when(i > 0, same(i, i - 1)).otherwise(F.lit(False)), p["i"]),
        )
        return F.filter(flagged, lambda start: start.isNotNull())

    def counted(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i))
        unequal = lambda x: F.size(F.array_distinct(x)) == F.size(x)
        return _let(windows, lambda x: F.when(unequal(x), F.lit(0).cast("long")).otherwise(repeated(x)))

    return _let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(counted(w)))


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


#: The statistics that rules may test, over the columns of ``counts``.
STATISTICS = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every text; NULL is a text without words."""
    text = F.coalesce("text", F.lit(""))
    # The array goes through a generator, so that its words are split once.
    split = docs.select(
        "doc_id", text.alias("text"), F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), F.lit(0)).alias("found")
    ).select("doc_id", "text", F.explode(F.array("found")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    length = F.length("text")
    return split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (length - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        (length - _without(F.col("text"), "!?")).cast("long").alias("n_marks"),
        (length - _without(F.col("text"), "0123456789")).cast("long").alias("n_digits"),
        (length - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """A statistic at or over a threshold, or under it; ``step`` is the threshold's number."""

    statistic: str
    over: bool
    threshold: float
    step: int

    def column(self) -> Column:
        value = F.expr(STATISTICS[self.statistic])
        return value >= self.threshold if self.over else value < self.threshold

    def on_steps(self) -> Column:
        """The same on the written steps: how many thresholds the value reaches."""
        reached = F.get("steps", F.lit(list(STATISTICS).index(self.statistic)))
        return reached > self.step if self.over else reached <= self.step

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.over else '<'} {self.threshold:.6g}"


Rule = list[Condition]


def _all(conditions: Rule) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition.on_steps()
    return out


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Distinct quantiles of each statistic over the rows of either label."""
    wanted = [F.percentile_approx(F.expr(sql), QUANTILES, F.lit(2000)).alias(name) for name, sql in STATISTICS.items()]
    found = rows.groupBy("label").agg(*wanted).collect()
    return {name: sorted({value for row in found for value in row[name]}) for name in STATISTICS}


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _best_condition(rows: DataFrame, thresholds: dict[str, list[float]]) -> Condition | None:
    """The condition of the greatest gain over these rows."""
    names = list(STATISTICS)
    table = rows.select("label", F.posexplode("steps")).groupBy("pos", "col", "label").count().collect()
    number = {(row["pos"], row["col"], row["label"]): row["count"] for row in table}
    whole = [sum(n for (pos, _, label), n in number.items() if pos == 0 and label == value) for value in (0, 1)]
    if not whole[0] or not whole[1]:
        return None
    best: tuple[float, Condition] | None = None
    for pos, name in enumerate(names):
        under = [0, 0]
        for step, threshold in enumerate(thresholds[name]):
            for label in (0, 1):
                under[label] += number.get((pos, step, label), 0)
            for over in (False, True):
                bad, good = (whole[i] - under[i] if over else under[i] for i in (0, 1))
                gain = _gain(bad, good, *whole)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = gain, Condition(name, over, threshold, step)
    return best[1] if best else None


def learn(
    labelled: DataFrame,
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    precision: float = PRECISION,
    support: int = SUPPORT,
) -> list[Rule]:
    """Rules for label 0, from rows of doc_id, counts and label.

    A rule is taken if on the pruning rows at least ``precision`` of what it
    covers is bad, and at least ``support`` bad rows are covered; the first rule that is not ends the list.
    Without rows of both labels the list is empty.
    """
    thresholds = _thresholds(labelled)
    steps = [_step(F.expr(sql), thresholds[name]) for name, sql in STATISTICS.items()]
    table = written(
        labelled.select("label", (fold("doc_id", 3) == 0).alias("prune"), F.array(*steps).alias("steps")), "rule-steps"
    )
    rules: list[Rule] = []
    open_rows = F.lit(True)
    while len(rules) < max_rules:
        growing, pruning = (table.where(open_rows & (F.col("prune") == side)) for side in (False, True))
        rule: Rule = []
        while len(rule) < max_conditions:
            condition = _best_condition(growing.where(_all(rule)), thresholds)
            if condition is None:
                break
            rule.append(condition)
        if not rule:
            break
        sums = pruning.agg(
            *(F.count_if(_all(rule[: n + 1]) & (F.col("label") == label)) for n in range(len(rule)) for label in (0, 1))
        ).first()
        scored = []
        for n in range(len(rule)):
            bad, good = sums[2 * n], sums[2 * n + 1]
            if bad >= support and bad / (bad + good) >= precision:
                scored.append(((bad - good) / (bad + good), bad, -n, n + 1))
        if not scored:
            break
        rule = rule[: max(scored)[-1]]
        rules.append(rule)
        open_rows = open_rows & ~_all(rule)
    return rules


def _step(column: Column, thresholds: list[float]) -> Column:
    """How many of the thresholds the value reaches."""
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda threshold: column >= threshold))


def verdict(rules: list[Rule]) -> Column:
    """The decision list: the number of the first rule that holds, or NULL."""
    out = F.lit(None).cast("int")
    for number in range(len(rules), 0, -1):
        holds = F.lit(True)
        for condition in rules[number - 1]:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(number)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, rule (number or NULL), kept.

    NULL and empty texts have no words and fail the base. Labels other than 0
    and 1 and contradicting ones are passed over; without labels the base alone
    decides. Repeated documents are judged each, and very long texts are counted
    whole; other columns are not looked at.
    """
    all_counts = written(counts(docs.select("doc_id", "text")), "text-counts")
    agreed = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .drop("other")
    )
    labelled = written(all_counts.where(~base_failed()).join(agreed, "doc_id"), "labelled-counts")
    rules = learn(labelled)
    failed = base_failed()
    return all_counts.withColumns({"base_failed": failed, "rule": verdict(rules)}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )
