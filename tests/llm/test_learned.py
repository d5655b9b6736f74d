"""The fitted operators: held-out accuracy on the test tables, and hand-made edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm import language_id, quality_mil, toxicity
from smogline.llm.common import held_out, sample_ids, table

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id BIGINT, text STRING, lang STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, FOLDER, "labels")


def test_sample_is_bounded_agreed_and_weighted(spark):
    rows = [(i, 1, 0) for i in range(50)] + [(100 + i, 0, 0) for i in range(5)] + [(7, 0, 0), (200, None, 0), (3, 1, 0), (None, 1, 0)]
    labelled = spark.createDataFrame(rows, LABELS)
    got = sample_ids(labelled, "quality", F.col("doc_id") < 300, 10).collect()
    assert len(got) == 15 and 7 not in {row.doc_id for row in got}
    assert {(row.label, round(row.weight, 2)) for row in got} == {(0, 1.0), (1, 4.9)}


def test_quality_separates_held_out_rows(spark, docs, labels):
    away = held_out("doc_id", 5, 0)
    network = quality_mil.fit(docs, labels, ~away)
    rows = docs.where(away).join(labels, "doc_id").select("quality", quality_mil.score(network, "text").alias("s")).collect()
    right = [(row.s.score >= 0.3) == (row.quality == 1) for row in rows]
    assert len(right) > 50 and np.mean(right) > 0.97


def test_quality_attends_to_the_odd_passage():
    rng = np.random.default_rng(0)
    good = ["".join(rng.choice(list("etaoin shrdlu. "), 3000)) for _ in range(60)]
    bad = [text[:2000] + "### $$$ %%% " * 170 + text[2000:] for text in good]
    bags = [quality_mil.encode(text) for text in good + bad]
    labels = np.array([1.0] * 60 + [0.0] * 60)
    network = quality_mil.fit_network(bags, labels, np.ones(120))
    scores = np.array([network.look(bag)[0] for bag in bags])
    assert ((scores > 0.5) == (labels == 1)).mean() > 0.95
    attended = [int(network.look(bag)[1].argmax()) for bag in bags[60:]]
    assert np.mean([a == 1 for a in attended]) > 0.8


def test_quality_is_fitted_on_whole_documents(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("etaoin shrdlu. "), 35 * quality_mil.PASSAGE)) for _ in range(24)]
    # What is wrong with the second half comes late.
    texts[12:] = [text[:-4000] + "### $$$ %%% " * 166 + text[-2008:] for text in texts[12:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(2)
    labels = spark.createDataFrame([(i, int(i < 12), 0) for i in range(24)], LABELS)
    network = quality_mil.fit(docs, labels, F.lit(True))
    scores = np.array([network.look(quality_mil.encode(text))[0] for text in texts])
    assert ((scores > 0.5) == (np.arange(24) < 12)).all()
    sample = sample_ids(labels, "quality", F.lit(True), 100)
    assert len(quality_mil._fitting(docs, sample, 24 * 35).collect()) == 24
    fewer = quality_mil._fitting(docs, sample, 10 * 35 + 1).collect()
    assert sorted((row.label, round(row.weight, 2)) for row in fewer) == [(0, 2.4)] * 5 + [(1, 2.4)] * 5


def test_fitting_lowers_the_loss():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality_mil.FEATURES)) for n in (1, 3, 2, 4)]
    labels = np.array([1.0, 0.0, 1.0, 0.0])

    def loss(network):
        return -np.mean([np.log(p if y else 1 - p) for p, y in zip([network.look(b)[0] for b in bags], labels)])

    losses = [loss(quality_mil.fit_network(bags, labels, np.ones(4), rounds=n, penalty=0)) for n in (1, 20, 100)]
    assert losses[0] > losses[1] > losses[2]


@pytest.mark.parametrize("text", [None, "", " ", "x", "é" * 5000, "😀" * 3000])
def test_quality_of_any_text(text):
    bag = quality_mil.encode(text)
    assert bag.shape == (max(1, -(-len(text or "") // quality_mil.PASSAGE)), quality_mil.FEATURES) and np.isfinite(bag).all()


def test_toxicity_separates_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    away = held_out("doc_id", 4, 2)
    machine = toxicity.fit(docs, labels, ~away)
    rows = docs.where(away).join(labels, "doc_id").select("toxic", toxicity.score(machine, "text").alias("s")).collect()
    clean = [row.s < 0.3 for row in rows if row.toxic == 0]
    caught = [row.s >= 0.3 for row in rows if row.toxic == 1]
    assert np.mean(clean) > 0.99 and np.mean(caught) > 0.8


def test_factorization_learns_a_pair():
    """Neither term tells alone: toxic are the texts with both."""
    pairs = [(0,), (1,), (0, 1), (2,), ()] * 40
    labels = np.array([1.0 if set(p) >= {0, 1} else 0.0 for p in pairs])
    rows = np.concatenate([[i] * len(p) for i, p in enumerate(pairs)]).astype(int)
    places = np.concatenate([list(p) for p in pairs]).astype(int)
    buckets = [toxicity.buckets_of(word)[0] for word in ("aa", "bb", "cc")]
    machine = toxicity.fit_machine(buckets, rows, places, labels, np.ones(len(labels)), rounds=600, penalty=1e-4)
    assert machine.vectors[0] @ machine.vectors[1] > 0.5
    assert machine.score("aa bb") > 0.5 > max(machine.score(t) for t in ("aa", "bb", "cc", "", None, "aa cc"))


def test_languages_of_held_out_rows(spark, docs):
    away = held_out("doc_id", 4, 2)
    hierarchy = language_id.fit(docs, ~away)
    assert hierarchy.families.classes == ["germanic", "romance"]
    assert hierarchy.languages["romance"].classes == ["es", "fr"]
    rows = docs.where(away).select("lang", language_id.identify(hierarchy, "text").alias("f")).collect()
    assert np.mean([row.lang == row.f.lang for row in rows]) > 0.97
    assert all(0 < row.f.score <= 1 for row in rows)
    for text in (None, "", "123 !?", "²"):
        assert hierarchy.predict(text) == ("und", 0.0)


def test_languages_of_unknown_family_and_of_one(spark):
    rows = [(i, "abc " * 5, "xx") for i in range(5)] + [(9, None, "yy"), (10, "zzz", None)]
    hierarchy = language_id.fit(spark.createDataFrame(rows, DOCS), F.lit(True))
    assert hierarchy.predict("anything") == ("xx", 1.0)


def test_three_languages_of_one_family():
    rng = np.random.default_rng(2)
    alphabets = {"de": "abcdefgß", "en": "hijklmnw", "nl": "opqrstuz"}
    texts = [("".join(rng.choice(list(a), 60)), lang) for lang, a in alphabets.items() for _ in range(20)]
    x = np.array([language_id.features(t) for t, _ in texts])
    machines = language_id.fit_pairs(x, np.array([lang for _, lang in texts]))
    assert len(machines.weights) == 3
    assert all(machines.predict(row)[0] == lang for row, (_, lang) in zip(x, texts))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert language_id.fit(docs, F.lit(True)).predict("text") == ("und", 0.0)
    machine = toxicity.fit(docs, none, F.lit(True))
    network = quality_mil.fit(docs, none, F.lit(True))
    assert 0 <= machine.score("some text") < 0.5 and 0 < network.look(quality_mil.encode("some text"))[0] < 1
    one_sided = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert toxicity.fit(docs, one_sided, F.lit(True)).score(None) < 0.01
    assert quality_mil.fit(docs, one_sided, F.lit(True)).look(quality_mil.encode(None))[0] > 0.9
    empty = docs.limit(0).select(toxicity.score(machine, "text"), quality_mil.score(network, "text"))
    assert empty.count() == 0


def test_grams_cross_blocks(monkeypatch):
    texts = ["one two  three, 4 five", "aa  " * 30, " - ", "É" * 20 + " x", "ab"]
    whole = [language_id.features(text) for text in texts]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(language_id, "BLOCK", size)
        for text, expected in zip(texts, whole):
            assert np.allclose(language_id.features(text), expected), (size, text)


def test_an_id_on_most_rows_is_learned_from_once(spark):
    rows = [(7, f"again {i} {'x' * (i % 5)}", "en") for i in range(4000)] + [(i, f"text number {i}", "en") for i in range(100, 160)]
    rows += [(i, f"texte numéro {i}", "fr") for i in range(200, 230)] + [(None, "sans numéro", "fr"), (7, "encore", "fr"), (8, None, "fr")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("order", "rank", "ids", "share", "label", "weight", "bag")})
    ids = language_id.sampled(docs.where("doc_id is not null"), 20).collect()
    assert len(ids) == len(set(ids)) == 40
    assert len(language_id.sampled(docs.where("doc_id = 7"), 20).collect()) == 2
    machines = language_id.fit(docs, F.lit(True), per_language=1000)
    assert machines.languages["germanic"].classes == ["en"] and machines.languages["romance"].classes == ["fr"]
    labels = spark.createDataFrame([(i, int(i < 120), int(i < 120)) for i in [7, *range(100, 160)]], LABELS)
    from smogline.llm.common import labelled_texts

    sample = sample_ids(labels, "quality", F.lit(True), 1000)
    assert labelled_texts(docs.where("lang = 'en'"), sample).count() == 61
    assert 0 <= toxicity.fit(docs, labels, F.lit(True)).score("text") <= 1
    assert 0 <= quality_mil.fit(docs, labels, F.lit(True)).look(quality_mil.encode("text"))[0] <= 1


def test_no_task_ranks_a_language(spark, docs):
    few = language_id.sampled(docs.where("lang is not null"), 10)
    ranked = few.collect()
    assert len(ranked) == 40
    # What reaches the ranking is bounded by the number wanted, not by the table.
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.index("share") > plan.index("row_number")


def test_very_long_texts(spark):
    long = "the house and the garden " * 60_000
    docs = spark.createDataFrame([(1, long, "en"), (2, "la maison et le jardin " * 50, "fr")], DOCS)
    machines = language_id.fit(docs, F.lit(True))
    assert machines.predict(long)[0] == "en" and machines.predict("la maison et le jardin")[0] == "fr"
    assert np.isfinite(quality_mil.encode(long)).all()
