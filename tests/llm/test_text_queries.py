"""The registered queries and the pipeline over the smallest tables."""

import zlib
from collections import Counter
from hashlib import sha256

import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from __spark_entry__ import SMOKE_FOLDER, oracle_sql, queries
from smogline.llm.decontaminate import windows_of
from smogline.llm.queries import MODEL, ORACLES, QUERIES
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_odd_sketch import brute as brute_groups
from tests.llm.test_pii_bootstrap import brute as brute_spans
from tests.llm.test_rules_and_shards import brute as brute_counts

COLUMNS = {
    "op1": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2": "page_id url text n_chars",
    "op3": "doc_id held_out score predicted",
    "op4": "doc_id size text_crc32 law shard slot grown_shard",
    "op5": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6": "doc_id n_shingles component_id kept",
    "op7": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8": "doc_id held_out score predicted",
    "op9": "doc_id held_out lang_pred score",
    "op10": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op12": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13": "doc_id n_features weight score rank",
}


def sha(text):
    return sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMOKE_FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row.doc_id: row.text for row in docs.select("doc_id", "text").collect()}


def test_each_operator_is_registered_once():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_query(spark, texts, name):
    rows = QUERIES[name](spark, SMOKE_FOLDER).toPandas()
    kind = name.split("_")[0]
    assert set(COLUMNS[kind].split()) <= set(rows.columns)
    if kind == "op2":
        assert len(rows) == spark.read.parquet(f"{SMOKE_FOLDER}/pages.parquet").count()
        assert (rows.n_chars == rows.text.map(len)).all()
        return
    assert sorted(rows.doc_id) == sorted(texts)
    if "held_out" in rows:
        folds, rest = {"op3": (5, 0), "op11": (5, 1)}.get(kind, (4, 2))
        assert (rows.held_out == rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % folds == rest)).all()
        assert (rows.score < 0).all() if kind == "op11" else rows.score.between(0, 1).all()
    if "predicted" in rows:
        assert (rows.predicted == (rows.score >= 0.3)).all()
    if kind == "op6":
        assert dict(zip(rows.doc_id, rows.component_id)) == brute_groups(list(texts.items()))
    if kind == "op5":
        model = SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
        for row in rows.itertuples():
            ids = model.encode(texts[row.doc_id] or "", add_eos=True)
            assert row.n_tokens == len(ids) and row.ids_sha256 == sha(" ".join(map(str, ids)))
            assert row.decoded_sha256 == sha(model.decode(ids))
    if kind == "op7":
        for row in rows.itertuples():
            listed = brute_spans(texts[row.doc_id])
            kinds = Counter(span.split(":")[0] for span in listed.split(",")) if listed else {}
            assert row.base_sha256 == sha(listed)
            assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds.get(k, 0) for k in ("email", "ip", "card", "phone")]
            # What the method adds stands beside the base spans, which all stay.
            assert set(filter(None, listed.split(","))) == {span for span in row.spans.split(",") if span and not span.startswith("id:")}
    if kind == "op10":
        for row in rows.itertuples():
            assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == brute_counts(texts[row.doc_id])
            assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
            assert not (row.kept and row.base_failed)


def test_stages_are_the_operators_in_order(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "personal_data", "tokens"]
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SMOKE_FOLDER}/benchmark.parquet").collect()]
    assert windows_of(items[0][1])
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, before, SMOKE_FOLDER), name)
        old = {row.doc_id: row for row in before.collect()}
        new = {row.doc_id: row for row in after.collect()}
        assert set(new) <= set(old)
        if name != "tokens":
            assert after.columns == docs.columns
            assert all(row.n_chars == len(row.text) for row in new.values())
        if name == "near_duplicates":
            groups = brute_groups([(i, row.text) for i, row in old.items()])
            assert set(new) == {i for i, first in groups.items() if i == first}
        if name == "decontaminate":
            assert set(new) == {i for i, row in old.items() if not brute_leaks(row.text, items)[1]}
        if name == "personal_data":
            assert set(new) == set(old)
            for i, row in new.items():
                assert brute_spans(row.text) == "" and (row.text == old[i].text or "<" in row.text)
        if name == "tokens":
            assert set(new) == set(old) and all(row.round_trip and row.n_tokens == len(row.ids) for row in new.values())
        before = after


def test_stages_keep_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "text without an id", "en", "s", 18), (3, "words " * 40_000, "en", "s", 240_000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    docs = docs.withColumns({name: F.lit("clash") for name in ("spans", "key", "ids", "kept", "label")})
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMOKE_FOLDER), name)
        assert docs.count() == 4, name
    assert docs.count() == 4
    empty = docs.select("doc_id", "lang", "source").limit(0).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMOKE_FOLDER).count() == 0


def test_verdicts_are_of_rows(spark):
    item = spark.read.parquet(f"{SMOKE_FOLDER}/benchmark.parquet").first().text
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(60)) for name in "abcd")
    rows = [(3, a), (5, a), (5, b), (None, a), (None, c), (None, c), (7, item), (7, d), (None, item), (None, None)]
    rows = [(i, text, "en", "s", len(text or "")) for i, text in rows]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    one = corpus_pipeline.one_of_each(spark, docs, SMOKE_FOLDER)
    assert {(row.doc_id, row.text) for row in one.collect()} == {(3, a), (5, b), (None, c), (7, item), (7, d), (None, None)}
    assert one.count() == 6 and one.columns == docs.columns
    clean = corpus_pipeline.leaks_out(spark, docs, SMOKE_FOLDER)
    assert sorted((row.doc_id or 0, row.text or "") for row in clean.collect()) == sorted(
        (row[0] or 0, row[1] or "") for row in rows if row[1] != item
    )


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMOKE_FOLDER).toPandas()
    assert isinstance(rows, pd.DataFrame) and 100 < len(rows) <= 200 and rows.doc_id.is_unique
