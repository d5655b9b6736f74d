import random
import re
import time
from array import array
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from smogline.llm import piece_bpe
from smogline.llm.piece_bpe import CHUNK_BYTES, LONGEST_CHUNK, SPACE, Generations, Pieces, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


def check(pieces, text):
    ids, decoded = pieces.encode(text)
    ids = ids.tolist()
    wanted = pieces.model.encode(text, add_eos=True)
    assert ids == wanted, text
    assert decoded == pieces.model.decode(wanted) == pieces.decode(ids), text


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a", "a  b", "a\nb", "\n\n", " \n ", "é", "ｆｕｌｌ", "á", "　x", "\x00a", "▁x", "x ▁ y", "<s>", "</s>",
     "<0x41>", "<unk>", "\U0001F600 hi", " a ", "a\r\n", "a" * 3000, "ab" * 999, " ", "日本語テキスト", "\t" * 40],
)
def test_awkward_texts(pieces, text):
    check(pieces, text)


def test_runs_of_blanks(pieces):
    for n in [*range(70), 1000]:
        check(pieces, " " * n + "x" + " " * n + "\n" + " " * n)


def test_runs_of_blanks_are_backtracked(monkeypatch):
    coder, rng = Pieces(MODEL), random.Random(13)
    merged, asked = coder.merged, []
    monkeypatch.setattr(coder, "merged", lambda text: asked.append(text) or merged(text))
    for n in range(2, 200):
        check(coder, "a" + " " * n + rng.choice(["", "x", "the", "1", "é", "日", "😀", "\n", coder.text_of[rng.randrange(300, 32000)]]))
    # Only pairs of pieces are merged, never a chunk.
    assert asked and max(map(len, asked)) <= 2 * max(len(piece) for piece in coder.id_of)


def test_vocabularies_whose_runs_tie_otherwise_are_merged(pieces):
    coder = Pieces(MODEL)
    assert not coder.tied
    # A word that merges later than runs may find them merged.
    coder.rank["a" + "b"] = 2 * coder.rank[SPACE * 2]
    assert coder._tied()
    coder.tied = True
    for n in (2, 15, 31, 40):
        assert coder.chunk(SPACE * n + "the") == pieces.chunk(SPACE * n + "the")


def test_random_texts(pieces):
    rng = random.Random(5)
    for _ in range(3000):
        check(pieces, "".join(rng.choice("ab the in er\n\t  é ñ日本😀#*—ingaaa   ") for _ in range(rng.randint(0, 40))))


def test_backtracking_equals_merging(pieces):
    rng = random.Random(6)
    for _ in range(3000):
        word = SPACE + "".join(rng.choice("theinrsoa'-ö😀") for _ in range(rng.randint(1, 20)))
        assert [pieces.text_of[i] for i in pieces.backtracked(word)] == pieces.merged(word)


def test_both_ways_of_merging_agree(pieces):
    rng = random.Random(8)
    for _ in range(2000):
        word = "".join(rng.choice("theinrsoa▁▁'-ö😀") for _ in range(rng.randint(0, 48)))
        assert pieces._scanned(word) == pieces._queued(word)


def test_long_texts_without_blanks_take_linear_time(pieces):
    rng = random.Random(9)
    seconds = []
    for size in (50_000, 400_000):
        text = "".join(rng.choice("theinrsoa") for _ in range(size))
        start = time.process_time()
        pieces.encode(text)
        seconds.append(time.process_time() - start)
        check(pieces, text)
    assert seconds[1] < 20 * seconds[0] + 0.5 and seconds[1] < 2


def test_walking_together_equals_walking_alone(pieces, monkeypatch):
    rng = random.Random(10)
    letters = "theinrsoa'-ö😀日\x00ing"
    chunks = [SPACE * rng.randint(0, 1) + "".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    chunks = list(dict.fromkeys(chunks))
    alone = [array(pieces.code, pieces.chunk(chunk)).tobytes() for chunk in chunks]
    assert pieces.walked(chunks) == alone
    # With a table of few slots, which is emptied again and again.
    monkeypatch.setattr(piece_bpe, "SLOTS", 6)
    few = Pieces(MODEL)
    assert [x for at in range(0, 600, 3) for x in few.walked(chunks[at : at + 3])] == alone[:600]


def test_texts_of_a_batch_equal_texts_alone(pieces):
    rng = random.Random(11)
    words = ["".join(rng.choice("theinrsoaü") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", "\n\n", "  x", "😀"]) for _ in range(200)] + [None, "", "\n"]
    for (ids, decoded), text in zip(Pieces(MODEL).encode_all(texts), texts):
        assert ids.tolist() == pieces.model.encode(text or "", add_eos=True) and decoded == (text or "")


def test_any_ids_decode_as_the_library_does(pieces):
    rng = random.Random(7)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 0, 1, 2, 28705]) for _ in range(rng.randint(0, 8))]
        assert pieces.decode(ids) == pieces.model.decode(ids), ids


def test_what_is_decoded_are_the_ids():
    coder = Pieces(MODEL)
    # Ids that do not belong to their chunk: a decoded text that came from the text would hide it.
    other = [*coder.model.encode("other"), *coder.model.encode("日\U0001F600"), coder.id_of_byte[0xE6], coder.unknown]
    coder.chunks.put(f"{SPACE}same", array(coder.code, other).tobytes())
    for (ids, decoded), text in zip(coder.encode_all(["same", "the same\nsame", None]), ["same", "the same\nsame", ""]):
        assert decoded == coder.model.decode(ids.tolist()) and decoded != text or not text


def test_many_ids_decode_as_the_library_does(pieces):
    rng = random.Random(12)
    rows = [[rng.choice([rng.randrange(3, 32000), rng.randrange(3, 259), 0, 28705]) for _ in range(rng.randint(0, 8))] + [2] for _ in range(2000)]
    assert pieces.decode_all([np.array(ids, pieces.kind) for ids in rows]) == [pieces.model.decode(ids) for ids in rows]
    assert pieces.decode_all([]) == []


def test_a_worker_gives_its_memory_back():
    coder = Pieces(MODEL)

    def held():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) >> 10

    # Blocks below the allocator's limit for maps of their own, the last of which stays.
    blocks = [bytearray(100_000) for _ in range(1500)]
    last, before = bytearray(100_000), held()
    del blocks
    coder.forget()
    assert len(coder.pairs.young) + len(coder.chunks.young) == 0 and before - held() > 100 and last


def test_cache_is_bounded(pieces):
    cache = Generations(10)
    for n in range(1000):
        cache.put(n, n)
        assert cache.young[n] == n
    assert len(cache.young) + len(cache.old) <= 20 and cache.get(0) is None
    assert 0 < sum(4 * len(k) + len(v) + 200 for k, v in pieces.chunks.young.items()) <= CHUNK_BYTES + 10_000_000
    assert max(map(len, pieces.chunks.young)) <= LONGEST_CHUNK


def test_table(spark, pieces):
    texts = ["Hello there", None, "", "Hello there", "long text " * 20000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").withColumn("ids", F.lit("clash"))
    rows = {row.doc_id: row for row in encode(docs, MODEL).collect()}
    for number, text in enumerate(texts):
        assert list(rows[number].ids) == pieces.model.encode(text or "", add_eos=True)
        assert rows[number].decoded == (text or "") and rows[number].text == text
    assert encode(docs.limit(0), MODEL).count() == 0
