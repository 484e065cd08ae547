"""Chunk reuse against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabloom.llm import chunkbpe
from tests.llm.helpers import edge, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ALPHABET = "abE é́'ßİ<|>endoftext 12,.!\n\t \x1c\U0001f600中가'sre"


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def expected(text):
    ids = whole(text)
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.fixture(scope="module")
def codec():
    return chunkbpe.Codec(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(ALPHABET, max_size=60), st.lists(st.integers(0, 60), max_size=5), st.randoms())
def test_joins_agree_wherever_texts_are_cut(codec, text, at, rnd):
    if rnd.random() < 0.5:
        text = text[:20] + rnd.choice(["<|endoftext|>", "don't", "we're ", "é́", "x" * 30]) + text[20:]
    at = sorted({0, len(text), *(a for a in at if a < len(text))})
    parts = [(a, b, codec.encode(text[a:b]) if rnd.random() < 0.6 else None) for a, b in zip(at, at[1:])]
    assert codec.joined(text, parts).tolist() == whole(text)
    ids = np.array(whole(text), np.uint32)
    assert codec.decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x17F), max_size=30) | st.text("aBé'ÀÿµªºßsStTrReE-_.0<|9", max_size=20))
def test_words_have_the_librarys_ids(codec, text):
    for word in [text, *text.split(" ")]:
        assert np.frombuffer(codec.encode(word), "<u4").tolist() == whole(word)


def test_cuts_follow_the_content():
    rnd = random.Random(3)
    prose = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))
    shared = prose(3000)
    for text in (shared, "", "x", "y" * 50_000, prose(2000)):
        at = chunkbpe.cuts(text)
        assert at[0] == 0 and at[-1] == len(text) and all(0 < b - a <= chunkbpe.MOST for a, b in zip(at, at[1:]))

    def chunks(t):
        at = chunkbpe.cuts(t)
        return {t[a:b] for a, b in zip(at, at[1:])}

    a, b = chunks(prose(500) + shared), chunks(prose(711) + shared + prose(300))
    assert sum(map(len, a & b)) > 0.8 * len(shared)
    long = prose(400_000)  # beyond one block
    assert chunks(long[:300]) | chunks(long) and len(chunkbpe.cuts(long)) > 1000


def corpus(n=60):
    rnd = random.Random(5)
    prose = lambda k: " ".join(rnd.choice(["The", "don't", "<|endoftext|>", "É́té", "x1y22", "..."]) + "".join(rnd.choices("abcdefghij", k=rnd.randint(1, 7))) for _ in range(k))
    passages = [prose(400) for _ in range(4)] + ["z" * 9000, "́".join("abc" * 900)]
    rows = [(i, prose(rnd.randint(1, 200)) + rnd.choice(["", " ", "\n"]) + rnd.choice(passages) + rnd.choice(["", " "]) + prose(rnd.randint(1, 200))) for i in range(n)]
    return rows + [(1000 + i, passages[i % 3]) for i in range(20)] + [(2000 + i, prose(50)) for i in range(20)]


@pytest.mark.parametrize("words", [1, chunkbpe.FILTER_WORDS])
def test_every_text_has_the_librarys_ids(spark, words):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, 2, "m") for i, t in rows], "doc_id long, text string, t1 int, id int, moved string")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in chunkbpe.encode(df, filter_words=words).collect()}
    assert got == {i: expected(t) for i, t in rows}
    assert not chunkbpe.shared_chunks(df).isEmpty()


def test_edge_cases(spark):
    df = edge(spark)
    got = sorted(((r.doc_id or 0), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in chunkbpe.encode(df).collect())
    assert got == sorted(((r.doc_id or 0), *expected(r.text)) for r in df.collect())
    assert chunkbpe.encode(empty(spark)).collect() == []


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in chunkbpe.op13_bpe(spark, sf).collect()}
    assert got == {r.doc_id: expected(r.text) for r in rows}
