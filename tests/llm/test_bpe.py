import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemark.llm import bpe
from lakemark.llm.queries import op1_bpe

ODD = "aabbeehinrst'd \t\n\u001c\u0085 é́ßΣσς漢　.!#019\U0001f642ſKİ﻿\x00<|>"


@pytest.fixture(scope="module")
def both(vocabulary):
    return bpe.load_bpe(vocabulary), Tokenizer.from_file(vocabulary)


def ids_of(model, text):
    return list(memoryview(bpe.encode_text(model, text)).cast("i"))


@given(text=st.text(alphabet=ODD, max_size=60) | st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_library(both, text):
    model, library = both
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(model, text) == want
    assert bpe.decode_ids(model.tokens, want) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, "l" * 9, "!" * 999, "the<|endoftext|>the", "<|startoftext|><|endoftext|>"])
def test_repeated_letters_and_special_tokens(both, text):
    model, library = both
    assert ids_of(model, text) == library.encode(text, add_special_tokens=False).ids


def test_small_memory_gives_the_same(both, monkeypatch, texts):
    model, library = both
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 2)
    for text in texts:
        assert ids_of(model, text) == (library.encode(text, add_special_tokens=False).ids if text else [])


def test_encode_and_decode_frames(spark, docs, wide_docs, no_docs, both, vocabulary):
    _, library = both
    rows = bpe.encode(docs, vocabulary).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    wide = bpe.encode(wide_docs, vocabulary, decoded=None)
    assert wide.columns == wide_docs.columns  # ids replaced in its place
    assert {r["a.b"] for r in wide.collect()} == {r["a.b"] for r in wide_docs.collect()}
    assert bpe.encode(no_docs, vocabulary).collect() == []
    again = bpe.decode(spark.createDataFrame([([1, 2, None, 10**6],), (None,), ([],)], "ids ARRAY<INT>"), vocabulary)
    assert [r.decoded for r in again.collect()] == [library.decode([1, 2]), "", ""]


def test_query_on_whole_table(spark, sf_dir, tables, both):
    _, library = both
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = op1_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
