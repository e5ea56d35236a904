import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemark.llm import language_id as l
from lakemark.llm.queries import op13_language_id


def test_held_out_accuracy(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.1")
    truth = {r.doc_id: r for r in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op13_language_id(spark, larger).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 1000 and np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) >= 0.99


def test_bundles_are_sums_of_bound_letters():
    texts = ["Ab, a b!", "x", None, "", "12 .", "déjà  vu", "ab a b"]
    got, number = l.bundles(texts, dimensions=128)
    for text, vector, n in zip(texts, got, number):
        letters = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        stream = " " + " ".join(letters) + " " if letters else ""
        grams = Counter(stream[i : i + 3] for i in range(len(stream) - 2))
        want = np.zeros(128, dtype=int)
        for gram, times in grams.items():
            bound = np.ones(128, dtype=int)
            for k, letter in enumerate(gram):
                point = 0 if letter == " " else ord(letter)
                bound *= np.roll(l.letter_vectors(np.array([point]), 128)[0].astype(int), 2 - k)
            want += times * bound
        assert n == sum(grams.values()) and (vector == want).all()
    assert (got[0] == got[6]).all()
    grouped, number = l.bundles(texts, dimensions=128, groups=np.array([0, 1, 0, 1, 0, 1, 0]))
    assert (grouped[0] == got[[0, 2, 4, 6]].sum(axis=0)).all() and (grouped[1] == got[[1, 3, 5]].sum(axis=0)).all()


def test_pieces_and_wide_alphabets_add_up(monkeypatch):
    source = np.random.default_rng(0)
    texts = ["".join(map(chr, source.integers(0x4E00, 0x9000, 3000))), "abc" * 50]
    whole, number = l.bundles(texts, dimensions=64)
    monkeypatch.setattr(l, "BOUND", 100)
    monkeypatch.setattr(l, "PIECE", 70)
    again, _ = l.bundles(texts, dimensions=64)
    assert (whole == again).all() and list(number) == [3000, 150]


LANGS = {"la": "qui quae quod quibus", "nl": "het zijn niet voor", "": "zzz yyy xxx www"}


@pytest.fixture
def told(spark):
    rows = [(i, f"{words} {words}", lang) for i, (lang, words) in enumerate(list(LANGS.items()) * 4)]
    rows += [(20, None, "la"), (21, "123", "xx"), (22, "unused", None), (23, "", "nl")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")


@pytest.mark.parametrize("block", [1024, 1])
def test_edge_rows(spark, told, wide_docs, no_docs, monkeypatch, block):
    monkeypatch.setattr(l, "BLOCK", block)
    prototypes = l.fit_prototypes(told)
    assert sorted(r.lang for r in prototypes.collect()) == ["", "la", "nl"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in l.identify(told.drop("lang"), prototypes).collect()}
    assert {got[i][0] for i in range(0, 12, 3)} == {"la"} and {got[i][0] for i in range(2, 12, 3)} == {""}
    assert all(got[i][1] > 0.9 for i in range(12)) and all(got[i] == ("und", 0.0) for i in (20, 21, 23))
    wide = l.identify(wide_docs, prototypes, name="key", score="score")
    assert wide.columns == [*wide_docs.columns, "score"] and wide.count() == wide_docs.count()
    assert l.identify(no_docs, prototypes).collect() == []
    empty = l.fit_prototypes(no_docs)
    assert {r.lang_pred for r in l.identify(told, empty).collect()} == {"und"}
    ids = spark.createDataFrame([(None,), (1,)], "doc_id BIGINT")
    assert [r[0] for r in ids.select(l.held_out(F.col("doc_id"))).collect()] == [False, zlib.crc32(b"1") % 3 == 1]
