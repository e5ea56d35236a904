import re
from collections import Counter

import numpy as np
import pytest

from lakemark.llm import collocations as c

SCHEMA = "doc_id BIGINT, text STRING, lang STRING"


def by_hand(rows, least, top, longest=5):
    """The contract in plain Python, all cuts and all longer phrases included."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        found = {w: a for (at, w), a in f.items() if at == lang and a >= least and len(w) > 1}
        rows_ = []
        for words, a in found.items():
            inside = any(
                len(o) > len(words) and 100 * b >= 100 * a and any(o[i : i + len(words)] == words for i in range(len(o)))
                for o, b in found.items()
            )
            if not inside:
                cuts = []
                for k in range(1, len(words)):
                    left, right = f[lang, words[:k]], f[lang, words[k:]]
                    cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                rows_.append((score, a, " ".join(words), left, right))
        rows_.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(rows_[:top])]
    return sorted(out)


@pytest.fixture
def phrases(texts):
    source = np.random.default_rng(5)
    words = ["a", "B", "c\xa0d", "é", "Ä", "the", "x-y", "\x1c", "漢"]
    made = [" ".join(source.choice(words, 40)) + source.choice([". ", ",", "\t", "\r\n", ""]) for _ in range(60)]
    rows = [(t, ["en", "de", None, "und", ""][i % 5]) for i, t in enumerate(made + texts)]
    return rows + [rows[0]] * 7 + [("the a " * 500, "en"), ("a a a a a a a", "de")]


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": -1}, {"broadcast_bytes": -1, "shard_grams": 64, "fan_bits": 2}])
def test_equals_counting_everything(spark, phrases, monkeypatch, limits):
    if limits:
        monkeypatch.setattr(c, "ROW_WORDS", 37)
        monkeypatch.setattr(c, "HELD_GRAMS", 50)
        monkeypatch.setattr(c, "HELD_WORDS", 3)
        monkeypatch.setattr(c, "NUMBERED", 4)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(phrases)], SCHEMA)
    got = sorted(tuple(r) for r in c.collocations(docs, least=3, top=25, **limits).collect())
    want = by_hand(phrases, 3, 25)
    assert got == want and len({r[0] for r in got}) >= 4


def test_edge_rows(spark, wide_docs, no_docs):
    assert c.collocations(no_docs).collect() == []
    assert c.collocations(wide_docs.withColumnRenamed("a.b", "f"), least=1, top=3).count() > 0
    nothing = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " .\t", "en"), (4, "rare words", "en")], SCHEMA)
    assert c.collocations(nothing).collect() == []
    with pytest.raises(ValueError):
        c.collocations(no_docs, longest=6)


@pytest.mark.parametrize("k, bits", [(2, 1), (2, 15), (5, 13), (3, 32), (5, 32), (5, 26)])
def test_filters_lose_nothing(k, bits):
    source = np.random.default_rng(k * bits)
    columns = [source.integers(0, 1 << bits, 3000) for _ in range(k)]
    widths = [bits * words for words in c.limb_layout(k, bits)]
    limbs = c.packed_grams(columns, bits)
    scattered = c.permuted(limbs, widths)
    assert (c.permuted(scattered, widths, back=True) == limbs).all()
    assert (c.unpacked_grams(limbs, k, bits) == np.stack(columns, axis=1)).all()
    counts = source.integers(1, 600, 3000)
    whole = c.counted(scattered, counts)
    for data in ([c.as_filter(*whole, widths)], c.cut(*whole, widths, 3).column("filter").to_pylist()):
        again = c.merged(data, widths)
        assert (again[0] == whole[0]).all() and (again[1] == whole[1]).all()
    halves = [c.as_filter(*c.counted(scattered[h::2], counts[h::2]), widths) for h in (0, 1)]
    again = c.merged(halves, widths)
    assert (again[0] == whole[0]).all() and (again[1] == whole[1]).all()


def test_filters_are_small():
    """A million pairs of words of 17 bits take some 5 bytes each."""
    source = np.random.default_rng(0)
    pairs = c.packed_grams([source.integers(0, 1 << 17, 1_000_000) for _ in range(2)], 17)
    whole = c.counted(c.permuted(pairs, [34]), np.ones(1_000_000, dtype=np.int64))
    assert len(c.as_filter(*whole, [34])) < 5 * len(whole[0])
