import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemark.llm import lm_scoring
from lakemark.llm.filters import as_filter, low_bits, of_filter, read_bits, read_small, small_numbers
from lakemark.llm.lm_scoring import backoff_scores, hash_bits, table_starts

import numpy as np


def by_hand(texts, order, backoff):
    """Scores straight from the definition."""
    words = [(t or "").lower().split() for t in texts]
    counts, own = Counter(), []
    for w in words:
        mine = Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
        own.append(mine)
        counts.update(mine)
    size = sum(map(len, words))
    out = []
    for w, mine in zip(words, own):
        total = 0.0

        def left(gram):
            return counts[gram] - mine[gram]

        for i in range(len(w)):
            for n in range(min(order, i + 1), 1, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                if left(gram) > 0:
                    total += math.log10(left(gram) / left(gram[:-1]))
                    break
                total += math.log10(backoff)
            else:
                total += math.log10(max(left((w[i],)), 1) / max(size - len(w), 1))
        out.append((len(w), total))
    return out


@pytest.mark.parametrize("order,block_bytes", [(1, 1 << 20), (2, 1 << 20), (2, 5_000), (3, 20_000)])
def test_scores_by_the_definition(docs, order, block_bytes):
    rows = docs.select("doc_id", "text").collect()
    want = by_hand([r.text for r in rows], order, 0.4)
    want = sorted((r.doc_id, n, round(s, 6)) for r, (n, s) in zip(rows, want))
    got = backoff_scores(docs, order=order, block_bytes=block_bytes).collect()
    assert sorted((r.id, r.n_words) for r in got) == [w[:2] for w in want]
    for g, w in zip(sorted((r.id, r.n_words, round(r.log10_score, 6)) for r in got), want):
        assert g[2] == pytest.approx(w[2], abs=1e-5)


def test_empty_table_and_clashing_columns(no_docs, wide_docs):
    assert backoff_scores(no_docs).collect() == []
    assert backoff_scores(wide_docs).count() == wide_docs.count()


def test_tables_are_even_ranges():
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64)) >> np.uint64(14)
    starts = table_starts(7, 50)
    assert starts[0] == 0 and (np.diff(np.append(np.searchsorted(hashes, starts), 1000)) > 90).all()
    assert [hash_bits(n) for n in (0, 1 << 20, 10**9, 10**14)] == [48, 48, 50, 64]
    many = np.array([0, 254, 255, 10**12, 3])
    for halves in (False, True):
        data = b"xy" + small_numbers(many, halves)
        found, behind = read_small(data + b"z", 5, 2, halves)
        assert (found == many).all() and behind == len(data)


def test_repeated_and_empty_rows_are_several_blocks(spark):
    """Rows that are equal in all columns, and rows without words: no block holds them all."""
    rows = [(1, "same words again and again " * 4)] * 400 + [(None, None)] * 500 + [(i, f"w{i} same words w{i}") for i in range(2, 60)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    groups = []
    real = lm_scoring.stored

    def kept(df, label):
        if label == "lm-scores":
            df = df.withColumn("p", F.spark_partition_id())
            df = real(df, label)
            groups.append(max(r["count"] for r in df.groupBy("p").count().collect()))
            return df.drop("p")
        return real(df, label)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lm_scoring, "stored", kept)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = backoff_scores(frame, block_bytes=6_000).collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = by_hand([t for _, t in rows], 3, 0.4)
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.id, r.n_words, r.log10_score) for r in got), key=key)
    want = sorted(((i, n, s) for (i, _), (n, s) in zip(rows, want)), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-5)
    assert groups[0] < 600


def test_exchange_of_blocks_is_shared(spark, docs):
    """Both passes over the blocks read one shuffle of the texts."""
    plans = []
    real = lm_scoring.stored

    def kept(df, label):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    lm_scoring.stored = kept
    try:
        backoff_scores(docs).select(F.sum("n_words")).collect()
    finally:
        lm_scoring.stored = real
    assert "ReusedExchange" in plans[-1]


@pytest.mark.parametrize("width", [1, 7, 29, 43, 64])
def test_hashes_in_bits_lose_nothing(width):
    source = np.random.default_rng(width)
    values = source.integers(0, 1 << width, 3_000, dtype=np.uint64, endpoint=False) if width < 64 else source.integers(0, 1 << 63, 3_000, dtype=np.uint64) * 2 + 1
    data = low_bits(values, width)
    assert len(data) == (3_000 * width + 7) // 8
    got, at = read_bits(b"--" + data + b"-", 3_000, width, 2)
    assert (got == values).all() and at == len(data) + 2
    assert len(read_bits(b"", 0, width)[0]) == 0
    hashes = np.unique(values)
    times = source.integers(1, 400, len(hashes))
    for tight in (False, True):
        again, counts = of_filter(as_filter(hashes[:, None], times, [width], tight), [width], tight)
        assert (again[:, 0] == hashes).all() and (counts == times).all()
    assert len(as_filter(hashes[:, None], times, [width], True)) <= len(as_filter(hashes[:, None], times, [width])) + 1
