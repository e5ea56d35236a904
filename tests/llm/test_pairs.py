import math

import numpy as np
import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from lakemark.llm import ngram_join, pairing
from lakemark.llm.embedding_dedup import (
    bucket_codes, hadamard, in_bytes, may_reach, meet_first, narrow_codes, near_vectors, tables_for, wide_codes,
)
from lakemark.llm.ngram_join import BANDS, ROWS, least_matches, one_of_each, pruned_share, shingle_sets, similar, verified


def connected(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def grams(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def check_similar(rows, got):
    """Links and classes by comparing every two rows."""
    sets = {i: grams(t) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12
    ]
    roots = connected(sets, links)
    for r in got:
        assert (r.class_id, r.n_links) == (roots[r.id], sum(a == r.id for a, _ in links)), r
    assert len(got) == len(rows)


def variants(n, seed, words=80):
    """Texts in families of near copies, some pairs close to the threshold."""
    source, out = np.random.default_rng(seed), []
    while len(out) < n:
        base = [f"w{x}" for x in source.integers(0, 5000, words)]
        for _ in range(int(source.integers(1, 9))):
            own = list(base)
            for at in source.integers(0, words, int(source.integers(0, 4))):
                own[at] = f"v{source.integers(0, 9)}"
            out.append(" ".join(own))
    return list(enumerate(out[:n]))


@pytest.mark.parametrize("part_nodes", [256, 3])
def test_similar_is_the_brute_force_join(spark, monkeypatch, part_nodes):
    """With small parts, cells and chunks as well: hot keys are split without losing a pair."""
    monkeypatch.setattr(pairing, "PART_NODES", part_nodes)
    monkeypatch.setattr(pairing.dealt_to_cells, "__defaults__", (part_nodes, "true", None, 1))
    rows = variants(300, 1) + [(1000 + i, t) for i, (_, t) in enumerate(variants(40, 1))]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(7)
    check_similar(rows, similar(frame).collect())


def test_one_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(300)]
    got = similar(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    check_similar(rows, got)
    assert all(r.n_links == 299 and r.class_id == 0 for r in got)


def test_edge_rows(spark, docs, wide_docs, no_docs, texts):
    got = similar(docs).collect()
    assert len(got) == docs.count()
    assert sum(r.n_links > 0 for r in got) >= 6  # base, near, base, the repeated row; the two "one"
    none = [r for r in got if texts[r.id] is None or not texts[r.id].strip()]
    assert len(none) == 3 and all(r.class_id == r.id and r.n_links == 0 for r in none)
    kept = one_of_each(docs).collect()
    assert len(kept) == len({(r.class_id, r.class_key) for r in got})
    assert len({(r.doc_id, r.text) for r in kept}) == len(kept)
    assert one_of_each(wide_docs).columns == wide_docs.columns
    assert similar(no_docs).collect() == [] and one_of_each(no_docs).collect() == []
    nulls = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")], "doc_id BIGINT, text STRING")
    assert [(r.class_id, r.n_links) for r in similar(nulls).collect()] == [(None, 2)] * 3
    assert one_of_each(nulls).count() == 1


def test_posterior_limits_keep_the_threshold():
    limits = least_matches(0.8)
    assert limits == sorted(limits) and limits[-1] < 0.8 * 128
    for n, least in zip(range(16, 129, 16), limits):
        reached = sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(least))
        assert reached < 1e-5  # one match fewer has a posterior below the tolerance


def test_both_ways_to_verify_agree():
    source = np.random.default_rng(2)
    sets = [np.unique(source.integers(0, 60, 50)).astype(np.uint64) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    want = [len(set(sets[a]) & set(sets[b])) >= 0.7 * len(set(sets[a]) | set(sets[b])) for a, b in zip(i, j)]
    assert verified(sets, i, j, 0.7).tolist() == want
    assert [bool(verified(sets, i[k : k + 1], j[k : k + 1], 0.7)[0]) for k in range(len(i))] == want


def test_short_texts_have_one_gram():
    assert [len(s) for s in shingle_sets([None, "", "a", "a b c d", "a b c d e", "a b c d e f", "a a a a a a a"], 5, {})] == [0, 0, 1, 1, 1, 2, 1]


def test_components_of_chains_and_stars(spark):
    source = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(0, 70)] + [(500, i) for i in range(501, 620)] + [(900, 900)]
    edges += [(int(a) + 2000, int(b) + 2000) for a, b in source.integers(0, 200, (150, 2))]
    got = {r.node: r.root for r in pairing.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = connected(nodes, [e for e in edges if e[0] != e[1]])
    assert got == want


def unit(v):
    v = np.array(v, float) / np.abs(v).max()
    return v / np.linalg.norm(v)


def check_vectors(vectors, got, threshold=0.95):
    usable = {
        i: unit(v) for i, v in vectors
        if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.abs(np.array(v, float)).max() > 0
    }
    links = [
        (a, b) for a in usable for b in usable
        if a != b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= threshold
    ]
    roots = connected([i for i, _ in vectors], links)
    for r in got:
        assert (r.component_id, r.n_links) == (roots[r.id], sum(a == r.id for a, _ in links)), r
    assert len(got) == len(vectors)


@pytest.mark.parametrize("dims", [3, 24, 64])
def test_vectors_by_brute_force(spark, dims):
    source = np.random.default_rng(dims)
    rows = []
    for c in range(40):
        center = source.normal(size=dims)
        rows += [center + source.normal(size=dims) * source.choice([0, 0.05, 0.2, 0.3]) for _ in range(8)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * dims), (1003, [float("nan")] + [1.0] * (dims - 1)), (1004, [None] + [1.0] * (dims - 1))]
    rows += [(1005, [float("inf")] + [1.0] * (dims - 1)), (1006, [1.0]), (1007, [2.0]), (1008, [1e300] * dims), (1009, [1e-300] * dims)]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("node", F.lit(1))
    check_vectors(rows, near_vectors(frame).collect())


def test_many_copies_of_one_vector_and_none(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(500)] + [(500, [4.0, -3.0, 2.0, -1.0])]
    got = {r.id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")).collect()}
    assert all(got[i].n_links == 499 and got[i].component_id == 0 for i in range(500)) and got[500].n_links == 0
    assert near_vectors(spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")).collect() == []


def test_hashing():
    x = np.random.default_rng(1).normal(size=(5, 16))
    matrix = hadamard(np.eye(16))
    assert np.allclose(hadamard(x), x @ matrix) and np.allclose(matrix @ matrix.T, 16 * np.eye(16))
    codes = bucket_codes(x, 2, 2, 3)
    assert codes.shape == (5, 2, 4) and all(len(set(c)) == 4 for c in codes.reshape(-1, 4).tolist())
    assert (bucket_codes(x * 7, 2, 2, 3) == codes).all()
    assert tables_for(0.95, 64, 3, 3) > tables_for(0.95, 64, 2, 3) > tables_for(0.99, 64, 2, 3)


def test_pairs_at_the_threshold_are_missed_less_than_once_in_a_million():
    assert pruned_share(0.8) + (1 - 0.8**ROWS) ** BANDS < 1e-6 and pruned_share(0.85) < 1e-7
    # The step by step figure is what drawing gives.
    equal = np.random.default_rng(3).random((200_000, 128)) < 0.8
    sums = equal.reshape(-1, 8, 16).sum(axis=2).cumsum(axis=1)
    dropped = (sums < np.array(least_matches(0.8, tolerance=1e-2))).any(axis=1).mean()
    assert abs(dropped - pruned_share(0.8, tolerance=1e-2)) < 0.003


def test_long_texts_make_small_cells(spark, monkeypatch):
    """Cells are bounded by the n-grams of their texts: no pair is lost, and no cell has more than two
    of the long ones."""
    rows = variants(60, 5, words=60)
    long_ones = [(100 + i, " ".join(f"w{x}" if x != 50 * i else "other" for x in range(900))) for i in range(12)]
    members = spark.createDataFrame([(1, i.to_bytes(16, "big"), 900 if i < 12 else 10) for i in range(40)], "key INT, node BINARY, size LONG")
    cells = pairing.dealt_to_cells(members, ["key"], "node", weight="size", part_weight=300)
    assert "size" not in cells.columns and cells.agg(F.max(F.greatest("low", "high"))).first()[0] > 30
    met = cells.alias("a").join(cells.alias("b"), ["key", "low", "high"]).filter("a.node < b.node")
    own = F.expr("low = high OR a.part <> b.part")
    assert met.filter(own).count() == met.filter(own).select("a.node", "b.node").distinct().count() == 40 * 39 // 2
    monkeypatch.setattr(ngram_join, "PART_GRAMS", 1000)
    monkeypatch.setattr(ngram_join, "CELL_BYTES", 4000)
    docs = spark.createDataFrame(rows + long_ones, "doc_id LONG, text STRING")
    check_similar(rows + long_ones, similar(docs).collect())


def test_whole_cells_by_bytes():
    texts = ["x" * 50] * 7 + ["y" * 500] + ["z"] * 10 + [None] * 3
    cell = [0, 0, 0, 1, 1, 2, 2, 3, 4, 4, 5, 5, 5, 5, 5, 5, 6, 6, 7, 7, 8]
    batch = pa.record_batch([pa.array(cell), pa.array(texts)], ["cell", "text"])
    got = [(t.column("cell").to_pylist(), n) for t, n in pairing.whole_cells(iter([batch, batch.slice(0, 0)]), 1, rows=100, size=120)]
    assert [c for cells, _ in got for c in cells] == cell and len(got) > 4
    for cells, number in got:
        assert len(number) == len(cells) and (np.diff(cells) > 0).tolist() == (np.diff(number) > 0).tolist()
    assert len({c for cells, _ in got for c in set(cells)}) == sum(len(set(cells)) for cells, _ in got)


@pytest.mark.parametrize("most", [2, 128, 1 << 15, 1 << 21, (1 << 35) - 1, 1 << 56])
def test_codes_in_whole_bytes(most):
    source = np.random.default_rng(3)
    codes = source.integers(-1, most, (40, 3, 4))
    codes[0, 0] = [-1, 0, most - 1, most // 2]
    rows = narrow_codes(codes, most)
    assert (wide_codes(rows, 3, 3) == codes).all()
    other = source.integers(-1, 100, (7, 3, 4))
    both = wide_codes(rows + narrow_codes(other, 100), 3, 3)
    assert (both == np.concatenate([codes, other])).all()


def test_a_pair_is_taken_in_its_first_bucket_only():
    source = np.random.default_rng(4)
    codes = np.stack([[source.choice(9, 3, replace=False) for _ in range(4)] for _ in range(30)])
    for a in range(30):
        for b in range(a + 1, 30):
            meet = [
                (t, c) for t in range(4) for c in range(9)
                if c in codes[a, t] and c in codes[b, t] and c in (codes[a, t, 0], codes[b, t, 0])
            ]
            told = [
                (t, c) for t in range(4) for c in range(9)
                if c in codes[a, t] and c in codes[b, t] and c in (codes[a, t, 0], codes[b, t, 0])
                and meet_first(codes[[a, b]], np.array([t, t]), np.array([c, c]), np.array([0]), np.array([1]))[0]
            ]
            assert told == meet[:1]


@pytest.mark.parametrize("dims", [1, 3, 64, 1500])
def test_rounded_components_rule_out_no_near_pair(dims):
    source = np.random.default_rng(dims)
    x = source.normal(size=(300, dims)) * 10.0 ** source.integers(-3, 3, dims)
    x = np.concatenate([x, x * (1 + source.normal(scale=0.2, size=x.shape)), -x])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    i, j = map(np.ravel, np.meshgrid(np.arange(len(x)), np.arange(len(x))))
    cosine = (x @ x.T)[j, i]
    told = may_reach(in_bytes(x), 0.95)(i, j)
    assert told[cosine >= 0.95].all()
    assert not told[cosine < 0.9].any()
