import hashlib
from collections import Counter

import numpy as np
import pytest

from lakemark.llm.fingerprints import fingerprint, signatures, with_successor
from lakemark.llm.queries import op5_fingerprints


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_the_generalised_jaccard_similarity():
    source = np.random.default_rng(0)
    for _ in range(6):
        a, b = (" ".join(f"w{x}" for x in source.zipf(1.5, 300) % 40) for _ in range(2))
        found = signatures([a, b], samples=4000)
        assert (found[0] == found[1]).mean() == pytest.approx(jaccard(a, b), abs=0.035)


def test_signatures_do_not_depend_on_company():
    texts = ["a b c a", None, "", "x y", "c b a a"]
    alone = np.concatenate([signatures([t]) for t in texts])
    assert (signatures(texts) == alone).all()
    assert (alone[0] == alone[4]).all() and (alone[1] == alone[2]).all() and (alone[0] != alone[3]).all()


def successors_by_hand(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    return sorted(
        ((i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)), key=str
    )


@pytest.mark.parametrize("n", [1, 2, 5, 200])
def test_successors(spark, n):
    source = np.random.default_rng(n)
    ids = source.permutation(n * 3)[:n].tolist()
    rows = [(int(i) - 5, f"text {i}") for i in ids]
    if n > 4:
        rows += [(None, "null id"), (None, None), (rows[0][0], "same id"), (min(r[0] for r in rows), None), (max(r[0] for r in rows), "z")]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    got = sorted(map(tuple, with_successor(frame).collect()), key=str)
    assert got == successors_by_hand(rows)


def test_empty_and_wide_frames(spark, no_docs, wide_docs):
    assert with_successor(no_docs).collect() == []
    rows = fingerprint(wide_docs, {"size": "text"}, {"likeness": ("size", "size")})
    assert rows.columns == [*wide_docs.columns, "likeness"]
    assert {r.likeness for r in rows.collect()} == {1.0}
    only_null = spark.createDataFrame([(None, "a"), (None, "b")], "doc_id BIGINT, text STRING")
    assert sorted((r.text, r.next_text) for r in with_successor(only_null).collect()) == [("a", "b"), ("b", "a")]


def test_query_on_whole_table(spark, sf_dir, tables):
    texts = [(i, t or "") for i, t in tables.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]
    got = {r.doc_id: r for r in op5_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(texts)
    errors = []
    for k, (i, text) in enumerate(texts):
        follower, cut = texts[(k + 1) % len(texts)][1], len(text) // 4
        edited = text[: len(text) - cut] + follower[:cut]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i].fingerprint == "".join(f"{x:08x}" for x in signatures([text])[0])
        assert got[i].edited_fingerprint == "".join(f"{x:08x}" for x in signatures([edited])[0])
        assert 0 <= got[i].near_next <= 1
        errors.append(got[i].near_edited - jaccard(text, edited))
    assert abs(np.mean(errors)) < 0.02


def test_texts_move_once(spark, docs):
    plan = with_successor(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan
