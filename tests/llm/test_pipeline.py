from collections import Counter

import pytest

import corpus_pipeline as pipeline
from lakemark.llm.common import stored, table
from lakemark.llm.mixing import mixing_plan
from lakemark.llm.ngram_join import similar
from lakemark.llm.toxicity import fit_toxicity, severities
from lakemark.llm.queries import graded_labels


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """What goes into each stage, and what the last one returns."""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in pipeline.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, sf_dir), name)
    return [*out, docs]


def test_columns_and_order(spark, sf_dir, steps):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_copies", "personal_data", "mixture", "tokens"]
    for docs in steps[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ran = pipeline.run(spark, sf_dir)
    assert Counter(map(str, ran.collect())) == Counter(map(str, steps[-1].collect()))


def test_toxic_documents_go_and_no_others(spark, sf_dir, steps):
    rows = steps[0].collect()
    model = fit_toxicity(steps[0], graded_labels(spark, sf_dir))
    want = [r.doc_id for r, s in zip(rows, severities(model, [r.text for r in rows])) if s < 0.5]
    assert sorted(r.doc_id for r in steps[1].collect()) == sorted(want) and len(want) < len(rows)


def test_one_of_each_class_stays(steps):
    classes = {r.class_id for r in similar(steps[1]).collect()}
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(classes)


def test_personal_data_keeps_documents(steps):
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(r.doc_id for r in steps[3].collect())
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_mixture_and_tokens(steps):
    copies = {r.doc_id: r.copies for r in mixing_plan(steps[3]).collect()}
    got = Counter(r.doc_id for r in steps[4].collect())
    assert got == Counter({i: c for i, c in copies.items() if c})
    assert Counter(r.doc_id for r in steps[5].collect()) == got
    assert all(r.n_tokens == len(r.ids) for r in steps[5].collect())


def test_empty_documents(spark, sf_dir, steps):
    docs = steps[0].limit(0)
    for _, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "empty")
        assert docs.count() == 0
