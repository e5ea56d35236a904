import hashlib
import re

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from lakemark.llm import secret_scan as scan
from lakemark.llm.queries import op8_secrets

CASELESS = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
PATTERNS = {
    "assign": re.compile(rf"""({CASELESS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+"),
}


def base_by_hand(text):
    """The contract word for word."""
    out = [(m.start(), 0, m.end()) for m in PATTERNS["assign"].finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in PATTERNS["access"].finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in PATTERNS["hex"].finditer(text) if len(m[0]) >= 24]
    return [f"{scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out)]


def listed(spans):
    return [f"{k}:{s}:{e}" for s, e, k, _ in spans]


@given(st.lists(st.sampled_from(["token", "ToKEN=", "secret: ", "api_key", "apikey", "=", '"', "'", " ", "ſecret", "abcdef", "0123456789ab", "AKIA", "ABCDEFGHIJKLMNOP", "é", "\n", "-", "PASSWD"]), max_size=14))
def test_base_spans_are_those_of_the_contract(parts):
    text = "".join(parts)
    empty = scan.model_of({})
    assert listed(scan.all_spans(empty, text)) == base_by_hand(text)


def strings(alphabet, length, n, seed):
    source = np.random.default_rng(seed)
    return ["".join(source.choice(list(alphabet), length)) for _ in range(n)]


def test_automaton_merges_states_and_knows_its_format():
    keys = strings("0123456789abcdef", 40, 60, 1)
    words = ["".join(w) for w in (strings("abcdefghijklmnopqrstuvwxyz", 18, 60, 2))]
    tree = scan.infer([k.translate(scan.TRANSLATION) for k in keys])
    reached, todo = set(), [tree.start]
    while todo:
        state = todo.pop()
        if state not in reached:
            reached.add(state)
            todo += tree.after[state].values()
    assert len(reached) < 200 < 60 * 40  # far fewer states than the prefix tree had
    model = scan.model_of({"hex": keys, "ordinary": words})
    fresh = strings("0123456789abcdef", 40, 50, 3)
    found = [model.score(s) >= model.least_ratio for s in fresh]
    assert np.mean(found) >= 0.9
    assert not any(model.score(w) >= model.least_ratio for w in strings("abcdefghijklmnopqrstuvwxyz", 18, 50, 4))
    upper = strings("0123456789ABCDEF", 40, 20, 5)
    assert not any(model.score(u) >= model.least_ratio for u in upper)
    # Upper-case keys are another format; given examples of it, it is found beside the patterns.
    both = scan.model_of({"hex": keys, "assign": strings("0123456789ABCDEF", 40, 60, 6), "ordinary": words})
    text = f"see {upper[0]} there"
    assert listed(scan.all_spans(both, text)) == ["format:4:44"]
    assert scan.all_spans(both, None) == [] == scan.all_spans(both, "")


def test_every_run_is_scored():
    """Short values and dotted tokens too, whatever key they have."""
    runs = lambda text: [m.group() for m in scan.CANDIDATE.finditer(text)]
    assert runs("pwd=hunter2 x=eyJhbGci.eyJzdWIi.c2lnbmF0, ab.cd. abcde --key:'QUJDREVG==' end.") == [
        "hunter2", "eyJhbGci.eyJzdWIi.c2lnbmF0", "QUJDREVG==",
    ]
    dotted = [".".join(p) for p in zip(strings("abcdefghijABCDEFGHIJ0123456789", 8, 60, 1), strings("abcdefghijABCDEFGHIJ0123456789", 8, 60, 2))]
    short = [a + b for a, b in zip(strings("ghijkl", 4, 60, 3), strings("0123456789", 3, 60, 4))]
    words = strings("abcdefghijklmnopqrstuvwxyz", 9, 200, 5)
    model = scan.model_of({"assign": dotted[10:], "hex": short[10:], "ordinary": words}, least_ratio=2.0)
    text = f"pwd={short[0]} and {dotted[0]} {words[0]}"
    at = text.index(dotted[0])
    assert listed(scan.all_spans(model, text)) == [f"format:4:{4 + len(short[0])}", f"format:{at}:{at + len(dotted[0])}"]


def formats_by_hand(model, text):
    """All runs, each held against all spans."""
    held = [(s, e) for s, e, *_ in scan.base_spans(text)]
    out = []
    for m in scan.CANDIDATE.finditer(text):
        if not any(s < m.end() and m.start() < e for s, e in held):
            string = m.group().translate(scan.TRANSLATION)
            ratios = [
                a.likelihood(string) - model.ordinary.likelihood(string)
                for a, typical in model.formats.values() if a.likelihood(string) >= typical * (len(string) + 1)
            ]
            if max(ratios, default=-1e9) >= model.least_ratio:
                out.append((m.start(), m.end()))
    return out


def test_formats_of_the_whole_table(spark, sf_dir, tables):
    """The spans of inferred formats against plain scoring of every run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = scan.fit_formats(docs)
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    for r in scan.scan_secrets(docs, model).collect():
        got = [(s.start, s.end) for s in r.spans if s.kind == "format"]
        assert got == formats_by_hand(model, texts[r.doc_id] or "")


def test_many_spans_take_linear_time():
    import time

    keys = strings("0123456789abcdef", 40, 60, 1)
    model = scan.model_of({"hex": keys, "assign": strings("0123456789ABCDEF", 40, 60, 6), "ordinary": strings("abcdefghij", 18, 60, 2)})
    text = " ".join(strings("0123456789abcdef", 30, 8000, 3) + strings("0123456789ABCDEF", 40, 100, 4))
    started = time.time()
    spans = scan.all_spans(model, text)
    assert time.time() - started < 2 and sum(k == "hex" for _, _, k, _ in spans) == 8000


def test_rows_of_a_hot_id_are_sampled_apart(spark):
    rows = [(None, f"token = {'%016x' % (i * 7919)} words{i} here") for i in range(900)] + [(i, f"plain text{i} only") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert "assign" in scan.fit_formats(docs, sample_docs=200).formats


def test_frames(spark, docs, wide_docs, no_docs):
    model = scan.fit_formats(docs)
    rows = scan.scan_secrets(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind != "format"]
        assert base == base_by_hand(r.text or "")
    wide = scan.scan_secrets(wide_docs, model)
    assert wide.columns == wide_docs.columns and wide.count() == wide_docs.count()
    assert scan.scan_secrets(no_docs, scan.fit_formats(no_docs)).collect() == []


def test_query_on_whole_table(spark, sf_dir, tables):
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = op8_secrets(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_by_hand(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b.startswith(k) for b in base) for k in scan.KINDS[:3])
        assert set(base) <= set(r.spans.split(","))
