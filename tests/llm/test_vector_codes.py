import hashlib
import math

import numpy as np
import pytest

from lakemark.llm.queries import op12_vector_codes
from lakemark.llm.vector_codes import decode_vectors, encode_vectors, fit_codebooks, nearest, with_label_errors

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def by_hand(rows, parts=4, entries=256, rounds=4):
    """The contract in plain Python over (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in kept) // parts) * parts
    points = [[math.floor(1024 * float(np.float32(x))) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    step = width // parts
    codes, errors, books = [[] for _ in kept], [0] * len(kept), []
    for p in range(parts):
        mine = [tuple(v[p * step : (p + 1) * step]) for v in points]
        book = mine[:entries]

        def assign():
            far = lambda v: [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
            return [min((d, i) for i, d in enumerate(far(v))) for v in mine]

        for _ in range(rounds):
            found = assign()
            for e in range(len(book)):
                own = [v for v, (_, i) in zip(mine, found) if i == e]
                if own:
                    book[e] = tuple(sum(x) // len(own) for x in zip(*own))
        for i, (d, e) in enumerate(assign()):
            codes[i].append(e)
            errors[i] += d
        books += [x for e in book for x in e]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return [(r[0], bytes(c).hex(), e, by_label[r[2]], digest) for r, c, e in zip(kept, codes, errors)]


def test_query_equals_plain_search(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in op12_vector_codes(spark, sf_dir).collect())
    points = np.floor(1024 * np.array([v for _, v, _ in given])).astype(int)
    assert len(got) == len(given) and points.shape[1] == 64
    assert got == by_hand_fast(given)


def by_hand_fast(rows):
    """``by_hand`` with whole distance tables, for tables of equal lengths."""
    rows = sorted(rows)
    points = np.floor(1024 * np.array([v for _, v, _ in rows])).astype(np.int64)
    codes, errors, books = [], 0, []
    for mine in np.split(points, 4, axis=1):
        book = mine[:256].copy()
        table = lambda: ((mine[:, None] - book[None]) ** 2).sum(axis=2)
        for _ in range(4):
            found = table().argmin(axis=1)
            for e in np.unique(found):
                own = mine[found == e]
                book[e] = own.sum(axis=0) // len(own)
        codes.append(table().argmin(axis=1))
        errors = errors + table().min(axis=1)
        books.append(book)
    labels = np.array([-1 if r[2] is None else r[2] for r in rows])
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    return sorted(
        (r[0], bytes(int(c[i]) for c in codes).hex(), int(errors[i]), int(errors[labels == labels[i]].sum()), digest) for i, r in enumerate(rows)
    )


@pytest.fixture
def odd_rows():
    source = np.random.default_rng(2)
    rows = [(i, [float(x) for x in source.integers(-3, 3, 8) / 4], i % 3) for i in range(60)]
    rows += [(None, [0.5] * 8, None), (3, [0.25] * 8, None), (3, [0.25] * 8, None), (70, [], 1), (71, [1.0, 2.0, -3.0], 1)]
    return rows + [(72, None, 1), (73, [1.0, None], 1), (74, [math.nan] * 8, 1), (75, [math.inf] * 8, 1)]


@pytest.mark.parametrize("entries", [5, 256])
def test_odd_rows_ties_and_repeats(spark, odd_rows, entries):
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(5)
    want = by_hand(odd_rows, entries=entries)
    key = lambda r: (str(r[0]), *r[1:])
    books = fit_codebooks(df, entries=entries)
    rows = with_label_errors(encode_vectors(df, books)).collect()
    got = [(r.vec_id, bytes(r.code).hex(), r.error, r.label_error, books.sha256) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)




def test_search_visits_enough():
    source = np.random.default_rng(1)
    for spread in (2, 50, 10**6):
        points, entries = source.integers(-spread, spread, (700, 6)), source.integers(-spread, spread, (256, 6))
        table = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        index, best = nearest(points, entries)
        assert (index == table.argmin(axis=1)).all() and (best == table.min(axis=1)).all()


def test_empty_large_and_clashing(spark):
    none = spark.createDataFrame([], SCHEMA)
    books = fit_codebooks(none)
    assert encode_vectors(none, books).collect() == [] and with_label_errors(encode_vectors(none, books)).collect() == []
    assert books.sha256 == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="too large"):
        fit_codebooks(spark.createDataFrame([(1, [1e30], 1)], SCHEMA))
    odd = spark.createDataFrame([(1, [1.0] * 4, 1, "x", "y", "z")], SCHEMA + ", code STRING, row_ STRING, `a.b` STRING")
    books = fit_codebooks(odd)
    rows = encode_vectors(odd, books)
    assert rows.columns == [*odd.columns, "error"] and bytes(rows.first().code) == bytes(4) and rows.first()["a.b"] == "z"
    assert decode_vectors(rows, books).first().vector == [1.0] * 4
