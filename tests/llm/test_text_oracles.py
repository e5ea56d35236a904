import math

import pytest

from lakemark.llm.oracles import ORACLES
from lakemark.llm.queries import QUERIES


def sortable(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir)
    rows = sorted((tuple(r) for r in got.collect()), key=sortable)
    want = tables.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    want = sorted(want, key=sortable)
    assert len(rows) == len(want)
    for a, b in zip(rows, want):
        assert all(
            x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12, abs_tol=1.1e-3)) for x, y in zip(a, b)
        ), (a, b)
