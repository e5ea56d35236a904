"""Every registered query against its SQL oracle on whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

from lakemark.workload.catalog import QUERIES
from lakemark.workload.oracles import ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows_of(columns, rows):
    """Rows as a bag, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    ours = rows_of(result.columns, [tuple(r) for r in result.collect()])
    theirs = rows_of(columns, expected.fetchall())
    assert ours == theirs
    assert sum(ours.values()) > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        # One row of totals over a table is made of partial rows, one per task.
        assert slow not in plan or (slow == "SinglePartition" and sum(ours.values()) < 5), slow


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["n", "country_txt", "mean"]
    assert result.count() > 0
