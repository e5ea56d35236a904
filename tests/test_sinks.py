"""Round trips through the writers."""

import glob

import pytest

from lakemark.plans import reports
from lakemark.session import shared_folder
from lakemark.sinks import write_column_values, write_documents, write_report

REPORT = "n BIGINT, country_txt STRING, mean DOUBLE"
ROWS = [(5, "B", 0.0), (18770, "Iraq", 65.17763141998562), (5, "A", 1.5), (66, "Suriname", 2.0)]
TEXT = ["(18770,(Iraq,65.17763141998562))", "(66,(Suriname,2.0))", "(5,(A,1.5))", "(5,(B,0.0))"]


def part_files(path):
    return sorted(glob.glob(f"{path}/part-*"))


def read_in_order(path):
    found = []
    for name in part_files(path):
        with open(name) as file:
            found += file.read().splitlines()
    return found


def test_report_is_one_sorted_file(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.createDataFrame(ROWS, REPORT).repartition(4), path, single_file=True)
    assert len(part_files(path)) == 1
    assert read_in_order(path) == TEXT
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_report(spark.createDataFrame(ROWS, REPORT), path)


def test_large_report_is_several_files_in_order(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = [(i % 97, f"c{i}", float(i)) for i in range(5000)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_report(spark.createDataFrame(rows, REPORT), path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(part_files(path)) > 1
    expected = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert read_in_order(path) == [f"({n},({c},{m}))" for n, c, m in expected]


def test_nulls_are_written_out_and_rows_sorted_once(spark, tmp_path):
    path = str(tmp_path / "report")
    report = spark.createDataFrame([(2, "A", None), (1, None, 1.0), (3, "B", 2.5)], REPORT).orderBy("mean")
    write_report(report, path)
    assert read_in_order(path) == ["(3,(B,2.5))", "(2,(A,null))", "(1,(null,1.0))"]
    plan = report.orderBy("n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort ") == 1


def test_column_values_have_the_asked_number_of_files(spark, tmp_path):
    df = spark.range(2000).selectExpr("cast(id as string) a", "cast(id % 700 as string) b").repartition(8)
    for files in (1, 3):
        path = str(tmp_path / f"v{files}")
        write_column_values(df, path, files)
        for column, different in ((0, 2000), (1, 700)):
            assert 1 <= len(part_files(f"{path}/column={column}")) <= files
            assert spark.read.parquet(f"{path}/column={column}").distinct().count() == different


def test_report_documents_hold_the_mean_as_text(spark):
    report = spark.createDataFrame(ROWS, REPORT)
    documents = reports.energy_documents(report)
    assert documents.columns == ["NumOfAttacks", "Country", "Average Production of Energy"]
    assert (18770, "Iraq", "65.17763141998562") in [tuple(r) for r in documents.collect()]
    assert reports.defense_documents(report).columns[2] == "Average expenditure for Defense"


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_documents_are_added(spark, tmp_path, fmt):
    path = str(tmp_path / "documents")
    documents = reports.energy_documents(spark.createDataFrame(ROWS, REPORT))
    for run in (1, 2):
        write_documents(documents, path, fmt)
        assert spark.read.schema(documents.schema).format(fmt).load(path).count() == 4 * run
    write_documents(documents, path, fmt, mode="overwrite")
    assert spark.read.schema(documents.schema).format(fmt).load(path).count() == 4


def test_column_values_have_a_folder_per_column(spark, tmp_path):
    path = str(tmp_path / "values")
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3, "x")], "p STRING, n INT, q STRING")
    write_column_values(df, path)
    first = spark.read.parquet(f"{path}/column=0").collect()
    third = spark.read.parquet(f"{path}/column=2").collect()
    assert sorted(r[0] for r in first) == ["a", "b"]
    assert sorted((r[0] for r in third), key=str) == [None, "x"]


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_single_file_is_sorted_by_many_tasks(spark, tmp_path, monkeypatch):
    """The bytes of a sort in one task, ties and nulls included."""
    rows = [(i * 7919 % 500, f"c{i % 40}" if i % 9 else None, float(i % 3) if i % 5 else None) for i in range(3000)]
    report = spark.createDataFrame(rows, REPORT).repartition(8)
    write_report(report, str(tmp_path / "one"), single_file=True)
    (file,) = part_files(tmp_path / "one")
    key = lambda r: (-r[0], r[1] is not None, r[1] or "", r[2] is not None, r[2] or 0.0)
    text = lambda r: f"({r[0]},({r[1] or 'null'},{'null' if r[2] is None else r[2]}))\n"
    assert open(file).read() == "".join(map(text, sorted(rows, key=key)))
    write_report(report.limit(0), str(tmp_path / "none"), single_file=True)
    assert "".join(open(f).read() for f in part_files(tmp_path / "none")) == ""
