"""Counting and listing on hand-made events."""

import pytest
from pyspark.sql import functions as F

from lakemark.functions.events import event_text, list_text, row_text
from lakemark.operators.counts import count_by, count_claimed, keys_by_count
from lakemark.plans import reports
from lakemark.session import fresh_path, staging, stored
from lakemark.sources import drop_versions, ingest_csv, json_documents, read_documents, read_events, typed_documents, typed_events, versions
from lakemark.sources.versions import current_path

SCHEMA = "country_txt STRING, iyear INT, gname STRING"


@pytest.fixture
def events(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def test_equal_counts_share_a_row(events):
    report = reports.most_attacked_countries(
        events(("B", 1, "x"), ("A", 1, "x"), ("C", 1, "x"), ("C", 2, "x"))
    )
    assert [tuple(r) for r in report.collect()] == [(2, ["C"]), (1, ["A", "B"])]


def test_null_keys_are_counted_and_listed(events):
    given = events((None, None, "x"), (None, 1, "x"), ("A", 1, "x"), ("A", None, "x"))
    assert dict(map(tuple, count_by(given, "country_txt").collect())) == {None: 2, "A": 2}
    listed = reports.most_attacked_countries(given).select(list_text(F.col("keys"))).collect()
    assert [r[0] for r in listed] == ["[null, A]"]
    years = reports.year_documents(reports.attacks_per_year(given)).collect()
    assert [tuple(r) for r in years] == [("[null, 1]", 2)]


def test_unclaimed_events_share_one_zero_row(events):
    given = events(("A", 1, None), ("A", 1, ""), ("A", 1, "Unknown"), ("A", 1, "g"), ("A", 1, "g"))
    assert dict(map(tuple, count_claimed(given).collect())) == {"": 0, "g": 2}
    report = reports.claimed_attacks(given, parts=1).collect()
    assert [tuple(r) for r in report] == [(2, ["g"]), (0, [""])]
    documents = reports.group_documents(reports.claimed_attacks(given, parts=1))
    assert documents.columns == ["NumOfAttacks", "GroupName"]
    without = reports.claimed_attacks(given, keep_unclaimed=False).collect()
    assert [tuple(r) for r in without] == [(2, "g")]


def test_no_zero_row_when_all_are_claimed(events):
    report = reports.claimed_attacks(events(("A", 1, "g"), ("A", 1, "unknown"))).collect()
    assert [tuple(r) for r in report] == [(1, "g"), (1, "unknown")]


def test_reports_are_in_falling_order(events):
    rows = [(f"c{i % 7}", 1970 + i % 5, f"g{i % 11}") for i in range(200) for _ in range(i % 3)]
    given = events(*rows)
    for report in (
        reports.most_attacked_countries(given),
        reports.attacks_per_year(given),
        reports.claimed_attacks(given),
    ):
        counts = [r.n for r in report.collect()]
        assert counts == sorted(counts, reverse=True)


def test_top_k_orders_ties_by_name(events):
    given = events(*[(c, 1, "g") for c in "DDCCBAAA"])
    top = reports.top_k(given, 3).collect()
    assert [tuple(r) for r in top] == [("A", 3), ("C", 2), ("D", 2)]
    assert reports.preview(given, 5).count() == 5


def test_a_popular_count_is_split_into_bounded_parts_and_stays_whole(events):
    given = events(*[(f"c{i:04}", 1, "g") for i in range(1000)], ("top", 1, "g"), ("top", 1, "g"))
    listed = keys_by_count(count_by(given, "country_txt"), "country_txt", part_size=100)
    rows = listed.filter("n = 1").collect()
    assert {r.part for r in rows} <= set(range(10)) and len(rows) == 10
    assert {len(r["keys"]) for r in rows} == {100}
    ordered = [k for r in sorted(rows, key=lambda r: r.part) for k in r["keys"]]
    assert ordered == sorted(ordered)
    assert sorted(k for r in rows for k in r["keys"]) == [f"c{i:04}" for i in range(1000)]
    assert all(r["keys"] == sorted(r["keys"]) for r in rows)
    assert [tuple(r) for r in listed.filter("n = 2").collect()] == [(2, 0, ["top"])]


def test_layouts_hold_the_same_keys(events):
    given = events(*[(f"c{i:04}", 1, "g") for i in range(200)], ("top", 1, "g"), ("top", 1, "g"), (None, 1, "g"))
    counts = count_by(given, "country_txt")
    want = sorted(map(tuple, keys_by_count(counts, "country_txt", None).collect()), key=str)
    assert len(want) == 202 and (1, None) in want
    for parts in (1, 4):
        rows = keys_by_count(counts, "country_txt", parts).collect()
        assert len(rows) == {1: 2, 4: 5}[parts]
        assert sorted(((r.n, k) for r in rows for k in r["keys"]), key=str) == want
    documents = reports.country_documents(reports.most_attacked_countries(given, parts=4))
    assert documents.columns == ["NumOfAttacks", "Part", "Countries"]
    long = reports.country_documents(reports.most_attacked_countries(given, parts=None))
    assert long.columns == ["NumOfAttacks", "Countries"] and long.count() == 202


def test_top_k_on_a_dotted_field(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "`a.b` STRING")
    assert [tuple(r) for r in reports.top_k(df, 1, "a.b").collect()] == [("x", 2)]


def test_empty_collection(events):
    assert reports.most_attacked_countries(events()).count() == 0
    assert reports.top_k(events()).count() == 0


def test_row_text_writes_nulls_and_odd_column_names(spark):
    df = spark.createDataFrame([("a", None, 1.5)], "`x.y` STRING, `b c` STRING, d DOUBLE")
    assert df.select(row_text(df)).first()[0] == "[a, null, 1.5]"
    assert df.select(row_text(df, ["x.y"])).first()[0] == "[a]"


def test_typed_events_casts_and_adds_fields(spark):
    given = spark.createDataFrame([("A", "1999", 7)], "country_txt STRING, iyear STRING, id INT")
    with pytest.raises(ValueError, match="no fields .*gname"):
        typed_events(given)
    df = typed_events(given, missing="null")
    assert dict(df.dtypes) == {
        "country_txt": "string", "iyear": "int", "id": "int", "gname": "string",
    }
    assert df.first().asDict() == {"country_txt": "A", "iyear": 1999, "id": 7, "gname": None}


def test_wrong_type_fails(spark):
    df = typed_events(spark.createDataFrame([("A", "soon")], "country_txt STRING, iyear STRING"), missing="null")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_read_events_formats(spark, events, tmp_path, fmt):
    given = events(("A", 1, "g"), (None, 2, ""))
    given.write.format(fmt).save(str(tmp_path / "c"))
    back = read_events(spark, str(tmp_path / "c"), fmt, schema=SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        map(tuple, given.collect()), key=str
    )


def test_ingest_replaces_and_keeps_blank_texts(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "collection")
    source.write_text('country_txt,iyear,gname\n"A, B",1999,\n,,g\n')
    for _ in range(2):
        ingest_csv(spark, str(source), target)
    rows = read_events(spark, target).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("A, B", 1999, ""), ("", None, "g")], key=str)


def test_ingest_options(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "collection")
    source.write_bytes('country_txt;note\nPerú;"two\nlines"\n'.encode("latin-1"))
    ingest_csv(spark, str(source), target, sep=";", multiline=True, encoding="ISO-8859-1")
    rows = read_events(spark, target, missing="null").select("country_txt", "note")
    assert tuple(rows.first()) == ("Perú", "two\nlines")


def test_ingest_refuses_broken_rows(spark, tmp_path):
    source, target = tmp_path / "in.csv", tmp_path / "collection"
    source.write_text('country_txt,iyear,gname,note\nA,1999,g,"two\nlines"\nB,2000,h,one\n')
    schema = "country_txt STRING, iyear INT, gname STRING, note STRING"
    for given in (None, schema):
        with pytest.raises(ValueError, match="--multiline"):
            ingest_csv(spark, str(source), str(target), given)
    ingest_csv(spark, str(source), str(target), schema, multiline=True)
    rows = sorted(map(tuple, read_events(spark, str(target)).collect()))
    assert rows == [("A", 1999, "g", "two\nlines"), ("B", 2000, "h", "one")]
    source.write_text("country_txt,iyear\nA,soon\n")
    with pytest.raises(ValueError, match="does not fit"):
        ingest_csv(spark, str(source), str(target), "country_txt STRING, iyear INT", multiline=True)
    kept = sorted(map(tuple, read_events(spark, str(target)).collect()))
    assert kept == rows and versions(spark, str(target)).count() == 1
    assert len(list((target / "versions").iterdir())) == 1


def test_count_scan_reads_one_column(spark, events, tmp_path):
    path = str(tmp_path / "c")
    events(("A", 1, "g")).write.parquet(path)
    plan = count_by(read_events(spark, path), "country_txt")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<country_txt:string>" in plan


def test_listing_shuffles_the_events_once(spark, events, tmp_path):
    path = str(tmp_path / "c")
    events(*[(f"c{i % 5}", i, "g") for i in range(100)]).write.parquet(path)
    report = reports.most_attacked_countries(read_events(spark, path))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1


def test_a_missing_connector_is_named(spark):
    with pytest.raises(Exception, match="(?s)DATA_SOURCE_NOT_FOUND.*mongodb"):
        read_events(spark, fmt="mongodb", database="d", collection="c")


def test_fields_are_found_in_any_letter_case(spark, tmp_path):
    rows = [("A", "1999", "g", 1), ("A", None, None, 2)]
    given = spark.createDataFrame(rows, "Country_TXT STRING, id2 STRING, GName STRING, x INT").withColumnRenamed("id2", "IYEAR")
    df = typed_events(given)
    assert df.dtypes == [("country_txt", "string"), ("iyear", "int"), ("gname", "string"), ("x", "int")]
    assert [tuple(r) for r in df.collect()] == [("A", 1999, "g", 1), ("A", None, None, 2)]
    given.write.parquet(str(tmp_path / "c"))
    assert count_by(read_events(spark, str(tmp_path / "c")), "country_txt").collect() == [("A", 2)]


def test_fields_are_named_or_asked_for(spark):
    given = spark.createDataFrame([("A", "1", "g", "h")], "`the country` STRING, iyear STRING, gname STRING, `a.b` STRING")
    with pytest.raises(ValueError, match="country_txt"):
        typed_events(given)
    df = typed_events(given, {"country_txt": "The Country", "gname": "a.b"})
    assert df.columns == ["country_txt", "iyear", "gname", "gname"]
    for fields, says in (({"country_txt": "nowhere"}, "nowhere"), ({"country": "the country"}, "no such fields")):
        with pytest.raises(ValueError, match=says):
            typed_events(given, fields, missing="null")
    twice = spark.createDataFrame([("A", "B", 1, "g")], "country_txt STRING, c STRING, iyear INT, gname STRING")
    with pytest.raises(ValueError, match="may be any of"):
        typed_events(twice.withColumn("d", F.col("c")).toDF("country_txt", "COUNTRY_txt", "iyear", "gname", "d"))
    with pytest.raises(ValueError, match="missing"):
        typed_events(given, missing="skip")


def test_letter_case_counts_where_the_session_says_so(spark):
    given = spark.createDataFrame([("A", 1, "g")], "Country_TXT STRING, iyear INT, gname STRING")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="country_txt"):
            typed_events(given)
        assert typed_events(given, {"country_txt": "Country_TXT"}).first().country_txt == "A"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.fixture
def loaded(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "collection")
    schema = "country_txt STRING, iyear INT, gname STRING"

    def load(text):
        source.write_text("country_txt,iyear,gname\n" + text)
        return ingest_csv(spark, str(source), target, schema)

    return target, load


def test_a_failed_load_leaves_the_collection(spark, loaded):
    target, load = loaded
    with pytest.raises(ValueError):
        load("A,soon,g\n")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|UNABLE_TO_INFER_SCHEMA"):
        read_events(spark, target)
    first = load("A,1,g\nB,2,h\n")
    reader = read_events(spark, target)
    with pytest.raises(ValueError):
        load("A,1,g\n" * 50 + "A,soon,g\n")
    assert sorted(map(tuple, read_events(spark, target).collect())) == [("A", 1, "g"), ("B", 2, "h")]
    second = load("C,3,i\n")
    assert [tuple(r) for r in read_events(spark, target).collect()] == [("C", 3, "i")]
    # Who began to read before the load still finds the rows, and may ask for them by name.
    assert reader.count() == 2 and read_events(spark, target, version=first).count() == 2
    rows = [(r.number, r.version, r.rows) for r in versions(spark, target).orderBy("number").collect()]
    assert rows == [(1, first, 2), (2, second, 1)]
    assert drop_versions(spark, target) == [first] and drop_versions(spark, target) == []
    assert read_events(spark, target).count() == 1
    with pytest.raises(LookupError):
        read_events(spark, target, version="x")


def test_plain_folders_have_no_versions(spark, events, tmp_path):
    path = str(tmp_path / "c")
    events(("A", 1, "g")).write.parquet(path)
    assert current_path(spark, path) == path and versions(spark, path) is None
    for call in (lambda: current_path(spark, path, "x"), lambda: drop_versions(spark, path)):
        with pytest.raises(LookupError):
            call()


DOCUMENTS = [
    '{"gname":"g","country_txt":"A","iyear":1999,"n":{"b":1,"a":[1,"x"]}}',
    '{"iyear":"2000","extra":1.50,"country_txt":null}',
    "  ",
    '{"country_txt":"A","it\'s \\"odd\\".":true}',
    "{}",
]


def test_documents_have_fields_of_their_own(lines):
    docs = typed_documents(json_documents(lines(*DOCUMENTS)))
    rows = [tuple(r) for r in docs.select("country_txt", "iyear", "gname", event_text(docs)).collect()]
    assert rows == [
        ("A", 1999, "g", '[g, A, 1999, {"a":[1,"x"],"b":1}]'), (None, 2000, None, "[2000, 1.5, null]"),
        ("A", None, None, "[A, true]"), (None, None, None, "[]"),
    ]
    assert dict(map(tuple, count_by(docs, "country_txt").collect())) == {"A": 2, None: 2}


def test_broken_and_wrong_documents(spark, lines, tmp_path):
    bad = lines(*DOCUMENTS, "[1]", "{oops", "7")
    with pytest.raises(Exception, match="not a document"):
        json_documents(bad).collect()
    assert json_documents(bad, broken="drop").count() == 4
    wrong = json_documents(lines('{"country_txt":"A","iyear":"soon","gname":1}'))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        typed_documents(wrong).select("iyear").collect()
    assert typed_documents(wrong, wrong="null").select("country_txt", "iyear", "gname").first() == ("A", None, "1")
    apart = json_documents(lines('{"Country":"A","when":{"year":1}}'))
    with pytest.raises(ValueError, match="no document has"):
        typed_documents(apart)
    paths = {"country_txt": "$.Country", "iyear": "$.when.year"}
    assert typed_documents(apart, paths, missing="null").select("country_txt", "iyear").first() == ("A", 1)
    assert typed_documents(json_documents(lines())).collect() == []
    (tmp_path / "d.json").write_text("\n".join(DOCUMENTS))
    assert read_documents(spark, str(tmp_path / "d.json")).count() == 4


def test_documents_are_read_once_typed(spark, tmp_path):
    (tmp_path / "d.json").write_text("\n".join(DOCUMENTS))
    plan = count_by(read_documents(spark, str(tmp_path / "d.json")), "country_txt")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan


def test_staged_tables_go_at_the_end(spark, events, tmp_path):
    with staging(spark):
        frame = stored(events(("A", 1, "g")), "x")
        path = frame.inputFiles()[0].rpartition("/")[0]
        with staging(spark):
            inner = stored(frame, "y").inputFiles()[0].rpartition("/")[0]
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(inner).count()
        assert spark.read.parquet(path).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
