"""Profiling columns, choosing and storing the key."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemark.operators import profile
from lakemark.operators.joins import join_profiled
from lakemark.sources import first_line, read_lines, read_table, read_texts


def frame(spark, **columns):
    names = list(columns)
    schema = ", ".join(f"`{n}` {'INT' if n.startswith('int') else 'STRING'}" for n in names)
    return spark.createDataFrame(list(zip(*columns.values())), schema)


def candidate_names(df):
    found = profile.candidates(profile.profile_columns(df)).collect()
    return {r.column_name: r.different_values for r in found}


FIVE = ["a", "b", "c", "d", "e"]


def test_group_limits(spark):
    df = frame(spark, four=["a", "b", "c", "d", "d"], five=FIVE, int_five=[1, 2, 3, 4, 5])
    assert candidate_names(df) == {"five": 5}


def test_one_sentinel_group_is_allowed(spark):
    rest = ["a", "b", "c", "d"]
    df = frame(
        spark,
        with_null=[None, None, *rest, "e"],
        with_zero=["0", "0", *rest, "e"],
        with_word=["null", "null", *rest, "e"],
        null_and_zero=[None, "0", *rest, "e"],
        zero_and_word=["0", "null", *rest, "e"],
        null_and_word=[None, "null", *rest, "e"],
        null_is_a_group=[None, "a", "b", "c", "d", "d", "d"],
    )
    assert candidate_names(df) == {
        "with_null": 6, "with_zero": 6, "with_word": 6, "null_is_a_group": 5,
    }


def test_marks_in_values_are_no_sentinels(spark):
    df = frame(spark, k=["=0", "=null", "#0", "0", "x"])
    row = profile.profile_columns(df).first()
    assert (row.different_values, row.sentinel_groups) == (5, 1)


def test_integer_column_is_never_a_key_and_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, int_id=list(range(100)), k=[f"v{i % 7}" for i in range(100)]).write.parquet(path)
    columns = profile.profile_columns(spark.read.parquet(path))
    assert [tuple(r) for r in columns.collect()] == [(1, "k", 7, 0)]
    plan = columns._jdf.queryExecution().toString()
    assert "ReadSchema: struct<k:string>" in plan and "int_id" not in plan.split("ReadSchema")[-1]


def test_key_is_the_fewest_groups_then_the_leftmost(spark):
    df = frame(spark, many=list("abcdefg"), few=list("abcdeee"), tie=list("vwxyzzz"))
    assert tuple(profile.choose_key(profile.profile_columns(df)).first()) == (1, True)


def test_no_candidates(spark):
    for df in (frame(spark, a=["x", "y"], b=["x", "x"]), frame(spark, int_a=[1])):
        columns = profile.profile_columns(df)
        assert tuple(profile.choose_key(columns).first()) == (0, False)
        stored = profile.metadata(columns, "d").collect()
        assert [tuple(r) for r in stored] == [("d", None, None, 0)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(x, x) for x in FIVE], "`a.b` STRING, `c ``d` STRING")
    assert candidate_names(df) == {"a.b": 5, "c `d": 5}
    assert profile.distinct_groups(df, "a.b").first()[0] == 5
    assert {r.column_name for r in profile.column_values(df).collect()} == {"a.b", "c `d"}


def test_distinct_groups_counts_null_once(spark):
    df = frame(spark, int_a=[None, None, 1, 2, 2])
    assert profile.distinct_groups(df, "int_a").first()[0] == 3
    assert profile.distinct_groups(df.filter("int_a > 9"), "int_a").first()[0] == 0


def test_long_values_are_told_apart_by_their_last_character(spark):
    long = "x" * 500
    df = frame(spark, k=[long + c for c in "abcab"] + [long, None])
    row = profile.profile_columns(df).first()
    assert (row.different_values, row.sentinel_groups) == (5, 1)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["0", "null", "", "a", "b", "é" * 40, "é" * 41])),
            st.one_of(st.none(), st.text(alphabet="=#0nul", max_size=4)),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_profile_equals_grouping_each_column(spark, rows):
    df = spark.createDataFrame(rows, "p STRING, q STRING")
    found = {r.column_name: r for r in profile.profile_columns(df).collect()}
    for name in df.columns:
        groups = df.groupBy(name).count()
        assert found[name].different_values == groups.count()
        alone = groups.filter(f"{name} IS NULL OR {name} IN ('null', '0')").count()
        assert found[name].sentinel_groups == alone
        assert profile.distinct_groups(df, name).first()[0] == groups.count()
    values = {(r.column_name, r.value): r.n for r in profile.column_values(df).collect()}
    expected = {}
    for row in rows:
        for pair in zip(df.columns, row):
            expected[pair] = expected.get(pair, 0) + 1
    assert values == expected


def test_inferred_types_decide(spark, tmp_path):
    """The same numbers are a candidate as text and none as numbers."""
    path = tmp_path / "t.csv"
    path.write_text("id,name\n" + "".join(f"{i},n{i}\n" for i in range(10)))
    assert candidate_names(read_table(spark, str(path))) == {"name": 10}
    as_text = read_table(spark, str(path), schema="id STRING, name STRING")
    # One "0" among the texts is a single sentinel group.
    assert candidate_names(as_text) == {"id": 10, "name": 10}


def test_store_and_load(spark, tmp_path):
    path = str(tmp_path / "metadata")
    few, many = frame(spark, a=list("xxxxx"), b=FIVE), frame(spark, a=FIVE, b=list("vwxyz"))
    profile.save(profile.metadata(profile.profile_columns(few), "first"), path)
    profile.save(profile.metadata(profile.profile_columns(many), "second"), path)
    assert profile.load_key(spark, path, "first") == 1
    assert profile.load_key(spark, path, "second") == 0
    assert profile.load_metadata(spark, path, "second").count() == 3

    # Storing again replaces one dataset and leaves the other.
    profile.save(profile.metadata(profile.profile_columns(many), "first"), path)
    assert profile.load_key(spark, path, "first") == 0
    assert profile.load_metadata(spark, path, "first").count() == 3
    assert profile.load_key(spark, path, "second") == 0
    with pytest.raises(LookupError, match="third"):
        profile.load_key(spark, path, "third")


def test_profile_reads_once_and_moves_no_long_values(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200).select(
        F.repeat(F.lit("long text "), 1000).alias("text"), F.col("id").cast("string").alias("k")
    ).write.parquet(path)
    columns = profile.profile_columns(spark.read.parquet(path))
    columns.collect()
    plan = columns._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
    before_shuffle = plan.split("Expand")[1]
    assert "sha2" in before_shuffle


def test_types_and_profile_in_one_pass(spark, tmp_path):
    """The same text columns and groups as with types inferred first."""
    path = tmp_path / "t.csv"
    rows = ["id;name;n;d;ts;b;mixed;blank;years;half"]
    for i in range(40):
        rows.append(f"{i};n{i % 9};{i / 4};2020-01-{i % 28 + 1:02};2020-01-01 10:00:0{i % 10};{'TRUE' if i % 2 else 'false'};{i if i % 2 else 'x' + str(i)};;{'2020' if i % 2 else '2020-01-02'};{'0' if i % 5 else ''}")
    path.write_text("\n".join(rows) + "\n;null;;;;;;;;\n")
    inferred = read_table(spark, str(path), ";")
    want = {tuple(r) for r in profile.profile_columns(inferred).collect()}
    found = profile.profile_texts(read_texts(spark, str(path), ";"))
    assert {tuple(r) for r in found.collect()} == want
    assert {r[1] for r in want} == {"name", "mixed", "blank"}
    assert profile.choose_key(found).first() == profile.choose_key(profile.profile_columns(inferred)).first()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2 and "Python" not in plan


def test_sketched_key_equals_counted_key(spark):
    frames = [
        spark.createDataFrame([(f"a{i}", f"b{i % 7}", f"c{i % 400}", f"d{i % 8}" if i % 3 else None, "0" if i % 2 else None, i) for i in range(3000)], "a STRING, b STRING, c STRING, d STRING, e STRING, f INT"),
        spark.createDataFrame([(f"a{i % 3}", "x", None) for i in range(50)], "a STRING, b STRING, c STRING"),
        spark.createDataFrame([(f"a{i % 6}", f"b{i % 6}") for i in range(50)], "`a.x` STRING, b STRING"),
        spark.createDataFrame([(f"a{i % 4}" if i else None,) for i in range(50)], "a STRING"),
        spark.createDataFrame([], "a STRING, b INT"),
        spark.range(3),
    ]
    for df in frames:
        assert profile.find_key(df).first() == profile.choose_key(profile.profile_columns(df)).first()


def test_only_columns_that_may_win_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(f"w{i}", f"n{i % 40}", f"x{i}", f"y{i % 7}") for i in range(20000)]
    spark.createDataFrame(rows, "wide STRING, near STRING, wider STRING, key STRING").write.parquet(path)
    found = profile.find_key(spark.read.parquet(path))
    assert tuple(found.first()) == (3, True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<key:string>" in plan


def input_bytes(spark):
    """Bytes that all stages so far have read."""
    store = spark.sparkContext._jsc.sc().statusStore()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    empty = jvm.java.util.ArrayList()
    stages = store.stageList(empty, False, False, gateway.new_array(jvm.double, 0), empty)
    return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).inputBytes() for i in range(stages.size())}


def test_a_profiled_join_reads_the_file_three_times(spark, tmp_path):
    lake, metadata = tmp_path / "totals.csv", str(tmp_path / "metadata")
    lake.write_text("id;country\n" + "".join(f"{i};c{i % 50}\n" for i in range(40000)))
    events = spark.createDataFrame([(f"c{i}", 1, "g") for i in range(3)], "country_txt STRING, iyear INT, gname STRING")
    events.count()
    before = input_bytes(spark)
    header = first_line(read_lines(spark, str(lake)))
    columns = profile.profile_texts(read_texts(spark, str(lake), ";", header))
    profile.save(profile.metadata(columns, "totals"), metadata)
    joined = join_profiled(spark, events, str(lake), metadata, "totals", ";", header)
    assert joined.count() == 3 * 800
    read = sum(n for stage, n in input_bytes(spark).items() if stage not in before)
    size = lake.stat().st_size
    # The first line is in the first 64 kB; the rest of the file is read twice.
    assert 2 * size <= read <= 3 * size
