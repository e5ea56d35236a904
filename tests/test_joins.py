"""Joining events to lines, small and large, even and skewed."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemark.operators import joins
from lakemark.operators.places import with_places
from lakemark.plans import reports
from lakemark.session import fresh_path

SCHEMA = "country_txt STRING, iyear INT, gname STRING"
CODE = "X.Y"

# The two ways of match_on_key: broadcast and shuffle.
WAYS = [{}, {"broadcast_bytes": -1}]


def wide(name, *cells, code=CODE):
    padded = [*cells] + [""] * (57 - len(cells))
    return ",".join(f'"{c}"' for c in [name, "AA", "label", code, *padded])


@pytest.fixture
def events(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_report_rows(events, lines):
    given = events(
        ("Bahamas", 1, "g"), ("Chad", 1, "g"), ("Chad", 2, "g"), ("Peru", 1, "g"), (None, 1, "g")
    )
    lake = lines(
        wide("Bahamas, The", "1", "3"),
        wide("Chad", "4"), wide("Chad", "4"),
        wide("Chad", "9", code="Z"),
        wide("Chad, North", "5"), wide("Chad, South"),
        wide("Mali", "7"), wide("", "8"),
    )
    report = reports.indicator_report(given, lake, CODE)
    assert [tuple(r) for r in report.collect()] == [
        (2, "Chad", 0.0), (2, "Chad", 4.0), (2, "Chad", 5.0), (1, "Bahamas", 2.0),
    ]
    whole = reports.indicator_report(given, lake, CODE, key="quoted")
    assert [tuple(r) for r in whole.collect()] == [(2, "Chad", 4.0)]
    with pytest.raises(ValueError):
        reports.indicator_report(given, lake, CODE, key="fuzzy")


def test_code_in_another_cell_selects_the_line(events, lines):
    report = reports.indicator_report(
        events(("A", 1, "g")), lines(wide("A", "2", code="other") + f',"{CODE}"'), CODE
    )
    assert [tuple(r) for r in report.collect()] == [(1, "A", 2.0)]


@pytest.mark.parametrize("limits", WAYS)
def test_matches_keep_every_event_and_line(events, lines, limits):
    given = events(*[("A", 1, "g")] * 3, ("A", 2, None), ("B", 1, "g"), (None, 1, "g"))
    lake = lines(wide("A", "1"), wide("A", "1"), wide("A, x"), wide("C"), wide("B", code="no"))
    rows = bag(joins.indicator_matches(given, lake, CODE, **limits))
    assert rows == {
        ("A", wide("A", "1"), "[A, 1, g]", 2): 3,
        ("A", wide("A", "1"), "[A, 2, null]", 2): 1,
        ("A", wide("A, x"), "[A, 1, g]", 1): 3,
        ("A", wide("A, x"), "[A, 2, null]", 1): 1,
    }


@pytest.mark.parametrize("limits", WAYS)
def test_match_lists_hold_the_same_events_in_bounded_rows(events, lines, limits):
    rows = [("A", i % 200, "g") for i in range(500)] + [("A", 7, "copy")] * 400 + [("B", 1, "g")]
    given, lake = events(*rows), lines(wide("A"), wide("A, x"), wide("B"))
    nested = joins.indicator_match_lists(given, lake, CODE, part_size=20, **limits)
    flat = joins.indicator_matches(given, lake, CODE)
    expanded = nested.select(
        "country_txt", "line", F.explode("events").alias("e"), "copies"
    ).select("country_txt", "line", "e.event", F.explode(F.array_repeat("copies", F.col("e.times").cast("int"))))
    assert bag(expanded) == bag(flat)
    longest, parts = nested.agg(F.max(F.size("events")), F.count_distinct("part")).first()
    # 900 events of A, of which 201 are different: lists of 20, and one of one.
    assert longest == 20 and parts == 11
    spread = joins.indicator_match_lists(given, lake, CODE, parts=3, **limits)
    assert spread.filter("country_txt = 'A'").select("part").distinct().count() == 3


@pytest.mark.parametrize("limits", WAYS)
def test_parametric_join_repeats_lines_and_skips_nulls(events, lines, limits):
    given = events(("A", 1, "g"), ("A", 1, "g"), ("B", 2, "h"), (None, 3, "g"))
    lake = lines("1,A", "1,A", '2,"A"', "3,C", "null,null")
    joined = joins.parametric_join(given, lake, ",", 1, **limits)
    assert joined.columns == ["country_txt", "iyear", "gname", "line"]
    assert bag(joined) == {("A", 1, "g", "1,A"): 4, ("A", 1, "g", '2,"A"'): 2}
    texts = joins.parametric_join(given, lines("2,B"), ",", 1, as_text=True, **limits)
    assert bag(texts) == {("B", "[B, 2, h]", "2,B"): 1}


@pytest.mark.parametrize("seed", range(3))
def test_joins_equal_brute_force(events, lines, seed):
    """Random events, a third of them in one country, against random lines."""
    rng = random.Random(seed)
    places = ["A", "B", "C", "D, The", "", None]
    rows = [
        ("A" if rng.random() < 1 / 3 else rng.choice(places), rng.randrange(3), rng.choice("xy"))
        for _ in range(300)
    ]
    texts = [
        wide(
            rng.choice(["A", "B", "D, The", "D", "E"]),
            *[rng.choice(["", str(rng.randrange(-5, 50))]) for _ in range(rng.randrange(58))],
            code=rng.choice([CODE, "Z"]),
        )
        for _ in range(40)
    ]
    texts += texts[:10]
    given, lake = events(*rows), lines(*texts)

    def whole_name(text):
        return text[1:].split('"')[0]

    expected = Counter(
        (*event, text) for event in rows for text in texts if event[0] == whole_name(text)
    )
    for limits in WAYS:
        assert bag(joins.parametric_join(given, lake, ",", 0, **limits)) == expected

    def mean(text):
        cells = [float(c) for c in text.split('"')[9::2] if c]
        return sum(cells) / len(cells) if cells and sum(cells) else 0.0

    counts = Counter(event[0] for event in rows)
    chosen = {text for text in texts if f'"{CODE}"' in text}
    short = {text: whole_name(text).split(",")[0] for text in chosen}
    report = Counter(
        (counts[short[t]], short[t], mean(t)) for t in chosen if counts[short[t]]
    )
    assert bag(reports.indicator_report(given, lake, CODE)) == report


def test_semicolon_keys_keep_quotes(events, lines):
    given = events(("A", 1, "g"), ('"A"', 2, "g"))
    joined = joins.parametric_join(given, lines('1;"A"', "1;B"), ";", 1)
    assert [r.iyear for r in joined.collect()] == [2]


def test_unknown_delimiter_and_short_lines(events, lines):
    given = events(("A", 1, "g"))
    with pytest.raises(ValueError, match="delimiter"):
        joins.parametric_join(given, lines("A"), "|", 0)
    with pytest.raises(Exception, match="line has no field 1"):
        joins.parametric_join(given, lines("A", "x,A"), ",", 1).collect()
    assert joins.parametric_join(given, lines("A", "x,A"), ",", 1, strict=False).count() == 1


def test_measured_bytes(spark, lines):
    assert joins.measured_bytes(lines("abc", "é", None)) == 5 + 3 * joins.ROW_BYTES
    assert joins.measured_bytes(lines()) == 0
    assert joins.measured_bytes(spark.range(12)) == 14 + 12 * joins.ROW_BYTES


@pytest.mark.parametrize("limits", WAYS)
def test_event_fields_keep_their_names(spark, lines, limits):
    fields = "country_txt STRING, salt INT, salts INT, copies INT, part INT, events INT, n INT, mean INT"
    given = spark.createDataFrame([("A", *range(1, 8)), ("B", *range(1, 8))], fields)
    joined = joins.parametric_join(given, lines("1,A"), ",", 1, **limits)
    assert joined.columns == [*given.columns, "line"]
    assert [tuple(r) for r in joined.collect()] == [("A", *range(1, 8), "1,A")]
    texts = joins.parametric_join(given, lines("1,A"), ",", 1, as_text=True, **limits)
    assert [tuple(r) for r in texts.collect()] == [("A", "[A, 1, 2, 3, 4, 5, 6, 7]", "1,A")]
    nested = joins.indicator_match_lists(given, lines(wide("A")), CODE, part_size=5, **limits)
    assert nested.count() == 1
    for name in ("line", "LINE"):
        clash = given.withColumn(name, F.lit(8))
        with pytest.raises(ValueError, match=name):
            joins.parametric_join(clash, lines("1,A"), ",", 1, **limits)
        texts = joins.parametric_join(clash, lines("1,A"), ",", 1, as_text=True, **limits)
        assert [tuple(r) for r in texts.collect()] == [("A", "[A, 1, 2, 3, 4, 5, 6, 7, 8]", "1,A")]
        matches = joins.indicator_matches(clash, lines(wide("A")), CODE, **limits)
        assert [r.event for r in matches.collect()] == ["[A, 1, 2, 3, 4, 5, 6, 7, 8]"]


@pytest.fixture
def small_skew(spark):
    """Settings under which a few thousand rows of a key are skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        # A partition is split between the outputs of different tasks.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_hot_events_are_split_at_run_time(events, lines, small_skew):
    """A third of the events in one country, beyond the broadcast limit."""
    hot = [("A", i, "g" * (i % 50)) for i in range(6000)]
    given = events(*hot, *[(f"c{i}", i, "g" * (i % 50)) for i in range(12000)]).repartition(8)
    lake = lines("A", *[f"c{i}" for i in range(12000)])
    joined = joins.parametric_join(given, lake, ",", 0, broadcast_bytes=-1)
    assert len(joined.collect()) == 18000
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_hot_country_of_a_report_is_split_at_run_time(events, lines, small_skew):
    """A country with most of the different lines, beyond the broadcast limit."""
    given = events(*[(f"c{i}", 1, "g") for i in range(200)])
    lake = lines(*[wide("c7", str(i), str(i * 7919 % 10007)) for i in range(6000)], *[wide(f"c{i}") for i in range(200)])
    report = reports.indicator_report(given, lake.repartition(8), CODE)
    assert len(report.collect()) == 6200
    assert "skew=true" in plan_of(report)


def test_events_without_lines_are_not_shuffled(spark, events, lines, tmp_path):
    path = str(tmp_path / "c")
    events(*[(f"c{i % 100}", i, "g") for i in range(5000)]).write.parquet(path)
    nested = joins.indicator_match_lists(spark.read.parquet(path), lines(wide("c7", "1")), CODE, parts=1)
    assert sum(len(r.events) for r in nested.collect()) == 50
    plan = plan_of(nested)
    semi = plan.index("LeftSemi")
    # In the plan's text what is below comes later: every shuffle is above the semi-join.
    assert "Exchange hashpartitioning(country_txt" in plan[:semi]
    assert "Exchange hashpartitioning(country_txt" not in plan[semi:].split("BroadcastExchange")[0]


@pytest.mark.parametrize("join", [
    lambda e, l: joins.indicator_matches(e, l, CODE, broadcast_bytes=-1),
    lambda e, l: joins.parametric_join(e, l, ",", 0, broadcast_bytes=-1),
    lambda e, l: joins.parametric_join(e, l, ",", 0, as_text=True, broadcast_bytes=-1),
    lambda e, l: joins.indicator_match_lists(e, l, CODE, parts=1, broadcast_bytes=-1),
])
def test_events_without_a_line_leave_before_the_shuffle(spark, events, lines, tmp_path, join):
    """Beyond the broadcast limit: held against the bits of the keys where they are read, and
    shuffled as typed columns without texts."""
    path = str(tmp_path / "c")
    events(*[(f"c{i % 500}", i, "g") for i in range(5000)], (None, 1, "g")).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join(spark.read.parquet(path), lines(wide("c7", "1"), wide("c9")))
        found = joined.collect()
        assert len(found) in (20, 2)
        plan = plan_of(joined)
        semi = plan.index("LeftSemi")
        assert "SortMergeJoin" in plan[:semi] and "Exchange hashpartitioning(country_txt" in plan[:semi]
        # Below it are the scan of the events and the bits, no shuffle of events.
        assert "Exchange hashpartitioning(country_txt" not in plan[semi:].split("BroadcastQueryStage")[0]
        if "event" not in joined.columns and "events" not in joined.columns:
            return
        if "event" in joined.columns:
            assert "array_join" not in plan[semi:] and "array_join" in plan[: plan.index("SortMergeJoin")]
        metrics = sent_rows(joined)
        assert max(metrics) <= 20, metrics
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sent_rows(df):
    """Rows that each shuffle of a finished plan wrote."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_key_bits_miss_no_key(spark, events, lines):
    """Very many keys, so that many share a row of the table."""
    given = events(*[(f"c{i}", i, "g") for i in range(4000)], (None, 0, "g"))
    lake = spark.createDataFrame([(f"c{i}", "x") for i in range(0, 8000, 2)] + [(None, "x")], "country_txt STRING, line STRING")
    for words in (1, 7, joins.KEY_WORDS):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(joins, "KEY_WORDS", words)
            left = {r.country_txt for r in joins.with_partner(given, lake, "country_txt").collect()}
        assert {f"c{i}" for i in range(0, 4000, 2)} <= left and None not in left
    assert len(left) < 2100


def test_places_of_one_large_group(spark, small_skew):
    """A group in all partitions; no partition holds it."""
    rows = [(1, f"k{i:05}") for i in range(3000)] + [(None, f"k{i}") for i in range(3)] + [(2, None), (2, "a")]
    df = spark.createDataFrame(random.Random(0).sample(rows, len(rows)), "n INT, key STRING").repartition(8)
    placed = with_places(df, ["n"], ["key"])
    want = {}
    for n, key in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or "")):
        want[n, key] = sum(1 for other in want if other[0] == n)
    got = {(r.n, r.key): r.place for r in placed.collect()}
    assert got == want
    plan = plan_of(placed)
    assert "SinglePartition" not in plan and "FileScan parquet" in plan
    assert placed.columns == ["n", "key", "place"]


def test_hot_lines_are_split_at_run_time(events, lines, small_skew):
    """A key that is hot among the lines only is split by AQE."""
    given = events(*[(f"c{i}", i, "g") for i in range(3000)])
    lake = lines(*[f"c7,{i},{'x' * 40}" for i in range(4000)], *[f"c{i}" for i in range(3000)])
    joined = joins.parametric_join(given, lake.repartition(8), ",", 0, broadcast_bytes=-1)
    assert len(joined.collect()) == 7000
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_small_lines_leave_the_events_unshuffled(spark, events, lines, tmp_path):
    path = str(tmp_path / "c")
    events(("A", 1, "g")).write.parquet(path)
    joined = joins.parametric_join(spark.read.parquet(path), lines("A"), ",", 0)
    plan = plan_of(joined)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "Python" not in plan


def test_report_counts_before_it_joins(spark, events, lines, tmp_path):
    """The join reads stored counts, a row per country, and no events."""
    path = str(tmp_path / "c")
    events(*[("A", i, "g") for i in range(50)]).write.parquet(path)
    report = reports.indicator_report(spark.read.parquet(path), lines(wide("A", "1")), CODE)
    plan = plan_of(report)
    assert plan.count("FileScan parquet") == 1 and path not in plan
    assert "ReadSchema: struct<country_txt:string,n:bigint>" in plan


def test_list_parts_shuffle_the_texts_twice(spark, events, lines, tmp_path):
    """Once to count equal texts, once to collect; the keys of the lines are broadcast."""
    path = str(tmp_path / "c")
    events(*[("A", i, "g") for i in range(50)]).write.parquet(path)
    nested = joins.indicator_match_lists(spark.read.parquet(path), lines(wide("A", "1")), CODE, parts=1)
    plan = plan_of(nested)
    assert plan.count("FileScan parquet") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(country_txt#\d+, (?:event|part)#", plan)) == 2


def test_quoted_key_is_evaluated_once(spark, tmp_path):
    path = tmp_path / "lake.csv"
    path.write_text('"A",1\n')
    keyed = joins.keyed_lines(spark.read.text(str(path)), ",", 0)
    plan = plan_of(keyed.filter(F.col("country_txt").isNotNull()))
    assert "isnotnull(coalesce" not in plan


def test_fresh_paths_differ(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
