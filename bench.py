"""Time the headline operators; prints one JSON line.

The events, the lake files and the profiled tables are staged once, before anything is
timed, so a time is that of the operator and of reading its input.

BENCH_SF_DIR    folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default 8)
BENCH_RUNS      timed runs per operator, the best counts (default 2)
BENCH_COMPARE   1 to time other shapes of the same work as well
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.constants import CLAIMANT_FIELD, COMMA, COUNTRY_FIELD, ENERGY_CODE, SEMICOLON, YEAR_FIELD
from lakemark.functions.events import quoted_name
from lakemark.functions.lines import key_first_comma, series_mean
from lakemark.operators import profile
from lakemark.operators.counts import count_by
from lakemark.operators.joins import indicator_match_lists, indicator_matches, join_profiled, parametric_join
from lakemark.plans import reports
from lakemark.session import fresh_path, stored
from lakemark.sinks import write_report
from lakemark.sources import read_lines, read_table, strip_header
from lakemark.workload import standins

#: Lines for each country in the file beyond the broadcast limit.
LARGE_LINES = 2_000


@dataclass
class Staged:
    """Frames and paths that the operators start from."""

    events: DataFrame
    skewed: DataFrame
    indicators: str
    totals: str
    large: DataFrame
    tables: dict[str, DataFrame]


def stage(spark: SparkSession, sf_dir: str) -> Staged:
    """Write the inputs; ``skewed`` has a third of its events in one country."""
    events = stored(standins.events(spark, sf_dir), "events")
    top = reports.top_k(events, 1).first()[0]
    moved = F.when(F.pmod(F.xxhash64(*events.columns), F.lit(3)) == 0, F.lit(top)).otherwise(F.col(COUNTRY_FIELD))
    indicators = standins.lake_file(spark, standins.indicator_lines(spark, sf_dir), standins.INDICATOR_HEADER, "indicators")
    totals = standins.lake_file(spark, standins.total_lines(spark, sf_dir), standins.TOTALS_HEADER, "totals")
    few = strip_header(read_lines(spark, totals))
    # One line in LARGE_LINES keeps its country, so the result does not grow with the file.
    many = few.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(LARGE_LINES))))
    suffix = F.when(F.col("i") == 1, F.lit("")).otherwise(F.concat(F.lit(" "), F.col("i").cast("string")))
    large = many.select(F.regexp_replace("value", "^([^;]*;[^;]*)(;.*)$", F.concat(F.lit("$1"), suffix, F.lit("$2"))).alias("value"))
    names = ("documents", "orders", "part")
    return Staged(
        events, stored(events.withColumn(COUNTRY_FIELD, moved), "skewed"), indicators, totals, stored(large, "large"),
        {n: stored(standins.table(spark, sf_dir, n), n) for n in names},
    )


def wide_lines(spark: SparkSession, staged: Staged) -> DataFrame:
    return strip_header(read_lines(spark, staged.indicators))


def report_file(spark: SparkSession, staged: Staged) -> DataFrame:
    path = fresh_path(spark, "report")
    write_report(reports.attacks_energy(staged.events, wide_lines(spark, staged)), path, single_file=True)
    return read_lines(spark, path)


def profiled(spark: SparkSession, staged: Staged) -> DataFrame:
    place = fresh_path(spark, "metadata")
    columns = profile.profile_columns(read_table(spark, staged.totals, SEMICOLON))
    profile.save(profile.metadata(columns, "totals"), place)
    return join_profiled(spark, staged.events, staged.totals, place, "totals", SEMICOLON)


Operator = Callable[[SparkSession, Staged], DataFrame]

HEADLINE: dict[str, Operator] = {
    "events_by_country": lambda s, g: count_by(g.events, COUNTRY_FIELD),
    "most_attacked_countries": lambda s, g: reports.country_documents(reports.most_attacked_countries(g.events)),
    "attacks_per_year": lambda s, g: reports.year_documents(reports.attacks_per_year(g.events)),
    "claimed_attacks": lambda s, g: reports.group_documents(reports.claimed_attacks(g.events, parts=1)),
    "top5_countries": lambda s, g: reports.top_k(g.events, 5),
    "attacks_energy": lambda s, g: reports.attacks_energy(g.events, wide_lines(s, g)),
    "attacks_defense": lambda s, g: reports.attacks_defense(g.events, wide_lines(s, g)),
    "attacks_energy_file": report_file,
    "indicator_matches": lambda s, g: indicator_matches(g.events, wide_lines(s, g), ENERGY_CODE),
    "indicator_match_lists": lambda s, g: indicator_match_lists(g.events, wide_lines(s, g), ENERGY_CODE, part_size=50),
    "parametric_join_comma": lambda s, g: parametric_join(g.events, wide_lines(s, g), COMMA, 0, as_text=True),
    "parametric_join_semicolon": lambda s, g: parametric_join(
        g.events, strip_header(read_lines(s, g.totals)), SEMICOLON, 1
    ),
    "parametric_join_large": lambda s, g: parametric_join(g.events, g.large.hint("merge"), SEMICOLON, 1, broadcast_bytes=-1),
    "parametric_join_large_skewed": lambda s, g: parametric_join(g.skewed, g.large.hint("merge"), SEMICOLON, 1, broadcast_bytes=-1),
    "join_profiled": profiled,
    "column_profile_documents": lambda s, g: profile.profile_columns(g.tables["documents"]),
    "column_profile_orders": lambda s, g: profile.profile_columns(g.tables["orders"]),
    "key_column_part": lambda s, g: profile.find_key(g.tables["part"]),
    "column_values": lambda s, g: profile.column_values(g.tables["part"]),
    "claimants_long": lambda s, g: reports.claimed_attacks(g.events),
    "years": lambda s, g: count_by(g.events, YEAR_FIELD),
    "distinct_claimants": lambda s, g: profile.distinct_groups(g.events, CLAIMANT_FIELD),
}


def report_join_first(spark: SparkSession, staged: Staged) -> DataFrame:
    """The energy report with every event joined to the lines before counting."""
    lines = wide_lines(spark, staged).filter(F.col("value").contains(ENERGY_CODE))
    keyed = lines.distinct().select(key_first_comma(F.col("value")).alias(COUNTRY_FIELD), "value")
    joined = staged.events.join(keyed.hint("merge"), COUNTRY_FIELD)
    counted = joined.groupBy(COUNTRY_FIELD, "value").agg(F.count("*").alias("n"))
    report = counted.select("n", COUNTRY_FIELD, series_mean(F.col("value")).alias("mean"))
    return report.orderBy(F.desc("n"), COUNTRY_FIELD, "mean")


def profile_per_column(spark: SparkSession, staged: Staged) -> DataFrame:
    """The documents profile with a job of its own for every column."""
    df = staged.tables["documents"]
    parts = [
        count_by(df.select(quoted_name(name)), name).agg(
            F.lit(name).alias("column_name"), F.count("*").alias("different_values")
        )
        for name in profile.string_columns(df).values()
    ]
    for part in parts[:-1]:
        part.collect()
    return parts[-1]


def profile_count_distinct(spark: SparkSession, staged: Staged) -> DataFrame:
    """The documents profile as one aggregation of whole values."""
    df = staged.tables["documents"]
    return df.agg(*[F.count_distinct(quoted_name(c)).alias(c) for c in profile.string_columns(df).values()])


COMPARED: dict[str, Operator] = {
    "attacks_energy (join first)": report_join_first,
    "column_profile_documents (job per column)": profile_per_column,
    "column_profile_documents (count distinct)": profile_count_distinct,
}


def seconds(operator: Operator, spark: SparkSession, staged: Staged, runs: int) -> float:
    """Best time to build the plan and produce every row."""
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        operator(spark, staged).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakemark bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Staging also starts the executor and the compiler.
    start = time.perf_counter()
    staged = stage(spark, sf_dir)
    staging = round(time.perf_counter() - start, 3)
    queries = {name: seconds(run, spark, staged, runs) for name, run in HEADLINE.items()}
    result = {
        "metric": "headline_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "staging": staging,
    }
    if os.environ.get("BENCH_COMPARE") == "1":
        result["compared"] = {n: seconds(q, spark, staged, runs) for n, q in COMPARED.items()}
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
