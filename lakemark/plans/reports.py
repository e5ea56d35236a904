"""The event reports, and the event counts next to an indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemark.constants import (
    CLAIMANT_FIELD,
    COUNTRY_FIELD,
    DEFENSE_CODE,
    DOC_COUNT,
    DOC_COUNTRIES,
    DOC_COUNTRY,
    DOC_DEFENSE_MEAN,
    DOC_ENERGY_MEAN,
    DOC_GROUPS,
    DOC_PART,
    DOC_YEARS,
    ENERGY_CODE,
    YEAR_FIELD,
)
from lakemark.functions.events import list_text, quoted_name
from lakemark.operators.counts import count_by, count_claimed, keys_by_count
from lakemark.operators.joins import indicator_means
from lakemark.session import stored


def listed(
    counts: DataFrame, key: str, parts: int | None = 1, part_size: int | None = None
) -> DataFrame:
    """Keys by their count, most first, in a layout of ``keys_by_count``."""
    rows = keys_by_count(counts, key, parts, part_size)
    second = [c for c in ("part", "key") if c in rows.columns]
    return rows.orderBy(F.desc("n"), *second)


def top_counts(counts: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The ``k`` keys with the largest counts, ties by name."""
    return counts.orderBy(F.desc("n"), quoted_name(key).asc()).limit(k)


def most_attacked_countries(events: DataFrame, parts: int | None = 1) -> DataFrame:
    """Countries by their number of events, most first: ``(n, keys)``."""
    return listed(count_by(events, COUNTRY_FIELD), COUNTRY_FIELD, parts)


def attacks_per_year(events: DataFrame, parts: int | None = 1) -> DataFrame:
    """Years by their number of events, most first: ``(n, keys)``."""
    return listed(count_by(events, YEAR_FIELD), YEAR_FIELD, parts)


def claimed_attacks(
    events: DataFrame, parts: int | None = None, part_size: int | None = None, keep_unclaimed: bool = True
) -> DataFrame:
    """Claiming groups by their number of events, most first.

    Rows ``(n, key)`` unless lists are asked for: a large part of all names may share a count.
    """
    counts = count_claimed(events, keep_unclaimed=keep_unclaimed)
    return listed(counts, CLAIMANT_FIELD, parts, part_size)


def top_k(events: DataFrame, k: int = 5, key: str = COUNTRY_FIELD) -> DataFrame:
    """The ``k`` keys with the most events, ties by name."""
    return top_counts(count_by(events, key), key, k)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at, in no order."""
    return df.limit(rows)


def indicator_report(
    events: DataFrame,
    lines: DataFrame,
    code: str,
    key: str = "first_comma",
    empty: str = "zero",
    bad: str = "error",
) -> DataFrame:
    """Event count and indicator mean per country: ``(n, country_txt, mean)``.

    Most events first. Different lines of one country give a row each, equal
    lines give one. Events are counted before the join, so one row per country
    meets the lines instead of every event.
    """
    located = events.filter(F.col(COUNTRY_FIELD).isNotNull())
    # Stored, so that Spark knows their size and broadcasts them below its limit, and so
    # that beyond it both sides are plain shuffled rows and AQE can split a hot country.
    counts = stored(count_by(located, COUNTRY_FIELD), "counts")
    means = indicator_means(lines, code, key, empty, bad)
    return (
        means.join(counts, COUNTRY_FIELD)
        .select("n", COUNTRY_FIELD, "mean")
        .orderBy(F.desc("n"), COUNTRY_FIELD, "mean")
    )


def attacks_energy(events: DataFrame, lines: DataFrame, **options) -> DataFrame:
    """Event counts next to the mean share of power made from oil."""
    return indicator_report(events, lines, ENERGY_CODE, **options)


def attacks_defense(events: DataFrame, lines: DataFrame, **options) -> DataFrame:
    """Event counts next to the mean share of output spent on defense."""
    return indicator_report(events, lines, DEFENSE_CODE, **options)


def country_documents(report: DataFrame) -> DataFrame:
    return _list_documents(report, DOC_COUNTRIES)


def year_documents(report: DataFrame) -> DataFrame:
    """Documents of the years, which name the years before the count."""
    documents = _list_documents(report, DOC_YEARS)
    return documents.select(DOC_YEARS, *[c for c in documents.columns if c != DOC_YEARS])


def group_documents(report: DataFrame) -> DataFrame:
    return _list_documents(report, DOC_GROUPS)


def _list_documents(report: DataFrame, list_field: str) -> DataFrame:
    """Documents of a listed report, one per row: the list, or the one key, as text.

    Several lists of one count are told apart by their part.
    """
    if "keys" in report.columns:
        text = list_text(F.col("keys"))
    else:
        text = list_text(F.array("key"))
    part = [F.col("part").alias(DOC_PART)] if "part" in report.columns else []
    return report.select(F.col("n").alias(DOC_COUNT), *part, text.alias(list_field))


def energy_documents(report: DataFrame) -> DataFrame:
    return _mean_documents(report, DOC_ENERGY_MEAN)


def defense_documents(report: DataFrame) -> DataFrame:
    return _mean_documents(report, DOC_DEFENSE_MEAN)


def _mean_documents(report: DataFrame, mean_field: str) -> DataFrame:
    """Documents of an indicator report, the mean as text."""
    return report.select(
        F.col("n").alias(DOC_COUNT),
        F.col(COUNTRY_FIELD).alias(DOC_COUNTRY),
        F.col("mean").cast("string").alias(mean_field),
    )


def report_lines(report: DataFrame) -> DataFrame:
    """An indicator report as ``(n,(country,mean))`` text, keeping its columns.

    What is null is written as ``null``.
    """
    n, country, mean = (
        F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("n", COUNTRY_FIELD, "mean")
    )
    text = F.concat(F.lit("("), n, F.lit(",("), country, F.lit(","), mean, F.lit("))"))
    return report.withColumn("value", text)
