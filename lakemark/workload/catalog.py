"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.constants import (
    CLAIMANT_FIELD,
    COMMA,
    COUNTRY_FIELD,
    ENERGY_CODE,
    SEMICOLON,
    YEAR_FIELD,
)
from lakemark.functions.events import event_text, list_text, row_text
from lakemark.functions.lines import key_first_comma, key_plain, key_quoted
from lakemark.operators import profile
from lakemark.operators.counts import count_by, count_claimed
from lakemark.operators.joins import (
    indicator_match_lists,
    indicator_matches,
    indicator_means,
    join_profiled,
    parametric_join,
)
from lakemark.plans import reports
from lakemark.session import fresh_path
from lakemark.sinks import write_column_values, write_documents, write_report
from lakemark.sources import (
    dataset_name,
    first_line,
    ingest_csv,
    read_documents,
    read_events,
    read_lines,
    read_table,
    read_texts,
    strip_header,
)
from lakemark.workload import standins
from lakemark.workload.standins import events, indicator_lines, table, total_lines

# Small enough that lists of the test data span several parts.
SMALL_PART = 50

PROFILED_TABLES = ("part", "customer", "orders", "documents", "pages", "conversations")


def events_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(events(spark, sf_dir), COUNTRY_FIELD)


def events_by_country_named_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a collection whose fields are spelled in other letter case, or named apart."""
    path = fresh_path(spark, "named-apart")
    collection = events(spark, sf_dir)
    collection.select(
        F.col(COUNTRY_FIELD).alias("Country_TXT"), F.col(YEAR_FIELD).alias("IYEAR"), F.col(CLAIMANT_FIELD).alias("claimed by")
    ).write.parquet(path)
    return count_by(read_events(spark, path, fields={CLAIMANT_FIELD: "Claimed By"}), COUNTRY_FIELD)


def events_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(events(spark, sf_dir), YEAR_FIELD)


def events_by_claimant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_claimed(events(spark, sf_dir))


def most_attacked_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.country_documents(reports.most_attacked_countries(events(spark, sf_dir)))


def attacks_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.year_documents(reports.attacks_per_year(events(spark, sf_dir)))


def claimed_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.group_documents(reports.claimed_attacks(events(spark, sf_dir), parts=1))


def claimed_attacks_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per claiming group: the form that has no lists."""
    return reports.claimed_attacks(events(spark, sf_dir))


def claimed_attacks_fixed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of three lists for each count, told apart by their part."""
    return reports.group_documents(reports.claimed_attacks(events(spark, sf_dir), parts=3))


def claimed_attacks_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.claimed_attacks(events(spark, sf_dir), part_size=SMALL_PART)
    return report.select("n", "part", list_text(F.col("keys")).alias("keys"))


def top5_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_k(events(spark, sf_dir), 5)


def saved_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the country report and read it back."""
    path = fresh_path(spark, "documents")
    write_documents(most_attacked_countries(spark, sf_dir), path, "json")
    return spark.read.schema("NumOfAttacks BIGINT, Countries STRING").json(path)


def ingested_events_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load whole documents as events, texts of many lines included, and measure them."""
    source, target = fresh_path(spark, "prose-csv"), fresh_path(spark, "collection")
    prose = table(spark, sf_dir, "documents").select(
        F.col("lang").alias(COUNTRY_FIELD),
        F.pmod("doc_id", F.lit(50)).cast("int").alias(YEAR_FIELD),
        F.col("text").alias(CLAIMANT_FIELD),
    )
    quotes = {"quote": '"', "escape": '"'}
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    prose.write.options(header=True, **quotes, **kept).csv(source)
    ingest_csv(
        spark, source, target, prose.schema, multiline=True, maxCharsPerColumn="-1", **quotes, **kept
    )
    text = F.col(CLAIMANT_FIELD)
    return read_events(spark, target).groupBy(COUNTRY_FIELD, YEAR_FIELD).agg(
        F.count("*").alias("n"),
        F.sum(F.char_length(text)).alias("chars"),
        F.sum(F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))).alias("breaks"),
        F.min(F.md5(text)).alias("least_digest"),
    )


def ingested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the events from a CSV into a collection and count them by claimant."""
    source, target = fresh_path(spark, "events-csv"), fresh_path(spark, "collection")
    collection = events(spark, sf_dir)
    collection.write.option("header", True).csv(source)
    ingest_csv(spark, source, target, schema=collection.schema)
    return count_by(read_events(spark, target), CLAIMANT_FIELD)


def replaced_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a collection twice: events by year of both versions."""
    source, target = fresh_path(spark, "events-csv"), fresh_path(spark, "collection")
    collection = events(spark, sf_dir)
    collection.write.option("header", True).csv(f"{source}/whole")
    collection.filter(F.col("outcome") == "F").write.option("header", True).csv(f"{source}/finished")
    first = ingest_csv(spark, f"{source}/whole", target, schema=collection.schema)
    ingest_csv(spark, f"{source}/finished", target, schema=collection.schema)
    count = lambda name, **of: count_by(read_events(spark, target, **of), YEAR_FIELD).select(F.lit(name).alias("version"), "*")
    return count("current").unionByName(count("first", version=first))


def _document_file(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "event-documents")
    standins.event_documents(spark, sf_dir).write.text(path)
    return path


def row_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read from documents without a schema, each as the text of the values it has."""
    documents = read_documents(spark, _document_file(spark, sf_dir))
    return documents.select(COUNTRY_FIELD, YEAR_FIELD, CLAIMANT_FIELD, event_text(documents).alias("event"))


def indicator_matches_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a schema next to the lines of their country, beyond the broadcast limit."""
    documents = read_documents(spark, _document_file(spark, sf_dir))
    lines = _filed_indicator_lines(spark, sf_dir)
    return indicator_matches(documents, lines, ENERGY_CODE, broadcast_bytes=-1)


def lake_lines_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents from files in Latin-1, with how often it is there."""
    path = standins.encoded_file(spark, standins.prose_lines(spark, sf_dir), "ISO-8859-1", "prose")
    lines = read_lines(spark, path, encoding="ISO-8859-1")
    return lines.groupBy("value").agg(F.count("*").alias("n"))


def _indicator_file(spark: SparkSession, sf_dir: str) -> str:
    lines = indicator_lines(spark, sf_dir)
    return standins.lake_file(spark, lines, standins.INDICATOR_HEADER, "indicators")


def _filed_indicator_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_header(read_lines(spark, _indicator_file(spark, sf_dir)))


def _totals_file(spark: SparkSession, sf_dir: str) -> str:
    return standins.lake_file(
        spark, total_lines(spark, sf_dir), standins.TOTALS_HEADER, "totals"
    )


def lake_lines_no_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filed_indicator_lines(spark, sf_dir)


def lake_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three key rules on the lines they are meant for."""
    line = F.col("value")
    wide = indicator_lines(spark, sf_dir).select(
        F.lit(COMMA).alias("sep"),
        key_first_comma(line).alias("first_comma"),
        key_quoted(line, 0).alias("by_index"),
        key_quoted(line, 3).alias("field_3"),
    )
    plain = total_lines(spark, sf_dir).select(
        F.lit(SEMICOLON).alias("sep"),
        key_first_comma(line).alias("first_comma"),
        key_plain(line, 1).alias("by_index"),
        key_plain(line, 3).alias("field_3"),
    )
    return wide.unionByName(plain)


def lake_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A semicolon file as a typed table."""
    return read_table(spark, _totals_file(spark, sf_dir), SEMICOLON).select(
        F.col("nation").cast("int"),
        "country",
        F.col("suppliers").cast("bigint"),
        F.col("quantity").cast("bigint"),
    )


def indicator_series_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = indicator_means(indicator_lines(spark, sf_dir), ENERGY_CODE)
    return means.select(COUNTRY_FIELD, "mean")


def attacks_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.attacks_energy(events(spark, sf_dir), indicator_lines(spark, sf_dir))


def attacks_defense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.attacks_defense(events(spark, sf_dir), indicator_lines(spark, sf_dir))


def attacks_energy_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report by whole names: a qualified name matches nothing."""
    return reports.attacks_energy(
        events(spark, sf_dir), indicator_lines(spark, sf_dir), key="quoted"
    )


def attacks_energy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.energy_documents(attacks_energy(spark, sf_dir))


def attacks_energy_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the energy report as one text file and read it back."""
    path = fresh_path(spark, "report")
    write_report(attacks_energy(spark, sf_dir), path, single_file=True)
    return read_lines(spark, path)


def attacks_energy_file_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a null mean for a series without values, in parallel files.

    The nations of one region are given such a series.
    """
    path = fresh_path(spark, "report")
    bare = F.regexp_replace("value", '^((?:"[^"]*",){4}).*$', '$1""')
    lines = indicator_lines(spark, sf_dir).withColumn(
        "value", F.when(F.col("value").contains(", The"), bare).otherwise(F.col("value"))
    )
    report = reports.attacks_energy(events(spark, sf_dir), lines, empty="null")
    write_report(report, path)
    return read_lines(spark, path)


def attacks_defense_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.defense_documents(attacks_defense(spark, sf_dir))


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any five events; which ones is open, so they are counted."""
    return reports.preview(events(spark, sf_dir), 5).agg(F.count("*").alias("rows"))


def indicator_match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _filed_indicator_lines(spark, sf_dir)
    return indicator_matches(events(spark, sf_dir), lines, ENERGY_CODE)


def indicator_match_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _filed_indicator_lines(spark, sf_dir)
    nested = indicator_match_lists(
        events(spark, sf_dir), lines, ENERGY_CODE, part_size=SMALL_PART
    )
    shown = F.transform("events", lambda e: F.concat_ws(" x", e.event, e.times.cast("string")))
    return nested.select(
        COUNTRY_FIELD, "line", "copies", "part", F.array_join(shown, "; ").alias("events")
    )


def row_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    collection = events(spark, sf_dir)
    return collection.select(COUNTRY_FIELD, row_text(collection).alias("event"))


def parametric_join_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _filed_indicator_lines(spark, sf_dir)
    return parametric_join(events(spark, sf_dir), lines, COMMA, 0, as_text=True)


def parametric_join_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = strip_header(read_lines(spark, _totals_file(spark, sf_dir)))
    return parametric_join(events(spark, sf_dir), lines, SEMICOLON, 1)


def parametric_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as if the lines were too many to broadcast; hot keys are left to AQE."""
    lines = strip_header(read_lines(spark, _totals_file(spark, sf_dir)))
    return parametric_join(events(spark, sf_dir), lines, SEMICOLON, 1, broadcast_bytes=-1)


def join_on_profiled_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile a lake file, store the profile, and join by what it says.

    The file is read three times: its first line, all of it for the profile, all for the join.
    """
    path, stored = _totals_file(spark, sf_dir), fresh_path(spark, "metadata")
    dataset = dataset_name("totals.csv")
    header = first_line(read_lines(spark, path))
    columns = profile.profile_texts(read_texts(spark, path, SEMICOLON, header))
    profile.save(profile.metadata(columns, dataset), stored)
    return join_profiled(spark, events(spark, sf_dir), path, stored, dataset, SEMICOLON, header)


def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the profile of a table and read it back."""
    path = fresh_path(spark, "metadata")
    columns = profile.profile_columns(table(spark, sf_dir, "part"))
    profile.save(profile.metadata(columns, "part"), path)
    return profile.load_metadata(spark, path, "part")


def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the profile of a table as documents and read them back."""
    path = fresh_path(spark, "profile")
    columns = profile.profile_columns(table(spark, sf_dir, "orders"))
    write_documents(profile.documents(profile.metadata(columns, "orders")), path)
    schema = "`Column Number` INT, `Different Values` BIGINT, `Key Column` INT"
    return spark.read.schema(schema).json(path)


def _profile_of(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile.profile_columns(table(spark, sf_dir, name))

    return query


def _key_of(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile.find_key(table(spark, sf_dir, name))

    return query


def candidate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key candidates of the event collection, which has nulls and blanks."""
    return profile.candidates(profile.profile_columns(events(spark, sf_dir)))


def distinct_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_groups(events(spark, sf_dir), CLAIMANT_FIELD)


def column_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_values(table(spark, sf_dir, "part"))


def saved_column_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "values")
    write_column_values(table(spark, sf_dir, "part"), path)
    return spark.read.schema("value STRING, column INT").parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "events_by_country": events_by_country,
    "events_by_country_named_apart": events_by_country_named_apart,
    "events_by_year": events_by_year,
    "events_by_claimant": events_by_claimant,
    "most_attacked_countries": most_attacked_countries,
    "attacks_per_year": attacks_per_year,
    "claimed_attacks": claimed_attacks,
    "claimed_attacks_long": claimed_attacks_long,
    "claimed_attacks_fixed_parts": claimed_attacks_fixed_parts,
    "claimed_attacks_parts": claimed_attacks_parts,
    "top5_countries": top5_countries,
    "saved_documents": saved_documents,
    "ingested_events": ingested_events,
    "ingested_events_multiline": ingested_events_multiline,
    "replaced_collection": replaced_collection,
    "row_text": row_texts,
    "row_text_documents": row_text_documents,
    "indicator_matches_documents": indicator_matches_documents,
    "lake_lines_latin1": lake_lines_latin1,
    "lake_lines_no_header": lake_lines_no_header,
    "lake_keys": lake_keys,
    "lake_table": lake_table,
    "indicator_series_mean": indicator_series_mean,
    "attacks_energy": attacks_energy,
    "attacks_defense": attacks_defense,
    "attacks_energy_quoted": attacks_energy_quoted,
    "attacks_energy_documents": attacks_energy_documents,
    "attacks_energy_file": attacks_energy_file,
    "attacks_energy_file_nulls": attacks_energy_file_nulls,
    "attacks_defense_documents": attacks_defense_documents,
    "preview": preview_rows,
    "indicator_matches": indicator_match_rows,
    "indicator_match_lists": indicator_match_nested,
    "parametric_join_comma": parametric_join_comma,
    "parametric_join_semicolon": parametric_join_semicolon,
    "parametric_join_salted": parametric_join_salted,
    "join_profiled": join_on_profiled_key,
    **{f"column_profile_{name}": _profile_of(name) for name in PROFILED_TABLES},
    **{f"key_column_{name}": _key_of(name) for name in (*PROFILED_TABLES, "lineitem")},
    "candidate_columns": candidate_columns,
    "stored_profile": stored_profile,
    "profile_documents": profile_documents,
    "distinct_groups": distinct_groups,
    "column_values": column_values,
    "saved_column_values": saved_column_values,
}
