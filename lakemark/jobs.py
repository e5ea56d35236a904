"""The reports as jobs: ``spark-submit lakemark/jobs.py <job> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakemark.constants import (
    CLAIMANT_FIELD,
    COMMA,
    COUNTRY_FIELD,
    DEFENSE_CODE,
    ENERGY_CODE,
    SEMICOLON,
    YEAR_FIELD,
)
from lakemark.operators import profile
from lakemark.operators.counts import count_by, count_claimed
from lakemark.operators.joins import most_bytes, parametric_join
from lakemark.plans import reports
from lakemark.session import staging, stored, tune
from lakemark.sinks import write_documents, write_report
from lakemark.sources import (
    dataset_name,
    drop_versions,
    ingest_csv,
    read_documents,
    read_events,
    read_lines,
    read_table,
    read_texts,
    strip_header,
)

LISTED_REPORTS = {
    "most-attacked-countries": (COUNTRY_FIELD, reports.country_documents),
    "attacks-per-year": (YEAR_FIELD, reports.year_documents),
    "claimed-attacks": (CLAIMANT_FIELD, reports.group_documents),
}
INDICATOR_REPORTS = {
    "attacks-energy": (ENERGY_CODE, reports.energy_documents),
    "attacks-defense": (DEFENSE_CODE, reports.defense_documents),
}


def _option(text: str) -> tuple[str, str]:
    name, mark, value = text.partition("=")
    if not mark:
        raise argparse.ArgumentTypeError(f"not name=value: {text}")
    return name, value


def parser() -> argparse.ArgumentParser:
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--events", help="path of the event collection")
    source.add_argument(
        "--events-format", default="parquet",
        help="parquet, json, mongodb, ..., or documents: JSON lines whose fields differ",
    )
    source.add_argument("--events-version", help="version of a loaded collection; the last by default")
    source.add_argument(
        "--event-field", type=_option, action="append", default=[],
        help="report field=column (or path of a document) where it has another name",
    )
    source.add_argument("--missing-fields", choices=["error", "null"], default="error")
    source.add_argument("--events-option", type=_option, action="append", default=[])

    sink = argparse.ArgumentParser(add_help=False)
    sink.add_argument("--out-format", default="json", help="json, parquet, mongodb, ...")
    sink.add_argument("--out-mode", default="append")
    sink.add_argument("--out-option", type=_option, action="append", default=[])

    lake = argparse.ArgumentParser(add_help=False)
    lake.add_argument(
        "--lake-option", type=_option, action="append", default=[],
        help="option of the reader, such as encoding=ISO-8859-1",
    )

    top = argparse.ArgumentParser(prog="lakemark")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in LISTED_REPORTS:
        job = jobs.add_parser(name, parents=[source, sink])
        job.add_argument("--out", help="path of the report documents")
        job.add_argument(
            "--parts", type=int, default=1,
            help="lists a count is spread over; 0 for a document per key",
        )
    for name in INDICATOR_REPORTS:
        job = jobs.add_parser(name, parents=[source, sink, lake])
        job.add_argument("lake", help="wide indicator file")
        job.add_argument("out", nargs="?", help="folder of the text report")
        job.add_argument("--code", help="another indicator code")
        job.add_argument("--documents", action="store_true", help="save documents, not text")
        job.add_argument("--many-files", action="store_true", help="write the text in parallel")

    profiles = argparse.ArgumentParser(add_help=False)
    profiles.add_argument("--metadata", help="path of the stored profiles, or of the documents")
    profiles.add_argument(
        "--metadata-format", help="json, mongodb, ...: one set of profile documents"
    )
    profiles.add_argument("--metadata-option", type=_option, action="append", default=[])

    job = jobs.add_parser("profile", parents=[profiles, lake])
    job.add_argument("lake", help="headered file")
    job.add_argument("sep")
    job.add_argument("--schema", help="column types; found in the pass of the profile without it")

    job = jobs.add_parser("join", parents=[source, sink, profiles, lake])
    job.add_argument("lake")
    job.add_argument("dataset", help="name the profile is stored under")
    job.add_argument("sep", choices=[COMMA, SEMICOLON])
    job.add_argument("--out", help="path of the joined rows; five are shown without it")
    job.add_argument("--as-text", action="store_true", help="whole events as text")
    job.add_argument("--skip-short-lines", action="store_true")

    job = jobs.add_parser("ingest")
    job.add_argument("csv")
    job.add_argument("collection")
    job.add_argument("--sep", default=",")
    job.add_argument("--multiline", action="store_true")
    job.add_argument("--schema", help="column types, which saves reading the file to infer them")
    job.add_argument("--csv-option", type=_option, action="append", default=[])
    job.add_argument("--keep", type=int, help="versions whose files are kept; all by default")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "ingest":
        ingest_csv(
            spark, args.csv, args.collection, args.schema, args.sep, args.multiline,
            **dict(args.csv_option),
        )
        if args.keep:
            drop_versions(spark, args.collection, args.keep)
        return
    if args.job == "profile":
        options, dataset = dict(args.lake_option), dataset_name(args.lake)
        if args.schema:
            found = profile.profile_columns(read_table(spark, args.lake, args.sep, args.schema, **options))
        else:
            found = profile.profile_texts(read_texts(spark, args.lake, args.sep, **options))
        # Stored, so that showing and saving it do not profile twice.
        columns = stored(found, "profile")
        profile.candidates(columns).orderBy("column_index").show(truncate=False)
        found = profile.metadata(columns, dataset)
        if args.metadata_format:
            place, options = _documents_of(args, dataset)
            write_documents(profile.documents(found), place, args.metadata_format, "overwrite", **options)
        else:
            profile.save(found, args.metadata)
        return

    events = _events_of(spark, args)
    if args.job in LISTED_REPORTS:
        key, documents = LISTED_REPORTS[args.job]
        counts = count_claimed(events) if key == CLAIMANT_FIELD else count_by(events, key)
        if key == COUNTRY_FIELD:
            # Stored, so that the preview and the report share one event scan.
            counts = stored(counts, "counts")
            reports.top_counts(counts, key).show(truncate=False)
        _save(documents(reports.listed(counts, key, args.parts or None)), args)
    elif args.job in INDICATOR_REPORTS:
        code, documents = INDICATOR_REPORTS[args.job]
        lines = strip_header(read_lines(spark, args.lake, **dict(args.lake_option)))
        report = reports.indicator_report(events, lines, args.code or code)
        if args.documents:
            _save(documents(report), args)
        else:
            write_report(report, args.out, single_file=not args.many_files)
    else:
        lines = strip_header(read_lines(spark, args.lake, **dict(args.lake_option)))
        index, known = _stored_key(spark, args), most_bytes(spark, args.lake)
        for given in (events, lines):
            reports.preview(given).show(truncate=False)
        joined = parametric_join(
            events, lines, args.sep, index, strict=not args.skip_short_lines, as_text=args.as_text,
            known_bytes=known,
        )
        if args.out:
            _save(joined, args)
        else:
            reports.preview(joined).show(truncate=False)


def _events_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    named, options = dict(args.event_field), dict(args.events_option)
    if args.events_format == "documents":
        return read_documents(spark, args.events, fields=named, missing=args.missing_fields, **options)
    return read_events(
        spark, args.events, args.events_format, fields=named, missing=args.missing_fields,
        version=args.events_version, **options,
    )


def _documents_of(args: argparse.Namespace, dataset: str) -> tuple[str | None, dict[str, str]]:
    """Where the profile documents of a dataset are: a sub-path of its own or, in a store
    without paths, a collection of its own."""
    options = dict(args.metadata_option)
    if args.metadata:
        return profile.dataset_place(args.metadata, dataset), options
    return None, {"collection": dataset} | options


def _stored_key(spark: SparkSession, args: argparse.Namespace) -> int:
    """Key column index of the dataset's profile, in either form; fails if there is none."""
    if not args.metadata_format:
        return profile.load_key(spark, args.metadata, args.dataset)
    place, options = _documents_of(args, args.dataset)
    reader = spark.read.format(args.metadata_format).options(**options)
    return profile.key_of_documents(reader.load(place) if place else reader.load())


def _save(documents: DataFrame, args: argparse.Namespace) -> None:
    write_documents(
        documents, args.out, args.out_format, args.out_mode, **dict(args.out_option)
    )


def main(argv: Sequence[str] | None = None) -> None:
    jobs = parser()
    args = jobs.parse_args(argv)
    if args.job in ("profile", "join") and not (args.metadata or args.metadata_format):
        jobs.error("name the stored profiles by --metadata")
    if args.job in INDICATOR_REPORTS and not (args.out or args.documents):
        jobs.error("give the report a folder, or --documents")
    spark = tune(SparkSession.builder.appName(f"lakemark {args.job}").getOrCreate())
    # What the job stored on its way goes when its results are written.
    with staging(spark):
        run(spark, args)


if __name__ == "__main__":
    main()
