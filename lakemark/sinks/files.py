"""Writers; rows come together in one file only where the caller asks for it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemark.constants import COUNTRY_FIELD
from lakemark.operators.profile import column_values
from lakemark.plans.reports import report_lines
from lakemark.session import fresh_path, remove

# Files that the rows of a single-file report are sorted into.
SORTED_PARTS = 32


def write_documents(
    documents: DataFrame,
    path: str | None = None,
    fmt: str = "json",
    mode: str = "append",
    **options: str,
) -> None:
    """Save report documents; by default a further run adds to what is there.

    ``fmt`` is any installed sink, such as ``json``, ``parquet``, or
    ``mongodb`` where the document-store connector is on the class path.
    """
    writer = documents.write.format(fmt).mode(mode).options(**options)
    writer.save(path) if path else writer.save()


def write_report(report: DataFrame, path: str, single_file: bool = False) -> None:
    """Write an indicator report as text, most events first; fails if ``path`` is there.

    Files are named in the order of the rows. With ``single_file`` the rows are sorted into at most
    ``SORTED_PARTS`` files by as many tasks, which one task then appends in their order, a line
    at a time. The rows are sorted here once; an order they come in is dropped by the optimizer.
    """
    order = [F.desc("n"), F.asc(COUNTRY_FIELD), F.asc("mean")]
    if not single_file:
        report_lines(report.orderBy(*order)).select("value").write.text(path)
        return
    spark, staged = report.sparkSession, fresh_path(report.sparkSession, "report-parts")
    ordered = report.repartitionByRange(SORTED_PARTS, *order).sortWithinPartitions(*order)
    report_lines(ordered).select("value").write.text(staged)
    parts = sorted(spark.read.text(staged).inputFiles())
    # A part is read as one split, so that its lines keep their order.
    whole = [spark.read.schema("value STRING").text(p, lineSep="\n").coalesce(1) for p in parts]
    lines = reduce(DataFrame.union, whole) if whole else spark.createDataFrame([], "value STRING")
    lines.coalesce(1).write.text(path)
    remove(spark, staged)


def write_column_values(df: DataFrame, path: str, files_per_column: int = 1) -> None:
    """Save the distinct values of every text column, a folder per column.

    A column has ``files_per_column`` files at most, each written by one task and
    holding the values of one hash; give more for columns with very many values.
    """
    values = column_values(df).withColumn("column", F.col("column_index"))
    share = F.pmod(F.xxhash64("value"), F.lit(files_per_column))
    values = values.withColumn("file_", share).repartition("column", "file_")
    values.select("column", "value").write.mode("overwrite").partitionBy("column").parquet(path)
