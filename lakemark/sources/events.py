"""The event collection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.constants import CLAIMANT_FIELD, COUNTRY_FIELD, YEAR_FIELD
from lakemark.functions.events import quoted_name
from lakemark.sources.fields import find_fields
from lakemark.sources.versions import current_path, replace

EVENT_FIELDS = T.StructType(
    [
        T.StructField(COUNTRY_FIELD, T.StringType()),
        T.StructField(YEAR_FIELD, T.IntegerType()),
        T.StructField(CLAIMANT_FIELD, T.StringType()),
    ]
)


def read_events(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    fields: Mapping[str, str] | None = None,
    missing: str = "error",
    version: str | None = None,
    **options: str,
) -> DataFrame:
    """Read the event collection with its three report fields typed.

    ``fmt`` is any installed source: ``parquet``, ``json``, ``csv``, ``orc``, or
    ``mongodb`` where the document-store connector is on the class path (it
    takes its connection, database and collection as options and no path).
    Give ``schema`` for json, or Spark reads the data once more to infer it. A path that
    ``ingest_csv`` loaded is read at its last version, or the one named by ``version``.
    ``fields`` and ``missing`` are those of ``typed_events``.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if path and fmt == "parquet":
        path = current_path(spark, path, version)
    return typed_events(reader.load(path) if path else reader.load(), fields, missing)


def typed_events(df: DataFrame, fields: Mapping[str, str] | None = None, missing: str = "error") -> DataFrame:
    """Give the report fields their names and declared types, where they stand.

    A field is the column that the session takes its name for, so by default in any letter case,
    or the one that ``fields`` names (``{"country_txt": "Country"}``). A field that is not there,
    or may be several columns, fails; with ``missing="null"`` one that is not there is null,
    behind the other columns. All others pass through.
    """
    found = find_fields(df, EVENT_FIELDS.names, fields, missing)
    types = {found[f.name]: f for f in EVENT_FIELDS if found[f.name] is not None}
    typed = [
        quoted_name(c).cast(types[c].dataType).alias(types[c].name) if c in types else quoted_name(c) for c in df.columns
    ]
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_FIELDS if found[f.name] is None]
    return df.select(*typed, *absent)


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    multiline: bool = False,
    **options: str,
) -> str:
    """Load a headered CSV into the event collection, replacing what readers find there.

    A blank text cell is stored as an empty text, a blank number as null.
    Multi-line cells make a file one task's work, so they are off by default. A
    row that does not fit the columns or their types, such as half of a cell with a line
    break, fails the load, and the collection stays as it was: a load writes a version of its own
    and makes it the current one at its end. The name of the version is returned. ``options``
    go to the CSV reader, such as ``encoding``; ``mode="PERMISSIVE"`` takes broken rows as
    they come.
    """
    options = {"mode": "FAILFAST"} | options
    reader = spark.read.options(header=True, sep=sep, multiLine=multiline, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    table = reader.csv(source)
    texts = [f.name for f in table.schema if isinstance(f.dataType, T.StringType)]
    filled = {name: F.coalesce(quoted_name(name), F.lit("")) for name in texts}
    try:
        return replace(table.withColumns(filled), target, source)
    except Exception as broken:
        if not any(sign in str(broken) for sign in ("MALFORMED_RECORD", "BadRecordException")):
            raise
        hint = "" if multiline else "; cells with line breaks need multiline (--multiline)"
        raise ValueError(f"{source}: a row does not fit the columns{hint}") from broken
