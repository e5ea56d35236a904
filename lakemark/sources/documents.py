"""Collections of documents without a schema: each has fields of its own, of any type.

A document is a VARIANT next to the names of its fields in the order in which it has them. The
report fields are taken out of it by path and cast by their declared type.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.constants import DOCUMENT, DOCUMENT_FIELDS
from lakemark.sources.events import EVENT_FIELDS
from lakemark.sources.lake import read_lines


def json_documents(lines: DataFrame, broken: str = "error") -> DataFrame:
    """Lines with a JSON object each as ``(document VARIANT, document_fields ARRAY<STRING>)``.

    Blank lines are no documents. A line that is not one object fails, or is left out with
    ``broken="drop"``.
    """
    if broken not in ("error", "drop"):
        raise ValueError(f"broken must be 'error' or 'drop', not {broken!r}")
    value = F.col("value")
    # The names of the fields are null for whatever is not an object.
    names = F.when(F.try_parse_json(value).isNotNull(), F.json_object_keys(value))
    if broken == "error":
        failed = F.raise_error(F.concat(F.lit("not a document: "), F.substring(value, 1, 100)))
        names = F.coalesce(names, failed.cast("array<string>"))
    rows = lines.filter(F.trim(value) != "").select(F.try_parse_json(value).alias(DOCUMENT), names.alias(DOCUMENT_FIELDS))
    return rows if broken == "error" else rows.filter(F.col(DOCUMENT_FIELDS).isNotNull())


def json_path(name: str) -> str:
    """Path of a top-level field, whatever its name has in it."""
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def typed_documents(
    documents: DataFrame, fields: Mapping[str, str] | None = None, wrong: str = "error", missing: str = "error"
) -> DataFrame:
    """Documents with the report fields in front: ``(country_txt, iyear, gname, document, ...)``.

    A document without a field has null there. A value that its type does not take fails, or is
    null with ``wrong="null"``. ``fields`` names the path of a report field that has another
    (``{"iyear": "$.when.year"}``). A field that no document has would make a report say that
    all events are nowhere: one scan makes sure that there is one, unless ``missing="null"``.
    """
    if wrong not in ("error", "null") or missing not in ("error", "null"):
        raise ValueError(f"unknown option: wrong={wrong!r}, missing={missing!r}")
    given = dict(fields or {})
    unknown = set(given) - set(EVENT_FIELDS.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    paths = {name: given.get(name, json_path(name)) for name in EVENT_FIELDS.names}
    document = F.col(DOCUMENT)
    if missing == "error":
        seen = documents.agg(F.count("*"), *[F.count(F.try_variant_get(document, path, "variant")) for path in paths.values()]).first()
        absent = [path for path, n in zip(paths.values(), seen[1:]) if not n]
        if seen[0] and absent:
            raise ValueError(f"no document has {absent}; name other paths (fields), or take nulls (missing='null')")
    get = F.variant_get if wrong == "error" else F.try_variant_get
    typed = [get(document, paths[f.name], f.dataType.simpleString()).alias(f.name) for f in EVENT_FIELDS]
    return documents.select(*typed, DOCUMENT, DOCUMENT_FIELDS)


def read_documents(spark: SparkSession, path: str, broken: str = "error", fields: Mapping[str, str] | None = None,
                   wrong: str = "error", missing: str = "error", **options: str) -> DataFrame:
    """Typed documents of a file or folder with a JSON object a line; ``options`` are those of
    ``read_lines``, such as ``encoding``."""
    return typed_documents(json_documents(read_lines(spark, path, **options), broken), fields, wrong, missing)

