"""Expressions over event documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemark.constants import DOCUMENT, DOCUMENT_FIELDS, UNKNOWN_CLAIMANT


def quoted_name(name: str) -> Column:
    """Column by its literal name, so that dots and spaces are part of it."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_claimed(claimant: Column) -> Column:
    """True when somebody is named; never null."""
    return claimant.isNotNull() & ~claimant.isin("", UNKNOWN_CLAIMANT)


def list_text(items: Column) -> Column:
    """Array as ``[a, b]`` text, with nulls written out."""
    return F.concat(
        F.lit("["), F.array_join(items.cast("array<string>"), ", ", "null"), F.lit("]")
    )


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """All values of a row as ``[v1, v2]`` text, in column order."""
    cells = [quoted_name(name).cast("string") for name in columns or df.columns]
    return list_text(F.array(*cells))


def document_text(document: Column, names: Column) -> Column:
    """The values that a document has as ``[v1, v2]`` text, in its order.

    ``document`` is a VARIANT object and ``names`` are its fields. A field that it does not have is
    not shown; one that is null is.
    """
    values = document.cast("map<string,variant>")
    return list_text(F.transform(names, lambda name: F.element_at(values, name).cast("string")))


def event_text(df: DataFrame) -> Column:
    """An event as text: the values of the document itself where rows have one, else those of
    all columns."""
    if {DOCUMENT, DOCUMENT_FIELDS} <= set(df.columns):
        return document_text(F.col(DOCUMENT), F.col(DOCUMENT_FIELDS))
    return row_text(df)
