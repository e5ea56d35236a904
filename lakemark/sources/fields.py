"""Fields of a frame by name, matched as the session matches column names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def folded(spark: SparkSession, name: str) -> str:
    """``name`` in the form in which this session holds two column names to be the same."""
    return name if spark.conf.get("spark.sql.caseSensitive").lower() == "true" else name.lower()


def find_field(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that the session takes ``name`` for; None if there is none.

    Two such columns are an error: which one is meant is the caller's to say.
    """
    spark = df.sparkSession
    found = [c for c in df.columns if folded(spark, c) == folded(spark, name)]
    if len(found) > 1:
        raise ValueError(f"field {name!r} may be any of {found}: name the one that is meant")
    return found[0] if found else None


def find_fields(df: DataFrame, names: Iterable[str], given: Mapping[str, str] | None = None, missing: str = "error") -> dict[str, str | None]:
    """The column of each field: the one that ``given`` names for it, else the one of its name.

    A field without a column fails, or is None with ``missing="null"``; a column that ``given``
    names has to be there in any case.
    """
    if missing not in ("error", "null"):
        raise ValueError(f"missing must be 'error' or 'null', not {missing!r}")
    names, given = list(names), dict(given or {})
    unknown = set(given) - set(names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}; there are {names}")
    found = {name: find_field(df, given.get(name, name)) for name in names}
    absent = [n for n, column in found.items() if column is None and (n in given or missing == "error")]
    if absent:
        wanted = [given.get(n, n) for n in absent]
        raise ValueError(f"the collection has no fields {wanted}, only {df.columns}; name others (fields), or take nulls (missing='null')")
    return found


def clashes(df: DataFrame, other: DataFrame, but: str) -> list[str]:
    """Columns of ``df`` that the session takes for columns of ``other``, ``but`` left out."""
    spark = df.sparkSession
    taken = {folded(spark, c) for c in other.columns} - {folded(spark, but)}
    return sorted(c for c in df.columns if folded(spark, c) in taken)
