"""Profile the columns of a table and find its most likely join key."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.constants import (
    DEFAULT_KEY_COLUMN,
    DOC_COLUMN_NUMBER,
    DOC_DIFFERENT_VALUES,
    DOC_KEY_COLUMN,
    MAX_SENTINEL_GROUPS,
    MIN_GROUPS,
    SENTINEL_TEXTS,
)
from lakemark.functions.events import quoted_name

# What a text may be besides a text, as bits.
KIND_NUMBER, KIND_TIME, KIND_TRUTH = 1, 2, 4
# Relative standard error of the sketches that rule out key columns.
SKETCH_ERROR = 0.02


def digest(value: Column) -> Column:
    """What stands for a text value in a shuffle: its SHA-256, null for null.

    Profiling a column of whole texts must not move the texts, and short values are
    treated alike: values are different exactly if their digests are.
    """
    return F.unhex(F.sha2(value, 256))


def sentinels(value: Column) -> Column:
    """A null, or one of the texts that stand for "no value"; never null. Takes digests."""
    texts = [digest(F.lit(t)) for t in SENTINEL_TEXTS]
    return value.isNull() | F.coalesce(value.isin(*texts), F.lit(False))


def distinct_groups(df: DataFrame, column: str) -> DataFrame:
    """Number of groups of one column, of any type; null is a group. Texts are shuffled as
    digests."""
    value = quoted_name(column)
    if isinstance(df.select(value).schema[0].dataType, T.StringType):
        value = digest(value)
    return df.agg(
        (F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0))).alias(
            "different_values"
        )
    )


def string_columns(df: DataFrame) -> dict[int, str]:
    """Position and name of the text columns, the only ones that can be keys.

    Every group of another type counts as a sentinel, so such a column either
    has too many sentinels or too few groups.
    """
    return {
        at: field.name
        for at, field in enumerate(df.schema)
        if isinstance(field.dataType, T.StringType)
    }


def column_values(df: DataFrame) -> DataFrame:
    """Distinct values of every text column with their row counts.

    ``(column_index, column_name, value, n)``; null is a value.
    """
    return _groups(df, lambda value: value)


def profile_columns(df: DataFrame) -> DataFrame:
    """Groups and sentinel groups of every text column, in one pass.

    The scan reads the text columns only. Rows are unpivoted and grouped by
    (column, digest): equal values meet before the shuffle, and the hash of the
    pair spreads a wide column over all tasks. Distinctness is by SHA-256.
    """
    return _profile(_groups(df, digest))


def _profile(groups: DataFrame) -> DataFrame:
    return groups.groupBy("column_index", "column_name").agg(
        F.count("*").alias("different_values"),
        F.sum(sentinels(F.col("value")).cast("bigint")).alias("sentinel_groups"),
    )


def profile_texts(texts: DataFrame) -> DataFrame:
    """The same profile of a table whose columns were all read as texts (``read_texts``), types and
    groups found in one pass.

    Every group of a column says whether its text may be a number, a date or time, or a truth
    value; a column is of such a type if all of its texts may be, nulls and blanks aside, as
    a reader that infers types has it, and is then left out like any that is no text.
    """
    value = F.col("value")
    tests = {
        KIND_NUMBER: value.try_cast("double").isNotNull(),
        KIND_TIME: value.try_cast("timestamp").isNotNull(),
        KIND_TRUTH: F.lower(value).isin("true", "false"),
    }
    kinds = sum((F.when(test, bit).otherwise(0) for bit, test in tests.items()), F.lit(0))
    # The kind is a function of the text, so any row of a group has it.
    groups = _groups(texts, lambda v: v, F.max(F.when(F.trim(value) != "", kinds)).alias("kinds"), digested=True)
    return (
        groups.groupBy("column_index", "column_name")
        .agg(
            F.count("*").alias("different_values"),
            F.sum(sentinels(value).cast("bigint")).alias("sentinel_groups"),
            F.coalesce(F.bit_and("kinds"), F.lit(0)).alias("kinds"),
        )
        .filter(F.col("kinds") == 0)
        .drop("kinds")
    )


def find_key(df: DataFrame, error: float = SKETCH_ERROR) -> DataFrame:
    """The row of ``choose_key`` for a table, with exact counts only where they can matter.

    One pass sketches the number of groups of every text column and finds its sentinels exactly,
    which moves a row per task. A column with too many sentinel groups is no candidate, and one whose
    number is, by six standard errors of the sketch, above that of a certain candidate is not
    the one with the fewest: only the digests of the others are counted.
    """
    texts = string_columns(df)
    columns = {at: quoted_name(name) for at, name in texts.items()}
    sketches = [F.approx_count_distinct(c, error).alias(f"n{at}") for at, c in columns.items()]
    flags = [
        F.coalesce(F.max(flag.cast("int")), F.lit(0)).alias(f"s{at}_{i}")
        for at, c in columns.items()
        for i, flag in enumerate([c.isNull(), *[c == text for text in SENTINEL_TEXTS]])
    ]
    if not texts:
        return choose_key(_groups_profile(df, []))
    seen = df.agg(*sketches, *flags).first()
    few = [at for at in texts if sum(seen[f"s{at}_{i}"] for i in range(1 + len(SENTINEL_TEXTS))) <= MAX_SENTINEL_GROUPS]
    wide = 6 * error
    # A null is a group that the sketch does not count.
    estimate = {at: seen[f"n{at}"] + seen[f"s{at}_0"] for at in few}
    certain = [n / (1 - wide) for n in estimate.values() if n / (1 + wide) >= MIN_GROUPS]
    bound = min(certain, default=float("inf"))
    possible = [at for at, n in estimate.items() if n / (1 + wide) <= bound and n / (1 - wide) >= MIN_GROUPS]
    return choose_key(_groups_profile(df, possible))


def _groups_profile(df: DataFrame, places: list[int]) -> DataFrame:
    """``profile_columns`` of some of the text columns."""
    return _profile(_groups(df, digest, columns={at: df.columns[at] for at in places}))


def _groups(
    df: DataFrame, token: Callable[[Column], Column], *more: Column, digested: bool = False, columns: dict[int, str] | None = None
) -> DataFrame:
    """Row counts of (column, token of the value) over the text columns, or some of them.

    ``more`` are aggregates of the value; with ``digested`` groups go by its digest.
    """
    texts = string_columns(df) if columns is None else columns
    if not texts:
        empty = "column_index INT, column_name STRING, value STRING, n BIGINT, kinds INT"
        return df.sparkSession.createDataFrame([], empty)
    narrow = df.select(*[token(quoted_name(name)).alias(str(at)) for at, name in texts.items()])
    names = F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])
    cells = narrow.unpivot([], [quoted_name(str(at)) for at in texts], "column_index", "value")
    group = digest(F.col("value")).alias("digest_") if digested else F.col("value")
    groups = (
        cells.groupBy("column_index", group)
        .agg(F.count("*").alias("n"), *more)
        .withColumn("column_index", F.col("column_index").cast("int"))
    )
    if digested:
        groups = groups.withColumnRenamed("digest_", "value")
    others = [c for c in groups.columns if c not in ("column_index", "value", "n")]
    return groups.select(
        "column_index", names[F.col("column_index")].alias("column_name"), "value", "n", *others
    )


def candidates(profile: DataFrame) -> DataFrame:
    """Columns that may be the key: few sentinel groups, enough groups."""
    return profile.filter(
        (F.col("sentinel_groups") <= MAX_SENTINEL_GROUPS)
        & (F.col("different_values") >= MIN_GROUPS)
    )


def choose_key(profile: DataFrame) -> DataFrame:
    """One row ``(key_column INT, has_candidates BOOLEAN)``.

    The candidate with the fewest groups, the leftmost of equals; the first
    column, flagged, if there is no candidate.
    """
    return candidates(profile).agg(
        F.coalesce(_fewest_groups(), F.lit(DEFAULT_KEY_COLUMN)).alias("key_column"),
        _fewest_groups().isNotNull().alias("has_candidates"),
    )


def _fewest_groups() -> Column:
    return F.min_by("column_index", F.struct("different_values", "column_index"))


def metadata(profile: DataFrame, dataset: str) -> DataFrame:
    """Stored form of a profile: a row per candidate and one key row.

    ``(dataset, column_number, different_values, key_column)``, where a row
    has either the middle two or the last. A profile has one row per column,
    so bringing the candidates into one row is bounded by the table's width
    and saves profiling twice.
    """
    none_int, none_long = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    chosen = F.struct(
        none_int.alias("column_number"),
        none_long.alias("different_values"),
        F.coalesce(_fewest_groups(), F.lit(DEFAULT_KEY_COLUMN)).alias("key_column"),
    )
    found = F.collect_list(
        F.struct(
            F.col("column_index").alias("column_number"),
            F.col("different_values"),
            none_int.alias("key_column"),
        )
    )
    packed = candidates(profile).agg(F.concat(found, F.array(chosen)).alias("documents"))
    return packed.select(F.inline("documents")).select(
        F.lit(dataset).alias("dataset"), "column_number", "different_values", "key_column"
    )


def save(stored: DataFrame, path: str) -> None:
    """Write stored profiles, replacing those of the same datasets only."""
    stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "dataset"
    ).parquet(path)


def documents(stored: DataFrame) -> DataFrame:
    """A stored profile under the field names of profile documents.

    Written as json, or to a document store, each document has only the fields
    that are not null.
    """
    return stored.select(
        F.col("column_number").alias(DOC_COLUMN_NUMBER),
        F.col("different_values").alias(DOC_DIFFERENT_VALUES),
        F.col("key_column").alias(DOC_KEY_COLUMN),
    )


def dataset_place(place: str, dataset: str) -> str:
    """Sub-path of one dataset's profile documents."""
    return f"{place.rstrip('/')}/{quote(dataset, safe='')}"


def load_metadata(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Stored profile of one dataset; reads only its folder."""
    schema = "column_number INT, different_values BIGINT, key_column INT, dataset STRING"
    stored = spark.read.schema(schema).parquet(path)
    return stored.filter(F.col("dataset") == dataset)


def load_key(spark: SparkSession, path: str, dataset: str) -> int:
    """Key column index stored for a dataset; one value, read to the driver."""
    stored = load_metadata(spark, path, dataset)
    return _first_key(stored, "key_column", f"dataset {dataset!r}")


def key_of_documents(found: DataFrame) -> int:
    """Key column index that profile documents name."""
    return _first_key(found, DOC_KEY_COLUMN, "these documents")


def _first_key(stored: DataFrame, field: str, place: str) -> int:
    key = quoted_name(field)
    row = stored.filter(key.isNotNull()).select(key.cast("int")).first()
    if row is None:
        raise LookupError(f"no key column stored for {place}")
    return row[0]
