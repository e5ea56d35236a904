"""Collections that are replaced as a whole: versions, and a manifest that says which one holds.

A collection is a folder with a sub-folder for each version and a manifest, to which a load adds
one row when its version is complete and checked. Readers take the version of the last row. So
a load that fails leaves no trace that a reader follows, and one that runs while others read
does not take their files away.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemark.session import remove

MANIFEST_SCHEMA = "number BIGINT, version STRING, rows BIGINT, source STRING, loaded_at TIMESTAMP"


def _place(collection: str, *parts: str) -> str:
    return "/".join([collection.rstrip("/"), *parts])


def versions(spark: SparkSession, collection: str) -> DataFrame | None:
    """The manifest, a row per version; None if there is no such collection here."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(_place(collection, "manifest"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_path(spark: SparkSession, path: str, version: str | None = None) -> str:
    """Where the rows of a collection are: its last version, or the one asked for.

    A path without a manifest is a plain folder of files and is returned as it is.
    """
    manifest = versions(spark, path)
    if manifest is None:
        if version is not None:
            raise LookupError(f"{path} has no versions")
        return path
    rows = manifest if version is None else manifest.filter(F.col("version") == version)
    # Two loads that ended at the same time have one number: either is whole, one is the last.
    last = rows.agg(F.max(F.struct("number", "version"))).first()[0]
    if last is None:
        raise LookupError(f"{path} has no version {version or ''}".rstrip())
    return _place(path, "versions", last["version"])


def replace(df: DataFrame, collection: str, source: str = "") -> str:
    """Write ``df`` as the new version of a collection; its name is returned.

    The version is written beside the others and read back; only if all rows and columns are there
    is it added to the manifest. A failure before that removes what was written and leaves the
    collection as it was.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    place = _place(collection, "versions", version)
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(place)
        written = seen.get["rows"]
        back = spark.read.schema(df.schema).parquet(place)
        if back.count() != written:
            raise RuntimeError(f"{place}: {written} rows were written, others are there")
    except BaseException:
        remove(spark, place)
        raise
    manifest = versions(spark, collection)
    last = manifest.agg(F.max("number")).first()[0] if manifest is not None else None
    row = spark.range(1).select(
        F.lit((last or 0) + 1).cast("bigint").alias("number"), F.lit(version).alias("version"), F.lit(written).cast("bigint").alias("rows"),
        F.lit(source).alias("source"), F.current_timestamp().alias("loaded_at"),
    )
    row.coalesce(1).write.mode("append").json(_place(collection, "manifest"))
    return version


def drop_versions(spark: SparkSession, collection: str, keep: int = 1) -> list[str]:
    """Remove the files of all but the last ``keep`` versions; their names are returned.

    For times at which nobody reads them. The manifest stays: it says what was loaded when.
    """
    if keep < 1:
        raise ValueError("the last version is kept")
    manifest = versions(spark, collection)
    if manifest is None:
        raise LookupError(f"{collection} has no versions")
    # A row per load; those that are kept are a few.
    kept = manifest.orderBy(F.desc("number"), F.desc("version")).limit(keep).select("version")
    old = [r["version"] for r in manifest.join(kept, "version", "left_anti").select("version").collect()]
    return [version for version in old if remove(spark, _place(collection, "versions", version))]
