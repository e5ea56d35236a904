"""Places of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemark.functions.events import quoted_name
from lakemark.session import stored

# Bits of ``monotonically_increasing_id`` that count within a partition.
ROW_BITS = 33


def with_places(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """``df`` with the place of every row within its group, from 0, in ascending order.

    Rows are sorted by range over all tasks, so a group lies in as many partitions as it fills. A
    small table says how many rows of a group each partition has, and its prefix sums where
    the partition's rows of that group begin: no task holds a group. Rows should differ in the
    columns of ``group`` and ``order``; equal ones stay in one partition, in no set order.
    """
    keys = [quoted_name(c) for c in (*group, *order)]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Stored, as partitions are cut by a sample and must be the same ones for both readers.
    rows = stored(ordered.withColumn("at_", F.monotonically_increasing_id()), "places")
    rows = rows.withColumn("range_", F.shiftright("at_", ROW_BITS))
    members = [quoted_name(c).alias(f"group_{i}_") for i, c in enumerate(group)]
    first = rows.groupBy("range_", *members).agg(F.min("at_").alias("first_"), F.count("*").alias("rows_"))
    # One row for each partition that has rows of a group.
    earlier = Window.partitionBy(*[f"group_{i}_" for i in range(len(group))]).orderBy("range_")
    before = F.sum("rows_").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    first = first.withColumn("start_", F.coalesce(before, F.lit(0)) - F.col("first_"))
    first = stored(first.select(F.col("range_").alias("of_range_"), *[f"group_{i}_" for i in range(len(group))], "start_"), "starts")
    same = F.col("range_") == F.col("of_range_")
    for i, c in enumerate(group):
        same &= quoted_name(c).eqNullSafe(F.col(f"group_{i}_"))
    placed = rows.join(first, same)
    return placed.select(*[quoted_name(c) for c in df.columns], (F.col("at_") + F.col("start_")).alias(name))
