"""Counts of events, and the keys that share a count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemark.constants import CLAIMANT_FIELD
from lakemark.functions.events import is_claimed, quoted_name
from lakemark.operators.places import with_places


def count_by(events: DataFrame, key: str) -> DataFrame:
    """Events per value of ``key``, as ``(key, n BIGINT)``; null is a value.

    Partial counts are made before the shuffle, so a hot key moves one row per
    task.
    """
    return events.groupBy(quoted_name(key).alias(key)).agg(F.count("*").alias("n"))


def count_claimed(
    events: DataFrame, claimant: str = CLAIMANT_FIELD, keep_unclaimed: bool = True
) -> DataFrame:
    """Events per claiming group, as ``(claimant, n BIGINT)``.

    All unclaimed events share one row with an empty name and the count 0; the
    row is there only if such an event is.
    """
    name = quoted_name(claimant)
    claimed = is_claimed(name)
    if not keep_unclaimed:
        return count_by(events.filter(claimed), claimant)
    return events.groupBy(F.when(claimed, name).otherwise("").alias(claimant)).agg(
        F.sum(F.when(claimed, 1).otherwise(0)).cast("bigint").alias("n")
    )


def part_number(text: Column, parts: Column) -> Column:
    """Part in ``[0, parts)`` that a text belongs to, the same on every run."""
    digest = F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 8), 16, 10)
    return F.pmod(digest.cast("bigint"), parts)


def keys_by_count(
    counts: DataFrame, key: str, parts: int | None = 1, part_size: int | None = None
) -> DataFrame:
    """Keys that share a count, in the layout that the caller picks.

    ``parts=None``: rows ``(n, key)``, one per key, which no amount of data makes long.
    ``parts=1``: one list for each count, ``(n, keys ARRAY)``; a list is as long as the
    number of keys that share the count, so this is for keys that are few.
    ``parts=P``: every count as P lists, ``(n, part, keys)``, by a hash of the key; lists
    without keys are left out. ``part_size=S``: lists of S keys each, the last of a count
    shorter, in the order of the keys over all lists of the count; none is ever longer. All
    lists of a count together hold all its keys, sorted within a list; a null key is kept.
    """
    item = quoted_name(key)
    if parts is None and part_size is None:
        return counts.select("n", item.alias("key"))
    rows = counts.select("n", item.alias("key"))
    # Collected as structs: collecting a bare column would lose the null key.
    keys = F.transform(F.array_sort(F.collect_list(F.struct("key"))), lambda s: s.key).alias("keys")
    if part_size is not None:
        part = F.expr(f"place_ div {int(part_size)}")
        rows = with_places(rows, ["n"], ["key"], "place_")
    elif parts == 1:
        return rows.groupBy("n").agg(keys)
    else:
        part = part_number(F.col("key").cast("string"), F.lit(parts))
    return rows.select("n", part.alias("part"), "key").groupBy("n", "part").agg(keys)
