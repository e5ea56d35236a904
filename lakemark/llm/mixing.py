"""Mixing sources to target weights, in DataFrame operations only.

Every source gets a target in words; its documents repeat at the rate
target / size: floor(rate) copies of each, and one more with the probability of
the fraction, drawn from a hash of the seed, the document's id and text, and its number among
rows that have both the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemark.llm.common import broadcast_if_small, packed, quoted, stored, unpacked
from lakemark.operators.places import with_places

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 7


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of ``seed`` and ``key``; 52 bits, exact in a double."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Targets of the rows (source, source_size), one row per source.

    Sources take the weights in turn, in code point order with null last. Together they get
    ``share`` of all sizes by weight, none more than ``cap`` times its size; what is
    above goes to the others by weight, until none is above.

    A target is min(cap x size, level x weight). In order of cap x size / weight a source is
    capped exactly if the level of what is left for it and all later ones is above that
    quotient, so one running sum finds the capped ones. The rows here are one per source:
    a catalogue, not the documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    rows = rows.withColumn("limit", F.lit(cap) * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(share) * F.sum("source_size").over(everything)
    left = total - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    capped = left * F.col("weight") > F.col("limit") * F.sum("weight").over(after)
    rows = rows.withColumn("total", total).withColumn("capped", capped)
    taken = F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    level = (F.col("total") - F.lit(cap) * taken) / F.nullif(open_weight, F.lit(0))
    target = F.when(F.col("capped"), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("weight") * level)
    )
    return rows.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def same_rows(docs: DataFrame, doc_id: str, text: str) -> Column:
    """What rows of one id and text share; a null text is an empty one."""
    return F.xxhash64(quoted(doc_id).isNull(), quoted(doc_id), F.coalesce(quoted(text), F.lit("")))


def with_numbers(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``number``, from 1 within the rows of one ``same``.

    Only hashes are shuffled to find the rows that are repeated; where there are none, none
    moves. Repeated rows are numbered by ``with_places``, which no large group holds up.
    """
    repeated = stored(keys.groupBy("same").agg(F.count("*").alias("n")).filter("n > 1").select("same"), "mix-repeats")
    if repeated.isEmpty():
        return rows.withColumn("number", F.lit(1).cast("long"))
    told = broadcast_if_small(repeated)
    single = rows.join(told, "same", "left_anti").withColumn("number", F.lit(1).cast("long"))
    several = rows.join(told, "same", "left_semi").withColumn("order_", F.xxhash64(F.monotonically_increasing_id()))
    placed = with_places(several, ["same"], ["order_"], "place_")
    return single.unionByName(placed.withColumn("number", F.col("place_") + 1).drop("order_", "place_"))


def planned(
    docs: DataFrame, doc_id: str, text: str, source: str, weights, share, cap, seed
) -> DataFrame:
    """Every document as ``row_`` with size, source_size, target, rate, copies and taken."""
    rows = packed(docs, key=quoted(doc_id), source=quoted(source), size=word_count(quoted(text)), same=same_rows(docs, doc_id, text))
    sizes = docs.select(quoted(source).alias("source"), word_count(quoted(text)).alias("size"))
    sizes = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, cap), "mix-targets")
    targets = broadcast_if_small(targets.withColumnRenamed("source", "of"))
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("of")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    rate = F.least(F.coalesce(rate, F.lit(0.0)), F.lit(cap))
    rows = rows.withColumn("rate", rate)
    rows = with_numbers(rows, docs.select(same_rows(docs, doc_id, text).alias("same")))
    digest = F.md5(F.coalesce(F.col("row_").getField(text), F.lit("")))
    drawn = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("null")), digest, F.col("number").cast("string"))
    extra = uniform(drawn, seed) < F.col("rate") - F.floor("rate")
    rows = rows.withColumn("copies", F.floor("rate") + extra.cast("long"))
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def mixing_plan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED,
) -> DataFrame:
    """One row per document: its id, size, source_size, target, rate, copies and taken words.

    A null text has size 0, null sources are one source, a null id draws like any id. Rows that
    repeat an id and a text draw each by its number among them, so a source of such rows
    comes near its target too. An empty table gives no rows. Sizes are summed before
    anything is joined, so a source with a third of all rows is one row; the documents are
    joined to the measured table of sources and do not move unless there are more sources
    than may be broadcast.
    """
    rows = planned(docs, doc_id, text, source, weights, share, cap, seed)
    names = ["size", "source_size", "target", "rate", "copies", "taken"]
    return rows.select(F.col("key").alias(doc_id), *names)


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED,
) -> DataFrame:
    """The mix itself: every document as often as ``mixing_plan`` says, with its own columns."""
    rows = planned(docs, doc_id, text, source, weights, share, cap, seed)
    rows = rows.filter(F.col("copies") > 0)
    repeated = rows.select("row_", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return unpacked(repeated, docs.columns)
