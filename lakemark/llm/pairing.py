"""Pairs of alike items: bounded cells of candidates, and the groups that links make.

An item that occurs often is one node with its number of copies. Nodes that share a key are
candidates. However many share it, they are dealt over cells of bounded size, one for each pair
of parts of the key's nodes, so no task holds a whole key. A cell returns a row per
node, never a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemark.llm.common import broadcast_if_small, stored, text_slices

#: Nodes of one key that a part has, about; a cell holds one or two parts.
PART_NODES = 256
#: Rows of whole cells that a task works on together, about.
CHUNK_ROWS = 8_192
#: Pairs that are compared together.
PAIR_BATCH = 1 << 15
MOST_ROUNDS = 60


def dealt_to_cells(
    members: DataFrame, key: list[str], node: str, part_nodes: int = PART_NODES, anchor: str = "true",
    weight: str | None = None, part_weight: int = 1,
) -> DataFrame:
    """``members`` of keys with two rows or more, with their cell ``low``, ``high`` and ``part``.

    A key with n rows has g = ceil(n / part_nodes) parts; a row goes to part hash(node) mod g
    and so to the g cells of that part with every part. Pairs within a part meet in the cell
    (p, p) alone, other pairs in one cell (low, high). Keys are counted before they are
    joined, and both sides of that join are plain shuffled rows, so a hot key is split.
    Keys without a row for which ``anchor`` holds are left out. With a column ``weight``, which the
    result lacks, a part has a weight of about ``part_weight`` at most, or one row.
    """
    parts = F.ceil(F.count("*") / part_nodes)
    if weight:
        parts = F.least(F.greatest(parts, F.ceil(F.sum(weight) / part_weight)), F.count("*"))
    counts = members.groupBy(*key).agg(
        F.count("*").alias("rows_"), parts.cast("int").alias("parts"), F.bool_or(F.expr(anchor)).alias("anchored_")
    )
    counts = counts.filter("rows_ > 1 AND anchored_").drop("rows_", "anchored_")
    counts = broadcast_if_small(stored(counts, "key-counts"))
    rows = (members.drop(weight) if weight else members).join(counts, key)
    rows = rows.withColumn("part", F.pmod(F.xxhash64(node), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    return rows.drop("parts", "other")


def brought_together(rows: DataFrame, cell: list[str]) -> DataFrame:
    """The rows of each cell one after another in one partition."""
    return rows.repartition(*cell).sortWithinPartitions(*cell)


def whole_cells(
    batches: Iterator[pa.RecordBatch], width: int, rows: int = CHUNK_ROWS, size: int | None = None
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, the first ``width`` columns being the cell, and the number of
    the cell of each row. Cells are bounded, so what is held over is. With ``size``, a table has
    about that many bytes in its last column, a text, or one cell."""
    held: list[pa.Table] = []

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        for c in range(width):
            values = table.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.cumsum(new)

    def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, rows):
            yield from text_slices([batch.slice(start, rows)], limit=size) if size else [batch.slice(start, rows)]

    def heavy() -> int:
        return sum(pc.sum(pc.binary_length(t.column(t.num_columns - 1))).as_py() or 0 for t in held) if size else 0

    for batch in batches:
        for piece in sliced(batch):
            held.append(pa.Table.from_batches([piece]))
            if sum(t.num_rows for t in held) < rows and (not size or heavy() < size):
                continue
            table = pa.concat_tables(held).combine_chunks()
            number = numbered(table)
            last = int(np.searchsorted(number, number[-1]))
            if last:
                yield table.slice(0, last).combine_chunks(), number[:last]
            held = [table.slice(last)]
    if held and sum(t.num_rows for t in held):
        table = pa.concat_tables(held).combine_chunks()
        yield table, numbered(table)


def pairs_in_cells(number: np.ndarray, cross: np.ndarray, part: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of the pairs of each cell; in a ``cross`` cell only across parts."""
    held, size = [], 0
    for step in range(1, len(number)):
        same = np.flatnonzero(number[step:] == number[:-step])
        if not len(same):
            break
        wanted = same[~cross[same] | (part[same] != part[same + step])]
        held.append((wanted, wanted + step))
        size += len(wanted)
        if size >= PAIR_BATCH:
            yield np.concatenate([i for i, _ in held]), np.concatenate([j for _, j in held])
            held, size = [], 0
    if size:
        yield np.concatenate([i for i, _ in held]), np.concatenate([j for _, j in held])


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least place reachable by the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            return root


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the nodes of the edges (a, b), and the least node connected to each.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its
    least neighbour, then its smaller neighbours are. Each step is a minimum per node
    and a join back; both are stored rows, so a node with very many neighbours is split.
    """
    now = edges.filter("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = stored(now, "edges")

    def stamp(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    seen = stamp(now)
    for _ in range(MOST_ROUNDS):
        if not seen[0]:
            break
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large, "edges")
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("hi", "m"), F.struct(F.col("lo").alias("hi"), "m"))).alias("e"))
        small = small.select(F.col("e.hi").alias("hi"), F.col("e.m").alias("lo")).filter("hi != lo").distinct()
        now = stored(small, "edges")
        last, seen = seen, stamp(now)
        if seen == last:
            break
    else:
        raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def grouped(rows: DataFrame, found: DataFrame, rank: Column) -> DataFrame:
    """``rows``, a stored table with ``node``, and what their links say of each.

    ``found`` has, once or more per node, ``node``, ``root`` (a node it is connected to) and
    ``linked``, the number of items at other nodes it is linked to. Adds ``first_``, the
    least ``rank`` of all rows connected, and ``links_``, the number of other rows linked
    directly, copies included. Rows without a node are linked with nothing.
    """
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min(rank).alias("first_"))
    nodes = stored(nodes.filter("node IS NOT NULL"), "nodes")
    found = stored(found, "links")
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    tied = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "components")
    firsts = tied.join(nodes, "node").groupBy("root").agg(F.min("first_").alias("least_"))
    firsts = stored(firsts, "firsts")
    told = tied.join(firsts, "root").select("node", "least_")
    told = nodes.join(told, "node", "left").join(linked, "node", "left")
    told = told.select(
        "node", F.coalesce("least_", "first_").alias("first_"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("links_"),
    )
    told = broadcast_if_small(stored(told, "told"))
    alone = rows.filter("node IS NULL").select("*", rank.alias("first_"), F.lit(0).cast("long").alias("links_"))
    return rows.filter("node IS NOT NULL").join(told, "node").select(*rows.columns, "first_", "links_").unionByName(alone)
