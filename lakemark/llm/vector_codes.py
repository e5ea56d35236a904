"""Short codes of vectors by product quantisation with equal-average search.

Components are scaled to integers and vectors cut into equal parts; each part has a codebook,
refined in rounds of assignment and averaging. A part finds its nearest entry among the entries
sorted by component sum: it starts at its own sum and goes outward on both sides. The squared gap
of the sums over the dimension never exceeds the squared distance, so a side whose gap does is
done, and the entry is the one that a search of the whole codebook finds.

A round is one scan: tasks send a sum for each entry and position, Spark adds them up, and only
the codebooks, whose size is fixed by the parameters, are known to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import broadcast_if_small, packed, quoted, stored, unpacked

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Part vectors searched together.
SLICE = 8192


class Codebooks(NamedTuple):
    """``entries[part, entry]`` are integers; vectors are filled up with zeros to ``width``."""

    entries: np.ndarray
    width: int
    scale: int

    @property
    def sha256(self) -> str:
        """Digest of all components by part, entry and position, as decimals between commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """True for a vector without null and non-finite components; never null."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def scaled(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale x component), shorter vectors filled up with zeros."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = np.floor(scale * flat).astype(np.int64)
    return out


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point the entry with the least squared distance, ties to the lower index, and that
    distance; rows of integers."""
    count, dim = entries.shape
    order = np.argsort(entries.sum(axis=1), kind="stable")
    by_sum = entries[order]
    far = np.iinfo(np.int64).max
    # Beyond both ends a sum that is further away than any.
    sums = np.concatenate([[-far // 4], by_sum.sum(axis=1), [far // 4]])
    index, best = np.zeros(len(points), dtype=np.int64), np.zeros(len(points), dtype=np.int64)
    for at in range(0, len(points), SLICE):
        part = points[at : at + SLICE]
        own = part.sum(axis=1)
        right = np.searchsorted(sums, own)
        left = right - 1
        found, least = np.full(len(part), count), np.full(len(part), far)
        live = np.arange(len(part))
        while len(live):
            down, up = own[live] - sums[left[live]], sums[right[live]] - own[live]
            lower = down <= up
            gap = np.minimum(down, up)
            # gap^2 / dim > least ends the search; there is nothing beyond the ends.
            close = (gap < far // 8) & ((least[live] == far) | (gap * gap <= dim * least[live]))
            live, lower = live[close], lower[close]
            if not len(live):
                break
            place = np.where(lower, left[live], right[live])
            step = part[live] - by_sum[place - 1]
            distance = np.einsum("ij,ij->i", step, step)
            entry = order[place - 1]
            better = (distance < least[live]) | ((distance == least[live]) & (entry < found[live]))
            least[live[better]], found[live[better]] = distance[better], entry[better]
            left[live[lower]] -= 1
            right[live[~lower]] += 1
        index[at : at + SLICE], best[at : at + SLICE] = found, least
    return index, best


def parts_of(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    """The vectors cut into equal consecutive parts."""
    return np.split(vectors, parts, axis=1)


def entry_sums(vectors: np.ndarray, codebooks: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By part: the used slots (part x entries + entry), how many vectors each has, and their sums."""
    parts, entries = codebooks.entries.shape[:2]
    for p, points in enumerate(parts_of(vectors, parts)):
        index, _ = nearest(points, codebooks.entries[p])
        order = np.argsort(index, kind="stable")
        used, starts, times = np.unique(index[order], return_index=True, return_counts=True)
        yield p * entries + used, times, np.add.reduceat(points[order], starts, axis=0)


def fit_codebooks(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks:
    """Codebooks of all vectors of ``df`` that are ``usable``; others are left out.

    The first entries are the parts of the vectors with the ``entries`` smallest ids, ascending
    (null ids last, rows of one id by their vectors; fewer rows give fewer entries, an empty
    table none). A round assigns every part to its nearest entry and replaces each entry by
    floor(sum / count) of its parts; an entry without parts stays. Vectors of different lengths
    are filled up with zeros to the longest, and that to a multiple of ``parts``. Equal rows
    count as often as they occur. Components beyond 2^30 / width after scaling would
    not leave room for exact distances and raise a ValueError before anything else is done.
    """
    rows = df.select(quoted(vec_id).alias("id"), quoted(vector).alias("vector")).filter(usable(F.col("vector")))
    size = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    longest, largest = rows.agg(F.max(F.size("vector")), F.max(size)).first()
    width = -(-(longest or 0) // parts) * parts
    if (largest or 0) * scale + 1 > (1 << 30) // max(width, 1):
        raise ValueError(f"components up to {largest} are too large for exact distances of {width} components")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    start = scaled(first.column("vector").combine_chunks(), width, scale)
    books = np.stack([np.ascontiguousarray(p) for p in parts_of(start, parts)])
    if not len(start):
        return Codebooks(books, width, scale)
    vectors = rows.select("vector")
    for _ in range(rounds):
        current = Codebooks(books, width, scale)

        def sums(batches: Iterator[pa.RecordBatch], known: Codebooks = current) -> Iterator[pa.RecordBatch]:
            slots, dim = known.entries.shape[0] * known.entries.shape[1], known.entries.shape[2]
            count, total = np.zeros(slots, dtype=np.int64), np.zeros((slots, dim), dtype=np.int64)
            for batch in batches:
                for slot, times, added in entry_sums(scaled(batch.column(0), known.width, known.scale), known):
                    count[slot] += times
                    total[slot] += added
            used = np.flatnonzero(count)
            values = pa.array(total[used].tolist(), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(used, pa.int32()), pa.array(count[used], pa.int64()), values], ["slot", "n", "total"])

        sent = vectors.mapInArrow(sums, "slot INT, n BIGINT, total ARRAY<BIGINT>")
        sent = sent.select("slot", "n", F.posexplode("total").alias("place", "total"))
        # One row for each component of the codebooks, however many vectors there are.
        got = sent.groupBy("slot", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
        slot, place, n, total = (got.column(c).to_numpy() for c in ("slot", "place", "n", "total"))
        books = books.copy()
        books.reshape(-1, books.shape[2])[slot, place] = total // n
    return Codebooks(books, width, scale)


def encode_vectors(
    df: DataFrame, codebooks: Codebooks, vector: str = "embedding", code: str = "code", error: str = "error"
) -> DataFrame:
    """The rows of ``df`` with a ``usable`` vector, their columns, and behind them the ``code`` (a
    byte an entry, in part order) and the ``error`` (squared distance over all parts, in scaled
    units). Columns of these names are replaced. Rows stay in their partitions."""
    rows = packed(df.filter(usable(quoted(vector))), vector=quoted(vector))
    if codebooks.entries.shape[1] > 256:
        raise ValueError("a code has a byte for each part: at most 256 entries")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = scaled(batch.column(1), codebooks.width, codebooks.scale)
            found = [nearest(p, book) for p, book in zip(parts_of(points, len(codebooks.entries)), codebooks.entries)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            yield pa.record_batch(
                [batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(sum(d for _, d in found), pa.int64())],
                ["row_", "code", "error"],
            )

    made = T.StructType([rows.schema["row_"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    return unpacked(rows.mapInArrow(coded, made), df.columns, **{code: F.col("code"), error: F.col("error")})


def decode_vectors(df: DataFrame, codebooks: Codebooks, code: str = "code", vector: str = "vector") -> DataFrame:
    """``df`` with the vector that each code stands for, scaled back; null for a null code."""
    rows = packed(df, code=quoted(code))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                None if c is None else (codebooks.entries[np.arange(len(c)), list(c)].ravel() / codebooks.scale).tolist()
                for c in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(made, pa.list_(pa.float64()))], ["row_", "vector"])

    schema = T.StructType([rows.schema["row_"], T.StructField("vector", T.ArrayType(T.DoubleType()))])
    return unpacked(rows.mapInArrow(decoded, schema), df.columns, **{vector: F.col("vector")})


def with_label_errors(coded: DataFrame, label: str = "label", error: str = "error", name: str = "label_error") -> DataFrame:
    """``coded`` with the sum of the errors of each row's label, nulls together.

    The rows are stored, as both the sums and the join read them. A label is one row of sums, so
    a hot one moves a row per task; the sums are broadcast if measured small.
    """
    rows = stored(coded, "vector-codes")
    sums = rows.groupBy(quoted(label).alias("of_")).agg(F.sum(quoted(error)).alias("sum_"))
    sums = broadcast_if_small(stored(sums, "label-errors"))
    joined = packed(rows, of=quoted(label)).join(sums, F.col("of").eqNullSafe(F.col("of_")))
    return unpacked(joined, rows.columns, **{name: F.col("sum_")})
