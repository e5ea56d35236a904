"""N-gram Jaccard join with Bayesian pruning of candidates.

Documents are sets of word n-grams. Candidates share a band of MinHash values. Their values
are compared a few at a time; a pair is dropped as soon as the posterior probability, after
m equal values of n, that its similarity reaches the threshold falls below a tolerance.
What is left is verified on the sets themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import broadcast_if_small, quoted, stored, text_slices, worker_state
from lakemark.llm.fingerprints import mixed
from lakemark.llm.pairing import (
    brought_together, dealt_to_cells, grouped, local_roots, pairs_in_cells, whole_cells,
)

WORDS = 5
THRESHOLD = 0.8
#: 32 bands of 4 values miss a pair at 0.8 once in 20 million times.
BANDS, ROWS = 32, 4
VALUES = 128
#: Values compared at a time, and the posterior probability below which a pair is dropped.
#: All steps together drop a pair at 0.8 about once in a million times (``pruned_share``).
STEP = 16
TOLERANCE = 1e-7
#: N-grams of the sets of a part, about: long texts make small parts.
PART_GRAMS = 2 << 20
#: Bytes of texts of whole cells that a task works on together, about.
CELL_BYTES = 32 << 20
REMEMBERED = 200_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    """64-bit hashes of words."""
    found = list(map(known.get, words))
    if None in found:
        if len(known) > REMEMBERED:
            known.clear()
        for i, h in enumerate(found):
            if h is None:
                h = xxhash.xxh3_64_intdigest(words[i])
                if len(words[i]) < 100:
                    known[words[i]] = h
                found[i] = h
    return np.array(found, dtype=np.uint64)


def shingle_sets(texts: list[str | None], n: int, known: dict[str, int]) -> list[np.ndarray]:
    """Sorted different hashes of the n-grams of the words, in lower case, between blanks.

    A text of fewer words has one n-gram of all of them; one without words has none.
    """
    out = []
    for text in texts:
        part = word_hashes((text or "").lower().split(), known)
        width = min(n, len(part))
        if not width:
            out.append(part)
            continue
        with np.errstate(over="ignore"):
            grams = np.zeros(len(part) - width + 1, dtype=np.uint64)
            for k in range(width):
                grams = grams * MULTIPLIER + part[k : len(part) - width + 1 + k]
        out.append(np.unique(mixed(grams + np.uint64(width))))
    return out


def minhashes(sets: list[np.ndarray], values: int = VALUES) -> np.ndarray:
    """A row of 16-bit MinHash values for each set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    flat = (flat >> np.uint64(16)).astype(np.uint32)
    seeds = mixed(np.arange(1, 2 * values + 1, dtype=np.uint64)).astype(np.uint32)
    out = np.empty((len(sets), values), dtype=np.uint16)
    with np.errstate(over="ignore"):
        for k in range(values):
            least = np.minimum.reduceat(flat * (seeds[2 * k] | np.uint32(1)) + seeds[2 * k + 1], starts)
            # The least 32-bit value is scrambled before it is cut to 16 bits.
            out[:, k] = (least * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return out


def least_matches(threshold: float, values: int = VALUES, step: int = STEP, tolerance: float = TOLERANCE) -> list[int]:
    """After step, 2 step, ... values: the least number of equal ones that keeps a pair.

    With a uniform prior the similarity given m equal of n has a Beta(m + 1, n - m + 1)
    distribution; it reaches t with the probability that Binomial(n + 1, t) is at most m.
    """
    out = []
    for n in range(step, values + 1, step):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                out.append(m)
                break
    return out


def pruned_share(similarity: float, threshold: float = THRESHOLD, values: int = VALUES, step: int = STEP, tolerance: float = TOLERANCE) -> float:
    """The probability that the comparison drops a pair of this similarity, worked out step by step."""
    alive = [1.0]
    for least in least_matches(threshold, values, step, tolerance):
        after = [0.0] * (len(alive) + step)
        for m, share in enumerate(alive):
            for more in range(step + 1):
                after[m + more] += share * math.comb(step, more) * similarity**more * (1 - similarity) ** (step - more)
        alive = [share if m >= least else 0.0 for m, share in enumerate(after)]
    return 1 - math.fsum(alive)


def surviving(
    i: np.ndarray, j: np.ndarray, values: np.ndarray, sizes: np.ndarray, threshold: float, keep: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that neither their set sizes nor the posterior probability rule out."""
    fit = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
    i, j = i[fit], j[fit]
    equal = np.zeros(len(i), dtype=np.int64)
    for k, least in enumerate(keep):
        part = slice(k * STEP, (k + 1) * STEP)
        equal += (values[i, part] == values[j, part]).sum(axis=1)
        fit = equal >= least
        i, j, equal = i[fit], j[fit], equal[fit]
    return i, j


def reach(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches the threshold."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= threshold * (len(a) + len(b) - common) - 1e-9


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) of sets reach the threshold, exactly.

    Many pairs of few sets are counted by a matrix product over blocks of elements.
    """
    if len(i) < 4 * len(sets):
        return np.array([reach(sets[a], sets[b], threshold) for a, b in zip(i.tolist(), j.tolist())], dtype=bool)
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    elements, code = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, len(elements), 4096):
        a, b = np.searchsorted(code, [start, start + 4096])
        block = np.zeros((len(sets), min(4096, len(elements) - start)), dtype=np.float32)
        block[owner[a:b], code[a:b] - start] = 1
        common += block @ block.T
    both = common[i, j].astype(np.int64)
    return both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9


def sketches(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(id, key, node, size, values) per row: SHA-256 of the text, digest of the set, its size
    and its MinHash values; node, size and values are null for a text without words."""
    key = F.sha2(F.coalesce(quoted(text), F.lit("")), 256)
    rows = docs.select(quoted(doc_id).alias("id"), key.alias("key"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_state("words of n-grams", dict)
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), n, known)
            full = [s for s in sets if len(s)]
            values = iter(minhashes(full) if full else [])
            nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.record_batch(
                [
                    batch.column("id"), batch.column("key"), pa.array(nodes, pa.binary()),
                    pa.array([len(s) or None for s in sets], pa.int64()),
                    pa.array([next(values).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["id", "key", "node", "size", "values"],
            )

    made = "node BINARY, size BIGINT, values BINARY"
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], *T.StructType.fromDDL(made).fields]))


def candidate_rows(nodes: DataFrame, threshold: float, bands: int, band_rows: int) -> DataFrame:
    """(cell, node, place, partners): nodes of cells in which pairs survive the comparison.

    ``partners`` are places within the cell. A pair that shares several bands is taken in
    the first of them only.
    """
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.xxhash64(b, F.substring("values", b * (2 * band_rows) + 1, F.lit(2 * band_rows))),
    )
    rows = nodes.select("node", "size", F.posexplode(keys).alias("band", "band_key"))
    rows = dealt_to_cells(rows, ["band", "band_key"], "node", weight="size", part_weight=PART_GRAMS)
    rows = rows.join(nodes.select("node", "size", "values"), "node")
    cell = ["band", "band_key", "low", "high"]
    rows = brought_together(rows.select(*cell, "part", "node", "size", "values"), cell)
    keep = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in whole_cells(batches, 4):
            values = np.frombuffer(b"".join(table.column("values").to_pylist()), dtype=np.uint16).reshape(table.num_rows, -1)
            sizes, part = table.column("size").to_numpy(), table.column("part").to_numpy()
            band, low, high = (table.column(c).to_numpy() for c in ("band", "low", "high"))
            keys = values[:, : bands * band_rows].reshape(len(values), bands, band_rows)
            found = []
            for i, j in pairs_in_cells(number, low != high, part):
                i, j = surviving(i, j, values, sizes, threshold, keep)
                shared = (keys[i] == keys[j]).all(axis=2)
                first = shared.argmax(axis=1) == band[i]
                found.append((i[first], j[first]))
            i = np.concatenate([a for a, _ in found]) if found else np.array([], int)
            if not len(i):
                continue
            j = np.concatenate([b for _, b in found])
            starts = np.searchsorted(number, number)
            order = np.lexsort((j, i))
            i, j = i[order], j[order]
            kept = np.unique(np.concatenate([i, j]))
            ends = np.concatenate([[0], np.searchsorted(i, kept, "right")])
            partners = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(j - starts[j], pa.int32()))
            taken = table.take(pa.array(kept))
            out = [taken.column(c).combine_chunks() for c in (*cell, "node")]
            yield pa.record_batch([*out, pa.array(kept - starts[kept], pa.int32()), partners], [*cell, "node", "place", "partners"])

    return rows.mapInArrow(run, "band INT, band_key BIGINT, low INT, high INT, node BINARY, place INT, partners ARRAY<INT>")


def similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD,
    bands: int = BANDS, band_rows: int = ROWS,
) -> DataFrame:
    """(id, key, class_id, class_key, n_links), one row per row of ``docs``.

    Two rows are linked if the Jaccard similarity of their sets of n-grams reaches
    ``threshold``; rows of one set are copies and always linked. ``n_links`` counts the
    other rows linked directly. A class is what links connect, named by its least (id, key),
    where ``key`` is the SHA-256 of the text; null ids come first. Texts without words,
    null ones too, are classes of their own, each row with its id.

    Texts are read twice and moved only if they have a partner left to verify; copies are one
    node throughout.
    """
    rows = stored(sketches(docs, doc_id, text, n), "sketches")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "key")).alias("first"), F.first("size").alias("size"), F.first("values").alias("values")
    )
    nodes = stored(nodes, "sets")
    candidates = stored(candidate_rows(nodes, threshold, bands, band_rows), "candidates")
    needed = candidates.select("node").distinct().join(nodes.select("node", "copies", "first"), "node")
    needed = stored(needed.select("node", "copies", F.col("first.id").alias("of"), F.col("first.key").alias("of_key")), "needed")
    key = F.sha2(F.coalesce(quoted(text), F.lit("")), 256)
    source = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("of_key"))
    # Rows that repeat an id and a text bring the same text; one is enough.
    texts = source.join(broadcast_if_small(needed), same).groupBy("node").agg(F.first("copies").alias("copies"), F.first("text").alias("text"))
    texts = stored(texts, "texts")
    cell = ["band", "band_key", "low", "high"]
    found = brought_together(candidates.join(texts, "node").select(*cell, "node", "place", "partners", "copies", "text"), [*cell])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_state("words of n-grams", dict)
        for table, number in whole_cells(batches, 4, rows=1024, size=CELL_BYTES):
            starts = np.searchsorted(number, np.arange(number[-1] + 1))
            ends = np.append(starts[1:], len(number))
            place, partners = table.column("place").to_numpy(), table.column("partners").to_pylist()
            copies, nodes_of = table.column("copies").to_numpy(), table.column("node").to_pylist()
            texts_of = table.column("text")
            linked, root = np.zeros(len(number), dtype=np.int64), np.arange(len(number))
            for a, b in zip(starts.tolist(), ends.tolist()):
                at = {p: k for k, p in enumerate(place[a:b].tolist())}
                sets = shingle_sets(texts_of.slice(a, b - a).to_pylist(), n, known)
                i = np.array([k for k in range(b - a) for _ in partners[a + k]], dtype=np.int64)
                j = np.array([at[p] for k in range(b - a) for p in partners[a + k]], dtype=np.int64)
                real = verified(sets, i, j, threshold)
                i, j = i[real], j[real]
                np.add.at(linked, a + i, copies[a + j])
                np.add.at(linked, a + j, copies[a + i])
                root[a:b] = a + local_roots(b - a, i, j)
            hit = np.flatnonzero(linked)
            yield pa.record_batch(
                [
                    pa.array([nodes_of[k] for k in hit.tolist()], pa.binary()), pa.array([nodes_of[k] for k in root[hit].tolist()], pa.binary()),
                    pa.array(linked[hit], pa.int64()),
                ],
                ["node", "root", "linked"],
            )

    found = found.mapInArrow(run, "node BINARY, root BINARY, linked BIGINT")
    done = grouped(rows.select("id", "key", "node"), found, F.struct("id", "key"))
    return done.select(
        "id", "key", F.col("first_.id").alias("class_id"), F.col("first_.key").alias("class_key"), F.col("links_").alias("n_links")
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that name their class: one of each class of ``similar``.

    Rows without words are all kept. Of rows that repeat id and text one stays. The rows to
    drop are looked up, as they are fewer than those to keep.
    """
    rows = similar(docs, doc_id, text, **settings)
    rows = stored(rows.withColumn("first", F.col("id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))), "classes")
    dropped = rows.filter("NOT first").select(F.col("id").alias("of"), F.col("key").alias("of_key")).distinct()
    repeated = rows.filter("first").groupBy(F.col("id").alias("of"), F.col("key").alias("of_key")).count().filter("count > 1")
    repeated = stored(repeated.select("of", "of_key"), "repeated")
    key = F.sha2(F.coalesce(quoted(text), F.lit("")), 256)
    kept = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row_"), quoted(doc_id).alias("id"), key.alias("key"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    kept = kept.join(broadcast_if_small(stored(dropped, "dropped")), same, "left_anti")
    if not repeated.isEmpty():
        repeated = broadcast_if_small(repeated)
        again = kept.join(repeated, same, "left_semi").groupBy("id", "key").agg(F.min("row_").alias("row_"))
        kept = kept.join(repeated, same, "left_anti").select("row_").unionByName(again.select("row_"))
    return kept.select(*[F.col("row_").getField(c).alias(c) for c in docs.columns])
