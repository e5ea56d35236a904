"""Embedding near-duplicates by cross-polytope hashing.

A vector is turned by sign flips and fast Hadamard transforms; the largest coordinate and its
sign are its hash. Several such hashes make a bucket of a table. Each vector also goes to the
buckets that it nearly fell into (multiprobe), and pairs of a bucket are verified by their
cosine in double precision. Codes say in which bucket a pair meets first, and components in a byte
each that a pair cannot reach the threshold; vectors go only to the buckets where a pair is left.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import quoted, stored
from lakemark.llm.pairing import (
    brought_together, dealt_to_cells, grouped, local_roots, pairs_in_cells, whole_cells,
)

THRESHOLD = 0.95
PROBES = 3
#: Rows in a bucket of a table, about, from which a further hash is added.
BUCKET_ROWS = 2
#: Share of the pairs at the threshold that no table may bring together, and the simulated
#: pairs by which the number of tables is chosen.
MISSED = 1e-5
SIMULATED = 2_000
#: Vectors are filled up with zeros to this width at least: the sign flips of a narrower
#: transform are too few to turn every pair in independent ways.
LEAST_WIDTH = 64
SEED = 5
SLICE_ROWS = 2_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix, by butterflies; the width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, width)
        half *= 2
    return x


def width_for(dims: int) -> int:
    """The power of two to which vectors are filled up."""
    return max(LEAST_WIDTH, 1 << (dims - 1).bit_length())


def bucket_codes(vectors: np.ndarray, tables: int, hashes: int, probes: int, seed: int = SEED) -> np.ndarray:
    """Codes of shape (rows, tables, 1 + probes): of the own bucket, then of the next ones.

    The cost of another coordinate in one hash is what it is smaller by, squared; the cheapest
    single changes and pairs of them give the probes, each a bucket of its own.
    """
    rows, dims = vectors.shape
    width = width_for(dims)
    padded = np.zeros((rows, width))
    padded[:, :dims] = vectors
    source = np.random.default_rng([seed, width])
    out = np.empty((rows, tables, 1 + probes), dtype=np.int64)
    depth = min(width, 1 + probes)
    for t in range(tables):
        best = np.empty((rows, hashes, depth), dtype=np.int64)
        loss = np.empty((rows, hashes, depth))
        for k in range(hashes):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * source.choice([-1.0, 1.0], width)) / math.sqrt(width)
            size = np.abs(turned)
            top = np.argsort(-size, axis=1, kind="stable")[:, :depth]
            value = np.take_along_axis(turned, top, axis=1)
            best[:, k] = 2 * top + (value < 0)
            loss[:, k] = (np.abs(value[:, :1]) - np.abs(value)) ** 2
        choices = [(0,) * hashes]
        choices += [tuple(d if i == k else 0 for i in range(hashes)) for k in range(hashes) for d in range(1, depth)]
        if depth > 1:
            both = [(a, b) for a in range(hashes) for b in range(a + 1, hashes)]
            choices += [tuple(int(i in pair) for i in range(hashes)) for pair in both]
        cost = np.stack([sum(loss[:, k, d] for k, d in enumerate(c)) for c in choices], axis=1)
        scale = (2 * width) ** np.arange(hashes)
        code = np.stack([sum(best[:, k, d] * scale[k] for k, d in enumerate(c)) for c in choices], axis=1)
        cost[:, 0] = -1
        order = np.argsort(cost, axis=1, kind="stable")[:, : 1 + probes]
        found = np.take_along_axis(code, order, axis=1)
        out[:, t, : found.shape[1]] = found
        out[:, t, found.shape[1] :] = -1  # fewer choices than probes
    return out


def tables_for(threshold: float, dims: int, hashes: int, probes: int, missed: float = MISSED) -> int:
    """Tables after which a pair at the threshold is missed with probability ``missed``."""
    if dims < 2:
        return 1
    source = np.random.default_rng([SEED, dims])
    x, z = source.normal(size=(2, SIMULATED, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * z
    a, b = (bucket_codes(v, 2, hashes, probes) for v in (x, y))
    met = (b == a[:, :, :1]).any(axis=2) | (a == b[:, :, :1]).any(axis=2)
    # The lower end of what the simulation leaves open.
    share = min(met.mean() - 2 * math.sqrt(0.25 / met.size), 1 - missed)
    return max(1, math.ceil(math.log(missed) / math.log(1 - max(share, 0.01))))


def narrow_codes(codes: np.ndarray, most: int) -> list[bytes]:
    """The codes of each row, below ``most`` or -1, in as many whole bytes a code as that takes; see
    ``wide_codes``."""
    size = most.bit_length() // 8 + 1  # a bit is left for the sign
    flat = np.ascontiguousarray(codes.reshape(len(codes), -1)).astype("<i8").view(np.uint8)
    flat = flat.reshape(len(codes), -1, 8)[:, :, :size]
    return [row.tobytes() for row in flat]


def wide_codes(rows: list[bytes], tables: int, probes: int) -> np.ndarray:
    """Codes of shape (rows, tables, 1 + probes) from ``narrow_codes``; a -1 is negative again.

    Rows of vectors of different length may have codes of different size.
    """
    codes = np.empty((len(rows), tables, 1 + probes), dtype=np.int64)
    for size in {len(x) for x in rows}:
        at = [k for k, x in enumerate(rows) if len(x) == size]
        flat = np.frombuffer(b"".join(rows[k] for k in at), dtype=np.uint8).reshape(len(at) * tables * (1 + probes), -1)
        # All bytes of -1 are 255, and no code below the limit has a highest bit.
        whole = np.where(flat[:, -1:] > 127, 255, 0).astype(np.uint8).repeat(8, axis=1)
        whole[:, : flat.shape[1]] = flat
        codes[at] = whole.view("<i8").reshape(len(at), tables, 1 + probes)
    return codes


def in_bytes(units: np.ndarray) -> list[bytes]:
    """For each unit vector the step of its components, the length of what rounding to whole steps
    leaves, and the steps, in a byte each."""
    step = np.abs(units).max(axis=1) / 127
    steps = np.rint(units / step[:, None])
    rest = np.sqrt(((units - steps * step[:, None]) ** 2).sum(axis=1))
    return [a.tobytes() + b.tobytes() for a, b in zip(np.stack([step, rest], axis=1), steps.astype(np.int8))]


def may_reach(rows: list[bytes], threshold: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Which pairs (i, j) of the rows of ``in_bytes`` may have a cosine of ``threshold``: none that
    has is left out.

    With unit vectors x = a + d and y = b + e, a and b being their steps, x y = a b + a e + d y, so it
    is a b + |e| (1 + |d|) + |d| at most.
    """
    told = np.frombuffer(b"".join(x[:16] for x in rows)).reshape(len(rows), 2)
    steps = np.zeros((len(rows), max(len(x) for x in rows) - 16), dtype=np.int8)
    for k, x in enumerate(rows):
        steps[k, : len(x) - 16] = np.frombuffer(x, dtype=np.int8, offset=16)

    def decide(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        near = np.empty(len(i), dtype=bool)
        for s in range(0, len(i), 8192):
            a, b = i[s : s + 8192], j[s : s + 8192]
            product = np.einsum("ij,ij->i", steps[a].astype(np.float64), steps[b].astype(np.float64))
            most = product * told[a, 0] * told[b, 0] + told[b, 1] * (1 + told[a, 1]) + told[a, 1]
            near[s : s + 8192] = most >= threshold - 1e-9
        return near

    return decide


def meet_first(codes: np.ndarray, tab: np.ndarray, code: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) meet in the bucket ``code[i]`` of table ``tab[i]`` and in none before.

    The buckets of a table in which a pair meets are the own one of either, if the other has it.
    """
    mine, theirs = codes[i, :, 0], codes[j, :, 0]
    meets_mine = (codes[j] == mine[:, :, None]).any(axis=2)
    meets_theirs = (codes[i] == theirs[:, :, None]).any(axis=2)
    first = (meets_mine | meets_theirs).argmax(axis=1)
    at = np.arange(len(i))
    least = np.where(meets_mine[at, first], mine[at, first], np.iinfo(np.int64).max)
    least = np.minimum(least, np.where(meets_theirs[at, first], theirs[at, first], np.iinfo(np.int64).max))
    return (first == tab[i]) & (least == code[i])


def unit_rows(vectors: list[list[float] | None]) -> dict[int, tuple[list[int], np.ndarray]]:
    """Places and unit vectors of the usable vectors, by dimension."""
    by: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for i, v in enumerate(vectors):
        if v is None or not len(v):
            continue
        x = np.array([math.nan if c is None else c for c in v], dtype=np.float64)
        if not np.isfinite(x).all():
            continue
        largest = np.abs(x).max()
        if largest == 0:
            continue
        x = x / largest  # else very large or small ones overflow
        places, rows = by.setdefault(len(x), ([], []))
        places.append(i)
        rows.append(x / math.sqrt(float(x @ x)))
    return {d: (places, np.stack(rows)) for d, (places, rows) in by.items()}


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
    probes: int = PROBES, hashes: int | None = None, tables: int | None = None,
) -> DataFrame:
    """(id, component_id, n_links), one row per row of ``rows``.

    Vectors of one dimension with a cosine of ``threshold`` or more are linked if a table
    brings them together; ``n_links`` counts the other rows linked, ``component_id`` is
    the least id connected. Vectors that are null, empty, zero or hold null or non-finite
    components are linked with nothing. Equal vectors are one node with its copies.

    ``hashes`` a table are by default the least number that leaves about ``BUCKET_ROWS`` rows
    to a bucket, ``tables`` as many as ``tables_for`` asks for. A pair that meets in several buckets is taken
    in the first only, which is found from the codes of both; of pairs that rounded components rule
    out no vector moves.
    """
    source = rows.select(quoted(vec_id).alias("id"), quoted(embedding).cast("array<double>").alias("vector"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                nodes: list[bytes | None] = [None] * batch.num_rows
                units: list[bytes | None] = [None] * batch.num_rows
                for places, unit in unit_rows(batch.column("vector").to_pylist()).values():
                    for i, x in zip(places, unit + 0.0):  # no negative zeros
                        units[i] = x.tobytes()
                        nodes[i] = hashlib.blake2b(units[i], digest_size=16).digest()
                yield pa.record_batch([batch.column("id"), pa.array(nodes, pa.binary()), pa.array(units, pa.binary())], ["id", "node", "unit"])

    made = T.StructType.fromDDL("node BINARY, unit BINARY").fields
    known = stored(source.mapInArrow(prepare, T.StructType([source.schema["id"], *made])), "vectors")
    nodes = known.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.first("unit").alias("unit"))
    nodes = stored(nodes, "nodes")
    n, longest = nodes.agg(F.count("*"), F.max(F.octet_length("unit"))).first()
    dims = (longest or 8) // 8
    if hashes is None:
        width = width_for(dims)
        hashes = max(1, math.ceil(math.log(max(n / BUCKET_ROWS * (1 + probes), 1)) / math.log(2 * width)))
    if tables is None:
        tables = tables_for(threshold, dims, hashes, probes)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                units = batch.column("unit").to_pylist()
                for dims in {len(u) for u in units}:
                    at = [i for i, u in enumerate(units) if len(u) == dims]
                    vectors = np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), -1)
                    codes = bucket_codes(vectors, tables, hashes, probes)
                    taken = batch.take(pa.array(at))
                    ends = np.arange(len(at) + 1) * tables * (1 + probes)
                    flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes.ravel()))
                    narrow = pa.array(narrow_codes(codes, (2 * width_for(dims // 8)) ** hashes), pa.binary())
                    steps = pa.array(in_bytes(vectors), pa.binary())
                    own = ["node", "unit", "copies"]
                    yield pa.record_batch([*(taken.column(c) for c in own), flat, narrow, steps], [*own, "codes", "narrow", "steps"])

    made = "node BINARY, unit BINARY, copies BIGINT, codes ARRAY<BIGINT>, narrow BINARY, steps BINARY"
    coded_nodes = nodes.select("node", "unit", "copies").mapInArrow(coded, made)
    coded_nodes = stored(coded_nodes, "codes")
    one = F.posexplode("codes").alias("at", "code")
    members = coded_nodes.select("node", F.octet_length("unit").alias("dims"), one).filter("code >= 0")
    table_of, probe = F.floor(F.col("at") / (1 + probes)).cast("int"), F.col("at") % (1 + probes) > 0
    members = members.select("dims", table_of.alias("tab"), "code", "node", probe.alias("probe"))
    # A bucket that only probes reach has no pair to verify.
    cells = dealt_to_cells(members, ["dims", "tab", "code"], "node", anchor="NOT probe")
    cells = cells.join(coded_nodes.select("node", "narrow", "steps"), "node")
    cell = ["dims", "tab", "code", "low", "high"]
    own = [*cell, "part", "probe", "node"]
    cells = brought_together(cells.select(*own, "narrow", "steps"), cell)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in whole_cells(batches, 5, rows=4096):
            needed = np.zeros(table.num_rows, dtype=bool)
            tab, code = table.column("tab").to_numpy(), table.column("code").to_numpy()
            low, high, part, dims = (table.column(c).to_numpy() for c in ("low", "high", "part", "dims"))
            probe, codes = table.column("probe").to_numpy(), wide_codes(table.column("narrow").to_pylist(), tables, probes)
            near = may_reach(table.column("steps").to_pylist(), threshold)
            for i, j in pairs_in_cells(number, low != high, part):
                fit = ~(probe[i] & probe[j])
                i, j = i[fit], j[fit]
                fit = near(i, j)
                i, j = i[fit], j[fit]
                once = meet_first(codes, tab, code, i, j)
                needed[i[once]] = needed[j[once]] = True
            if needed.any():
                yield table.select(own).filter(pa.array(needed)).combine_chunks().to_batches()[0]

    # A vector goes to the cells in which it first meets one that may be near.
    cells = cells.mapInArrow(choose, T.StructType([cells.schema[c] for c in own]))
    cells = stored(cells, "first-buckets").join(coded_nodes.select("node", "unit", "copies", "narrow"), "node")
    cells = brought_together(cells.select(*own, "unit", "copies", "narrow"), cell)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in whole_cells(batches, 5, rows=4096):
            n = table.num_rows
            units, tab, code = table.column("unit").to_pylist(), table.column("tab").to_numpy(), table.column("code").to_numpy()
            low, high, part = (table.column(c).to_numpy() for c in ("low", "high", "part"))
            probe = table.column("probe").to_numpy()
            codes = wide_codes(table.column("narrow").to_pylist(), tables, probes)
            copies = table.column("copies").to_numpy()
            names = table.column("node").to_pylist()
            # Cells of several dimensions may lie in one table; rows of a pair have the same.
            vectors = np.zeros((n, max(len(u) for u in units) // 8))
            for i, u in enumerate(units):
                vectors[i, : len(u) // 8] = np.frombuffer(u)
            linked, edges = np.zeros(n, dtype=np.int64), []
            for i, j in pairs_in_cells(number, low != high, part):
                fit = ~(probe[i] & probe[j])
                i, j = i[fit], j[fit]
                near = np.concatenate([
                    np.einsum("ij,ij->i", vectors[i[s : s + 8192]], vectors[j[s : s + 8192]]) for s in range(0, len(i), 8192)
                ] or [np.array([])]) >= threshold
                i, j = i[near], j[near]
                once = meet_first(codes, tab, code, i, j)
                i, j = i[once], j[once]
                np.add.at(linked, i, copies[j])
                np.add.at(linked, j, copies[i])
                edges.append((i, j))
            hit = np.flatnonzero(linked)
            if len(hit):
                root = local_roots(n, np.concatenate([a for a, _ in edges]), np.concatenate([b for _, b in edges]))
                yield pa.record_batch(
                    [
                        pa.array([names[k] for k in hit.tolist()], pa.binary()), pa.array([names[k] for k in root[hit].tolist()], pa.binary()),
                        pa.array(linked[hit], pa.int64()),
                    ],
                    ["node", "root", "linked"],
                )

    found = cells.mapInArrow(verify, "node BINARY, root BINARY, linked BIGINT")
    done = grouped(known.select("id", "node"), found, F.col("id"))
    return done.select("id", F.col("first_").alias("component_id"), F.col("links_").alias("n_links"))
