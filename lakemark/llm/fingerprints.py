"""Document fingerprints by consistent weighted sampling.

A text is the weighted set of its words, the weight being how often a word occurs. Each
sample draws, for every word, Gamma and uniform numbers from hashes of the word, and
takes the word and quantised weight with the least value. The share of samples in which
two texts agree estimates their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import SLICE_CHARS, quoted, text_slices, unpacked

SAMPLES = 64
SEED = 11
#: Quantiles of ids that place documents in ranges are right to this part of a range.
ACCURACY = 10

STEP, MIX_1, MIX_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
LOW = np.uint64(0xFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1) from 64 bits."""
    return ((x >> np.uint64(32)) + 0.5) * 2.0**-32, ((x & LOW) + 0.5) * 2.0**-32


def draws(terms: np.ndarray, log_weights: np.ndarray, sample: int, seed: int) -> np.ndarray:
    """Logarithm of the value of each (term hash, log weight) in one sample.

    With r and c from Gamma(2, 1), b uniform, and t the whole part of log w / r + b,
    it is log c - r (t - b + 1): a function of the term and t alone.
    """
    salt = np.uint64((seed * 1_000_003 + sample * 3) % (1 << 64))
    with np.errstate(over="ignore"):
        own = [mixed(terms + STEP * (salt + np.uint64(i))) for i in range(3)]
    (u1, u2), (u3, u4), (b, _) = (halves(x) for x in own)
    r, c = -np.log(u1 * u2), -np.log(u3 * u4)
    return np.log(c) - r * (np.floor(log_weights / r + b) - b + 1)


def signatures(texts: list[str | None], samples: int = SAMPLES, seed: int = SEED) -> np.ndarray:
    """One row of ``samples`` 32-bit numbers per text; all ones for a text without words."""
    codes: dict[str, int] = {}
    words = [(t or "").lower().split() for t in texts]
    sizes = np.array([len(w) for w in words])
    flat = np.fromiter((codes.setdefault(w, len(codes)) for w in chain.from_iterable(words)), np.int64, int(sizes.sum()))
    out = np.full((len(texts), samples), 0xFFFFFFFF, dtype=np.uint32)
    if not len(flat):
        return out
    pairs, weights = np.unique(np.repeat(np.arange(len(texts)), sizes) * len(codes) + flat, return_counts=True)
    doc, term = np.divmod(pairs, len(codes))
    # Most terms have few different weights, so each (term, weight) is drawn once.
    combos, place = np.unique(term * (int(weights.max()) + 1) + weights, return_inverse=True)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in codes), np.uint64, len(codes))
    combo_term, combo_weight = np.divmod(combos, int(weights.max()) + 1)
    combo_hash, logs = hashes[combo_term], np.log(combo_weight)
    filled, starts = np.unique(doc, return_index=True)
    for k in range(samples):
        least = np.minimum.reduceat(draws(combo_hash, logs, k, seed)[place], starts)
        out[filled, k] = (mixed(least.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    return out


def hex_lines(values: np.ndarray) -> list[str]:
    """Each row in hexadecimal, eight digits a number."""
    digits, width = values.astype(">u4").tobytes().hex(), values.shape[1] * 8
    return [digits[i : i + width] for i in range(0, len(digits), width)]


def fingerprint(
    docs: DataFrame, texts: dict[str, str], likeness: dict[str, tuple[str, str]] | None = None,
    samples: int = SAMPLES, seed: int = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the fingerprint of each text column.

    ``texts`` maps new columns to text columns; ``likeness`` maps new columns to pairs of
    the new fingerprint columns and gives the share of equal samples, 0 to 1. ``keep`` lists
    the columns of ``docs`` to return, all by default. Equal texts have equal
    fingerprints; null, empty and blank texts are alike. Rows stay in their partitions.
    """
    likeness = likeness or {}
    kept = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[quoted(c) for c in kept]).alias("row_"),
        *[quoted(c).alias(f"text_{i}") for i, c in enumerate(texts.values())],
    )
    names = list(texts)
    pairs = [(names.index(a), names.index(b)) for a, b in likeness.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Several texts a row: slices of one text are kept smaller.
        for batch in text_slices(batches, limit=SLICE_CHARS // (2 * len(names))):
            columns = [batch.column(1 + i).to_pylist() for i in range(len(names))]
            # A text that occurs again, such as the next row's neighbour, is sampled once.
            at: dict[str, int] = {}
            index = [[at.setdefault(t or "", len(at)) for t in c] for c in columns]
            found = signatures(list(at), samples, seed)
            lines = hex_lines(found)
            out = [batch.column(0)]
            out += [pa.array([lines[i] for i in own], pa.string()) for own in index]
            out += [pa.array((found[index[a]] == found[index[b]]).mean(axis=1), pa.float64()) for a, b in pairs]
            yield pa.record_batch(out, ["row_", *(f"f{i}" for i in range(len(out) - 1))])

    new = [*names, *likeness]
    fields = [T.StructField(f"f{i}", T.StringType() if i < len(names) else T.DoubleType()) for i in range(len(new))]
    done = rows.mapInArrow(run, T.StructType([rows.schema["row_"], *fields]))
    return unpacked(done, kept, **{n: F.col(f"f{i}") for i, n in enumerate(new)})


def with_successor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): the text of the next document in ascending order of the id.

    Ids that are null come last, rows of one id in order of their texts with null first; after
    the last row comes the first. Ids are cut into ranges at their approximate quantiles, each
    an id that occurs; the first row of a range also goes to the range before as its
    last neighbour. So the texts move once, and each range is read as a stream.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted(doc_id).alias("key"), quoted(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Several ranges a task even out what a hash of the range puts together.
    cuts = [F.lit(i / (4 * parts)) for i in range(1, 4 * parts)]
    quantiles = F.percentile_approx("key", F.array(*cuts), F.lit(ACCURACY * 4 * parts))
    told = rows.agg(F.min("key").alias("least"), quantiles.alias("cuts")).first()
    bounds = sorted({b for b in told["cuts"] or [] if b > told["least"]})
    n_ranges, least = len(bounds) + 1, told["least"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_of = {b: i for i, b in enumerate(bounds)}
        for batch in batches:
            keys = batch.column(0).to_pylist()
            known = np.array([least if k is None else k for k in keys], dtype=object)
            at = np.searchsorted(np.array(bounds, dtype=known.dtype), known, "right") if bounds else np.zeros(len(keys), int)
            at = np.where([k is None for k in keys], n_ranges - 1, at)
            # Rows of a range's first id are neighbours of the range before; the least id
            # (or a null, if all are null) follows the very last row.
            extra = [(i, first_of[k], 1) for i, k in enumerate(keys) if k is not None and k in first_of]
            extra += [(i, n_ranges - 1, 2) for i, k in enumerate(keys) if k == least]
            rows_at = np.concatenate([np.arange(len(keys)), np.array([i for i, _, _ in extra], int)])
            ranges = np.concatenate([at, np.array([r for _, r, _ in extra], int)])
            roles = np.concatenate([np.zeros(len(keys), int), np.array([r for _, _, r in extra], int)])
            taken = batch.take(pa.array(rows_at))
            out = [pa.array(ranges, pa.int32()), pa.array(roles, pa.int32()), taken.column(0), taken.column(1)]
            yield pa.record_batch(out, ["range", "role", "key", "text"])

    fields = [T.StructField("range", T.IntegerType()), T.StructField("role", T.IntegerType()), *rows.schema.fields]
    placed = rows.mapInArrow(place, T.StructType(fields)).repartition(parts, "range")
    placed = placed.sortWithinPartitions("range", "role", F.col("key").asc_nulls_last(), F.col("text").asc_nulls_first())

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "text", "next_text"]
        held = None
        for batch in text_slices(batches):
            own = pa.Table.from_batches([batch])
            own = own if held is None else pa.concat_tables([held, own])
            own = own.combine_chunks()
            n = own.num_rows
            held = own.slice(n - 1)
            if n > 1:
                plain = pa.array(own.column("role").to_numpy()[:-1] == 0)
                pairs = pa.table([own.column("key").slice(0, n - 1), own.column("text").slice(0, n - 1), own.column("text").slice(1)], names)
                yield from pairs.filter(plain).combine_chunks().to_batches()

    kinds = [rows.schema["key"], rows.schema["text"], T.StructField("next_text", T.StringType())]
    done = placed.mapInArrow(follow, T.StructType(kinds))
    return done.withColumnsRenamed({"key": doc_id, "text": text})
