"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a hash of its code point. An n-gram of
letters is the product of its letters' vectors, each rotated by its place (binding with
permutation); a text is the sum of its n-grams' vectors (bundling). Languages are the bundles of
their documents, and a document has the language whose prototype has the largest cosine to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import packed, quoted, stored, text_slices, unpacked, worker_state
from lakemark.llm.fingerprints import STEP, mixed

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: Bytes of text bundled together, n-grams bound together, and n-grams of a text added at once.
SLICE_BYTES = 1 << 20
BOUND = 4096
PIECE = 1 << 22
#: Prototypes that a scan compares with; more languages take more scans.
BLOCK = 1024


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return worker_state("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))


def letters_of(text: str | None, letter: np.ndarray) -> np.ndarray:
    """Code points of the letters in lower case; what is between words, and both ends, is one 0.

    Empty for a text without letters.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    points = np.where(letter[points], points, 0)
    points = np.concatenate([[0], points, [0]])
    kept = np.ones(len(points), dtype=bool)
    kept[1:] = (points[1:] != 0) | (points[:-1] != 0)
    points = points[kept]
    return points if len(points) > 1 else points[:0]


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """A row of +1 and -1 for each code point."""
    words = -(-dimensions // 64)
    with np.errstate(over="ignore"):
        seeds = (points[:, None].astype(np.uint64) * np.uint64(words) + np.arange(words, dtype=np.uint64) + np.uint64(1)) * STEP
    bits = np.unpackbits(mixed(seeds).view(np.uint8).reshape(len(points), -1), axis=1)[:, :dimensions]
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def bundles(texts: list[str | None], dimensions: int = DIMENSIONS, gram: int = GRAM, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of every text, whole numbers in doubles, and its number of n-grams.

    With ``groups`` (a number for each text) the bundle and number of every group.
    """
    letter = letter_table()
    streams = [letters_of(t, letter) for t in texts]
    into = np.arange(len(texts)) if groups is None else groups
    rows = int(into.max()) + 1 if len(into) else 0
    out, number = np.zeros((rows, dimensions)), np.zeros(rows, dtype=np.int64)
    sizes = np.array([max(len(s) - gram + 1, 0) for s in streams], dtype=np.int64)
    if not sizes.sum():
        return out, number
    flat = np.concatenate(streams)
    alphabet, code = np.unique(flat, return_inverse=True)
    vectors = letter_vectors(alphabet, dimensions)
    rotated = [np.roll(vectors, gram - 1 - k, axis=1) for k in range(gram)]
    # n-grams start where as many letters of the same text follow.
    starts = np.cumsum([0, *map(len, streams[:-1])])
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    row = np.repeat(into, sizes)
    packed_ = np.zeros(len(at), dtype=np.int64)
    for k in range(gram):
        packed_ = packed_ * len(alphabet) + code[at + k]
    if len(alphabet) ** gram <= 1 << 24:
        used = np.flatnonzero(np.bincount(packed_, minlength=len(alphabet) ** gram))
        place = np.zeros(len(alphabet) ** gram, dtype=np.int64)
        place[used] = np.arange(len(used))
        place = place[packed_]
    else:
        used, place = np.unique(packed_, return_inverse=True)
    for first in range(0, len(used), BOUND):
        part = used[first : first + BOUND]
        bound, rest = np.ones((len(part), dimensions), dtype=np.int8), part
        for k in range(gram - 1, -1, -1):
            rest, c = np.divmod(rest, len(alphabet))
            bound *= rotated[k][c]
        here = np.flatnonzero((place >= first) & (place < first + BOUND)) if len(used) > BOUND else np.arange(len(place))
        # Sums of so many n-grams are exact in single precision.
        for some in np.array_split(here, len(here) // PIECE + 1):
            cell = row[some] * len(part) + (place[some] - first)
            counts = np.bincount(cell, minlength=rows * len(part)).reshape(rows, len(part)).astype(np.float32)
            out += counts @ bound.astype(np.float32)
    np.add.at(number, into, sizes)
    return out, number


def fit_prototypes(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, gram: int = GRAM
) -> DataFrame:
    """(lang, vector ARRAY<BIGINT>): the bundle of all documents of each language, stored.

    Rows without a language or without letters are left out; every copy counts. A task sends
    one row of sums for each language it meets, and Spark adds the sums up by component, so no
    task holds the documents of a language.
    """
    rows = docs.select(quoted(lang).cast("string").alias("lang"), quoted(text).alias("text")).dropna()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flushed() -> pa.RecordBatch:
            vectors = pa.array([v.astype(np.int64) for v in held.values()], pa.list_(pa.int64()))
            out = pa.record_batch([pa.array(list(held), pa.string()), vectors], ["lang", "vector"])
            held.clear()
            return out

        for batch in text_slices(batches, limit=SLICE_BYTES):
            encoded = batch.column("lang").dictionary_encode()
            names, groups = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
            sums, number = bundles(batch.column("text").to_pylist(), dimensions, gram, groups)
            for name, vector, n in zip(names, sums, number):
                if n:
                    held[name] = held[name] + vector if name in held else vector
            if len(held) > BLOCK:
                yield flushed()
        if held:
            yield flushed()

    sent = rows.mapInArrow(summed, "lang STRING, vector ARRAY<BIGINT>")
    sent = sent.select("lang", F.posexplode("vector").alias("place", "value"))
    sums = sent.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    # As many entries as the vectors have dimensions.
    entries = F.array_sort(F.collect_list(F.struct("place", "value")))
    vectors = sums.groupBy("lang").agg(F.transform(entries, lambda e: e["value"]).alias("vector"))
    return stored(vectors, "language-prototypes")


def identify(
    docs: DataFrame, prototypes: DataFrame, text: str = "text", name: str = "lang_pred", score: str = "score",
    dimensions: int = DIMENSIONS, gram: int = GRAM,
) -> DataFrame:
    """``docs`` with the language of every whole text and the cosine to its prototype, 0 at least.

    Ties go to the least name by code point. A null text, or one without letters, is ``und``
    with score 0, as are all texts if there are no prototypes. Only the text is read. Columns
    of these names are replaced. Rows stay in their partitions; a scan compares with
    some 1,000 prototypes, so very many languages take several scans, whose best is kept.
    """
    rows = packed(docs, text=quoted(text))
    rows = rows.select("row_", F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("found"), "text")
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"])
    blocks = prototypes.count() // BLOCK + 1
    for block in range(blocks):
        mine = prototypes.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block).orderBy("lang").toArrow()
        names = mine.column("lang").to_pylist()
        matrix = np.array(mine.column("vector").to_pylist(), dtype=np.float64).reshape(len(names), dimensions)
        length = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = matrix / np.where(length > 0, length, 1.0)

        def compared(batches: Iterator[pa.RecordBatch], names: list[str] = names, matrix: np.ndarray = matrix) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, limit=SLICE_BYTES):
                vectors, number = bundles(batch.column("text").to_pylist(), dimensions, gram)
                norm = np.linalg.norm(vectors, axis=1)
                cosine = np.round(vectors @ matrix.T / np.where(norm > 0, norm, 1.0)[:, None], 6)
                best = cosine.argmax(axis=1) if names else np.zeros(len(vectors), dtype=int)
                lang, value, found = (batch.column(c).to_pylist() for c in ("lang", "score", "found"))
                for i in np.flatnonzero(number).tolist() if names else ():
                    here = max(float(cosine[i, best[i]]), 0.0)
                    if not found[i] or (here, lang[i]) > (value[i], names[best[i]]):
                        lang[i], value[i], found[i] = names[best[i]], here, True
                yield pa.record_batch(
                    [batch.column("row_"), pa.array(lang, pa.string()), pa.array(value, pa.float64()), pa.array(found, pa.bool_())],
                    ["row_", "lang", "score", "found"],
                )

        if block:
            rows = rows.withColumn("text", F.col("row_").getField(text))
        rows = rows.mapInArrow(compared, schema)
    return unpacked(rows, docs.columns, **{name: F.col("lang"), score: F.col("score")})


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
