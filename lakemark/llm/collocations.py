"""Phrases that occur more often than their parts suggest, counted in counting quotient filters.

Frequent words get numbers, and an n-gram is its words' numbers packed into bits. An invertible
permutation of these bits scatters the n-grams; the first bits of the result, the quotient, say in
which run of a filter an n-gram is, and the run stores the whole rest, the remainder. So
a filter holds sorted remainders, run lengths and counters, is small, and loses nothing: the
quotient and remainder give back the packed n-gram. Tasks build filters of their n-grams, cut into
shards by the first bits; a shard merges the sorted filters that all tasks sent it.

An n-gram is counted only where both n-grams inside it that are one word shorter may be frequent,
which a bit table of a bounded size answers; it may err to the safe side only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemark.llm.common import BROADCAST_BYTES, broadcast_if_small, quoted, stored, text_slices
from lakemark.llm.filters import as_filter, of_filter
from lakemark.llm.fingerprints import MIX_1, MIX_2, STEP, mixed

LONGEST = 5
LEAST = 100
TOP = 2000
SCALE = 1000
UNDETERMINED = "und"
#: Different words, and n-grams, that a task holds before it sends what it has.
HELD_WORDS = 500_000
HELD_GRAMS = 1 << 21
#: n-grams for each shard, about, shards (a power of two) that filters are cut into at a time,
#: and numbers of words in a stored row.
SHARD_GRAMS = 1 << 20
FAN_BITS = 11
ROW_WORDS = 1 << 18
#: Most bits of the table of n-grams that may be frequent: 16 MB.
TABLE_BITS = 27
#: Shares of a language that are ranked apart first.
SHARES = 64
#: Words whose numbers are given in one window.
NUMBERED = 100_000
BREAK = b"\n"
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10 + b" ")


def words_and_breaks(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z in lower case, and a line feed where a piece ends."""
    return [w for w in (text or b"").translate(FOLDED).replace(BREAK, b" \n ").split(b" ") if w]


# Filters ---------------------------------------------------------------------------------------
# An n-gram of k words of ``bits`` bits each is a row of limbs: as many words as fit into 64 bits
# stand in each, first words in the first limb.


def limb_layout(k: int, bits: int) -> list[int]:
    """Words in each limb."""
    fit = 64 // bits
    return [min(fit, k - at) for at in range(0, k, fit)]


def packed_grams(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """The limbs of n-grams given as one array of word numbers for each place."""
    out, at = [], 0
    for words in limb_layout(len(columns), bits):
        limb = np.zeros(len(columns[0]), dtype=np.uint64)
        for column in columns[at : at + words]:
            limb = (limb << np.uint64(bits)) | column.astype(np.uint64)
        out.append(limb)
        at += words
    return np.stack(out, axis=1)


def unpacked_grams(limbs: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The word numbers of packed n-grams, a row for each."""
    columns: list[np.ndarray] = []
    mask = np.uint64((1 << bits) - 1)
    for at, words in enumerate(limb_layout(k, bits)):
        columns += [(limbs[:, at] >> np.uint64(bits * (words - 1 - w))) & mask for w in range(words)]
    return np.stack(columns, axis=1).astype(np.int64)


def scrambled(x: np.ndarray, width: int, back: bool = False) -> np.ndarray:
    """A permutation of the numbers of ``width`` bits, or its inverse.

    A number is combined with its own upper half, which undoes itself, and multiplied by an odd
    factor, which the inverse factor undoes.
    """
    half, mask = np.uint64((width + 1) // 2), np.uint64((1 << width) - 1)
    factors = (int(MIX_1), int(MIX_2))
    if back:
        factors = tuple(pow(f, -1, 1 << 64) for f in reversed(factors))
    with np.errstate(over="ignore"):
        for factor in factors:
            x = x ^ (x >> half)
            x = (x * np.uint64(factor)) & mask
            x = x ^ (x >> half)
    return x


def permuted(limbs: np.ndarray, widths: list[int], back: bool = False) -> np.ndarray:
    """The packed n-grams scrambled within their bits, or back again. A hash of the limbs behind is
    added to a limb first, so the first one depends on all words."""
    out = limbs.copy()
    last = len(widths) - 1
    for at in range(last + 1) if back else range(last, -1, -1):
        mask = np.uint64((1 << widths[at]) - 1)
        # Going back, the limb behind is still scrambled, as it was when it was added.
        with np.errstate(over="ignore"):
            behind = mixed(out[:, at + 1] + STEP) & mask if at < last else np.uint64(0)
        if back:
            out[:, at] = scrambled(out[:, at], widths[at], back) ^ behind
        else:
            out[:, at] = scrambled(out[:, at] ^ behind, widths[at])
    return out


def counted(limbs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows merged and sorted by their limbs, counts added up."""
    if limbs.shape[1] == 1:
        order = np.argsort(limbs[:, 0], kind="stable")
    else:
        order = np.lexsort(limbs.T[::-1])
    limbs, counts = limbs[order], counts[order]
    if not len(limbs):
        return limbs, counts
    starts = np.flatnonzero(np.concatenate([[True], (limbs[1:] != limbs[:-1]).any(axis=1)]))
    return limbs[starts], np.add.reduceat(counts, starts)


def merged(filters: list[bytes], widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of several filters, sorted, counts added up; two by two, so that what several
    filters hold is one entry early."""
    parts = [of_filter(f, widths) for f in filters]
    while len(parts) > 1:
        pairs = (parts[i : i + 2] for i in range(0, len(parts), 2))
        parts = [counted(*(np.concatenate(x) for x in zip(*pair))) for pair in pairs]
    return parts[0]


def cut(limbs: np.ndarray, counts: np.ndarray, widths: list[int], shard_bits: int) -> pa.Table:
    """Filters (shard, filter) of sorted n-grams, dealt out by the last bits of the first limb."""
    shard = (limbs[:, 0] & np.uint64((1 << shard_bits) - 1)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    parts = np.split(order, starts[1:])
    blobs = [as_filter(limbs[p], counts[p], widths) for p in parts if len(p)]
    return pa.table({"shard": pa.array(numbers, pa.int64()), "filter": pa.array(blobs, pa.binary())})


# Words -----------------------------------------------------------------------------------------


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, f) of rows (lang, text); the row without a word has the number of all words.

    Tasks count in memory up to a bounded number of words and send what they have.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flushed() -> pa.RecordBatch:
            langs, words, times = [], [], []
            for lang, own in held.items():
                own.pop(BREAK, None)
                langs += [lang] * (len(own) + 1)
                words += [*own, None]
                times += [*own.values(), sum(own.values())]
            held.clear()
            return pa.record_batch(
                [pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["lang", "word", "f"]
            )

        for batch in text_slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                held.setdefault(lang, Counter()).update(words_and_breaks(text))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield flushed()
        if held:
            yield flushed()

    sent = rows.mapInArrow(count, "lang STRING, word STRING, f BIGINT")
    return sent.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with a number each, ``id``, from 0 and nearly without gaps.

    Words are dealt to buckets by a hash, and numbered within each: no task has all of them.
    """
    buckets = words.count() // NUMBERED + 1
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(buckets))
    order = Window.partitionBy("bucket_").orderBy("lang", "word")
    place = (F.row_number().over(order) - 1).cast("long") * F.lit(buckets) + F.col("bucket_")
    return words.withColumn("bucket_", bucket).withColumn("id", place).drop("bucket_")


def word_numbers(rows: DataFrame, words: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(ids BINARY): the texts as 32-bit word numbers, -1 for a rare word and between pieces.

    The dictionary goes to all tasks if it was measured to be at most ``broadcast_bytes``; else
    the words of every piece of text are joined to it and put in order again.
    """
    size = words.agg(F.sum(F.octet_length("word") + F.octet_length("lang") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        known: dict[str, dict[bytes, int]] = {}
        for lang, word, number in zip(*words.select("lang", "word", "id").toArrow().to_pydict().values()):
            known.setdefault(lang, {})[word.encode()] = number
        shared = rows.sparkSession.sparkContext.broadcast(known)

        def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dictionary, none = shared.value, {}
            for batch in text_slices(batches):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                out = []
                for lang, text in zip(batch.column("lang").to_pylist(), texts):
                    own = dictionary.get(lang, none)
                    out += [own.get(w, -1) for w in words_and_breaks(text)]
                    out.append(-1)
                yield from rows_of_numbers(np.array(out, dtype=np.int64))

        return rows.mapInArrow(looked_up, "ids BINARY")

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                all_words = words_and_breaks(text)
                # Long texts in pieces, each with the first words of the next one behind it.
                for at in range(0, len(all_words), ROW_WORDS):
                    part = all_words[at : at + ROW_WORDS + LONGEST - 1]
                    cells = pa.array([part], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
                    more = pa.array([len(all_words) > at + ROW_WORDS])
                    yield pa.record_batch([pa.array([lang], pa.string()), more, cells], ["lang", "more", "words"])

    # Stored with a number for each row, which a join of the words may then rely on.
    pieces = stored(rows.mapInArrow(spelled, "lang STRING, more BOOLEAN, words ARRAY<STRING>").withColumn("row", F.monotonically_increasing_id()), "phrase-words")
    places = pieces.select("row", "lang", F.posexplode("words").alias("place", "word"))
    found = places.join(words.select("lang", "word", "id"), ["lang", "word"])
    lists = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("found"))
    lists = lists.join(pieces.select("row", "more"), "row").select(F.col("found.place").alias("place"), F.col("found.id").alias("id"), "more")

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, number, more in zip(*(batch.column(c).to_pylist() for c in ("place", "id", "more"))):
                whole = np.full(max(place) + 2, -1, dtype=np.int64)
                whole[place] = number
                yield from rows_of_numbers(whole, ROW_WORDS if more else None)

    return lists.mapInArrow(in_order, "ids BINARY")


def rows_of_numbers(numbers: np.ndarray, starts: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of one row with word numbers, runs of -1 cut to one, rows of bounded length.

    A row also has the first numbers of the next one, as -2 - number: n-grams may end there but
    do not begin there, so each is in one row. Nor do any begin at ``starts`` or behind it.
    """
    stop = len(numbers) if starts is None else starts
    for at in range(0, stop, ROW_WORDS):
        part = numbers[at : at + ROW_WORDS + LONGEST - 1].copy()
        own = min(ROW_WORDS, stop - at)
        tail = part[own:]
        part[own:] = np.where(tail >= 0, -2 - tail, tail)
        kept = (part != -1) | np.concatenate([[False], part[:-1] != -1])
        yield pa.record_batch([pa.array([part[kept].astype(np.int32).tobytes()], pa.binary())], ["ids"])


# n-grams ---------------------------------------------------------------------------------------


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of n-grams, a column for each place."""
    out = np.zeros(len(columns[0]), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in columns:
            out = mixed(out * STEP + column.astype(np.uint64) + np.uint64(1))
    return out


def has_bit(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit of each hash is set in a table of 2^bits bits."""
    place = hashes >> np.uint64(64 - bits)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def windows(data: bytes, k: int, table: np.ndarray | None, bits: int) -> list[np.ndarray]:
    """The n-grams of k words in a row of numbers, a column for each place."""
    raw = np.frombuffer(data, np.int32).astype(np.int64)
    if len(raw) < k:
        return [np.zeros(0, dtype=np.int64)] * k
    # Numbers below -1 are words of the next row: an n-gram may end there, not begin.
    number = np.where(raw < -1, -2 - raw, raw)
    last = len(raw) - k + 1
    fine = raw[:last] >= 0
    for j in range(1, k):
        fine &= number[j : last + j] >= 0
    at = np.flatnonzero(fine)
    columns = [number[at + j] for j in range(k)]
    if table is not None and len(at):
        possible = has_bit(table, gram_hash(columns[:-1]), bits) & has_bit(table, gram_hash(columns[1:]), bits)
        columns = [c[possible] for c in columns]
    return columns


def frequent_grams(
    streams: DataFrame, k: int, bits: int, least: int, shard_bits: int, table: np.ndarray | None, table_bits: int,
    fan_bits: int = FAN_BITS,
) -> DataFrame:
    """(ids ARRAY<BIGINT>, f) of the n-grams of k words that occur ``least`` times or more.

    Tasks cut their filters into at most 2^fan_bits shards. If more are needed, lots of filters of
    a shard are merged and cut again, so that what is sent are filters and not single n-grams
    however many shards there are.
    """
    shared = streams.sparkSession.sparkContext.broadcast(table) if table is not None else None
    widths = [bits * words for words in limb_layout(k, bits)]

    first = min(shard_bits, fan_bits)

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared is not None else None
        held, number = [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                columns = windows(data, k, known, table_bits)
                if len(columns[0]):
                    limbs = permuted(packed_grams(columns, bits), widths)
                    held.append(counted(limbs, np.ones(len(limbs), dtype=np.int64)))
                    number += len(held[-1][1])
                if number > HELD_GRAMS:
                    yield from cut(*counted(*(np.concatenate(x) for x in zip(*held))), widths, first).to_batches()
                    held, number = [], 0
        if held:
            yield from cut(*counted(*(np.concatenate(x) for x in zip(*held))), widths, first).to_batches()

    def merge(group: pa.Table) -> pa.Table:
        limbs, counts = merged(group.column("filter").to_pylist(), widths)
        often = counts >= least
        ids = unpacked_grams(permuted(limbs[often], widths, back=True), k, bits)
        return pa.table({"ids": pa.array(ids.tolist(), pa.list_(pa.int64())), "f": pa.array(counts[often], pa.int64())})

    def cut_into(shards: int) -> Callable[[pa.Table], pa.Table]:
        return lambda group: cut(*merged(group.column("filter").to_pylist(), widths), widths, shards)

    sent = streams.mapInArrow(filters, "shard BIGINT, filter BINARY")
    at = first
    while at < shard_bits:
        lots, at = 1 << (shard_bits - at), min(shard_bits, at + fan_bits)

        lot = F.pmod(F.xxhash64("filter"), F.lit(lots))
        sent = sent.withColumn("lot", lot).groupBy("shard", "lot").applyInArrow(cut_into(at), "shard BIGINT, filter BINARY")
    return sent.groupBy("shard").applyInArrow(merge, "ids ARRAY<BIGINT>, f BIGINT")


def bit_table(grams: DataFrame) -> tuple[np.ndarray, int]:
    """A table of bits with those of the hashes of all ``grams`` set, of a size that fits them up
    to a fixed one, and the power of two of its size."""
    bits = min(max(16 * grams.count(), 1 << 16).bit_length(), TABLE_BITS)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            columns = list(ids.flatten().to_numpy().reshape(len(ids), -1).T) if len(ids) else [np.zeros(0, dtype=np.int64)]
            place = gram_hash(columns) >> np.uint64(64 - bits)
            word, bit = place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))
            yield pa.record_batch([pa.array(word.astype(np.int64)), pa.array(bit.view(np.int64))], ["word", "bits"])

    found = grams.select("ids").mapInArrow(places, "word BIGINT, bits BIGINT")
    # One row for each 64 bits of the table at most.
    got = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return table, bits


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
    broadcast_bytes: int = BROADCAST_BYTES, shard_grams: int = SHARD_GRAMS, fan_bits: int = FAN_BITS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, f, id), sizes (lang, n), and phrases (ids, f) of 1 to ``longest`` words,
    each a stored table; words and phrases that occur ``least`` times or more in a language.

    A null language is ``und`` (and one with such rows of its own), a null text is empty. Every
    copy of a text counts.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words, not {longest}")
    rows = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"), quoted(text).alias("text"))
    counts = stored(word_counts(rows).filter((F.col("f") >= least) | F.col("word").isNull()), "phrase-word-counts")
    sizes = stored(counts.filter(F.col("word").isNull()).select("lang", F.col("f").alias("n")), "phrase-sizes")
    words = stored(numbered(counts.filter(F.col("word").isNotNull())), "phrase-numbers")
    bits = max(int(words.agg(F.max("id")).first()[0] or 0).bit_length(), 1)
    streams = stored(word_numbers(rows, words, broadcast_bytes), "phrase-streams")
    places = streams.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shard_bits = (places // 4 // shard_grams).bit_length()
    found = [words.select(F.array("id").alias("ids"), "f")]
    table, table_bits = None, 0
    for k in range(2, longest + 1):
        grams = stored(frequent_grams(streams, k, bits, least, shard_bits, table, table_bits, fan_bits), f"phrases-{k}")
        found.append(grams)
        if k < longest:
            table, table_bits = bit_table(grams)
    return words, sizes, stored(reduce(DataFrame.unionByName, found), "phrases")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
    top: int = TOP, scale: int = SCALE, **limits: int,
) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase of 2 to ``longest`` words that occurs a >= ``least`` times, n words in its language,
    has the score of its weakest cut, floor(scale x a x n / (l x r)) with the counts l and r of what
    is in front of and behind the cut, the first of equals. A phrase inside a longer one that
    occurs as often is left out; as the phrases between the two then occur as often too, those one
    word longer decide. Order: score and a falling, then the phrase by its bytes.
    Empty tables and languages without phrases give no rows.
    """
    words, sizes, phrases = phrase_counts(docs, text, lang, longest, least, **limits)
    ids, length = F.col("ids"), F.size("ids")
    several = phrases.filter(length > 1)
    inner = several.filter(length > 2).select(
        F.explode(F.array(F.slice(ids, F.lit(1), length - 1), F.slice(ids, F.lit(2), length - 1))).alias("ids"), "f"
    )
    kept = several.join(inner.distinct(), ["ids", "f"], "left_anti")
    cuts = kept.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), length - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("ids", F.lit(1), F.col("k")))
    cuts = cuts.withColumn("rest", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
    cuts = cuts.join(phrases.select(ids.alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(phrases.select(ids.alias("rest"), F.col("f").alias("r")), "rest")
    # The first word tells the language, and with it n.
    told = words.select(F.col("id").alias("word_id"), "lang")
    cuts = cuts.join(told, F.element_at("ids", 1) == F.col("word_id")).join(broadcast_if_small(sizes), "lang")

    score = F.expr(f"({scale}BD * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.withColumn("score", score)
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("weakest")
    scored = scored.groupBy("lang", "ids", "a", "n").agg(weakest)
    spelled = scored.select("ids", F.posexplode("ids").alias("place", "word_id"))
    spelled = spelled.join(words.select(F.col("id").alias("word_id"), "word"), "word_id")
    in_order = F.array_sort(F.collect_list(F.struct("place", "word")))
    spelled = spelled.groupBy("ids").agg(F.array_join(F.transform(in_order, lambda s: s["word"]), " ").alias("phrase"))
    rows = scored.join(spelled, "ids").select("lang", "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score")
    # First within shares of a language, so that its last window sees a bounded number of rows.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    rows = rows.withColumn("share_", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    shares = Window.partitionBy("lang", "share_").orderBy(*best)
    rows = rows.withColumn("rank", F.row_number().over(shares)).filter(F.col("rank") <= top).drop("rank")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
