"""Stupid-backoff language model scores of all documents from their own n-gram counts.

The n-grams of the documents are exploded in blocks of documents. Their hashes, with how often
each occurs in the block, go to count tables partitioned by hash. A table adds up what the
blocks sent and joins the totals back to them, so each block has the corpus count of every
n-gram it holds, looks the n-grams of its documents up in them and sums the logarithms
per document.

An n-gram is sent once per block and answered once, however often it occurs in the corpus: no
table and no task holds the occurrences of a frequent one. Hashes go as sorted runs in as few
bits as they allow, and have as many bits as the size of the corpus asks for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import broadcast_if_small, quoted, stored, worker_state
from lakemark.llm.filters import as_filter, of_filter, read_small, small_numbers
from lakemark.llm.fingerprints import mixed
from lakemark.llm.ngram_join import MULTIPLIER, word_hashes

ORDER = 3
#: What a shorter context costs, as a factor.
BACKOFF = 0.4
#: Text in a block, and text for each count table, about, in bytes.
BLOCK_BYTES = 4 << 20
TABLE_BYTES = 8 << 20
#: What a row counts besides its text, so that very many empty texts are several blocks too.
ROW_BYTES = 64
#: Least bits of a hash, and how many it has beyond those that number all bytes of text: an n-gram
#: then has the hash of another one in the corpus once in some million cases.
LEAST_BITS, SPARE_BITS = 48, 20


def hash_bits(total: int) -> int:
    """Bits of the hashes of the n-grams of ``total`` bytes of text."""
    return min(64, max(LEAST_BITS, total.bit_length() + SPARE_BITS))


def n_grams(texts: list[str | None], order: int, known: dict[str, int], bits: int = 64) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1 .. order the hashes of all n-grams, of ``bits`` bits, their documents, and the places of their
    last words among all words of the block, documents one after another.

    Words are what lies between blanks, in lower case.
    """
    by_text = [word_hashes((t or "").lower().split(), known) for t in texts]
    sizes = np.array([len(w) for w in by_text], dtype=np.int64)
    hashes = np.concatenate(by_text)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    within = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, grams = [], hashes
    with np.errstate(over="ignore"):
        for n in range(1, order + 1):
            if n > 1:
                # At place i: the (n-1)-gram ending one word before, and the word.
                grams = np.concatenate([grams[:1], grams[:-1] * MULTIPLIER + hashes[1:]]) if len(grams) else grams
            at = np.flatnonzero(within >= n - 1).astype(np.int32)
            out.append((mixed(grams[at] + np.uint64(n)) >> np.uint64(64 - bits), doc[at], at))
    return out


def table_starts(tables: int, bits: int) -> np.ndarray:
    """The first hash of each count table; tables are ranges of nearly the same length."""
    return np.array([-(-(t << bits) // tables) for t in range(tables)], dtype=np.uint64)


def block_scores(grams: list, counts: np.ndarray, n_docs: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Per document the sum of log10 scores without the terms in the corpus size, and the number
    of these terms; ``counts`` are corpus counts of the sorted different hashes.

    The document's own occurrences are taken off every count, so a document is scored by
    the others. A word no other document has counts as one occurrence.
    """
    flat = np.concatenate([h for h, _, _ in grams])
    doc = np.concatenate([d for _, d, _ in grams])
    order = np.argsort(flat, kind="stable")  # documents ascend within each order's n-grams
    h, d = flat[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    gram = np.cumsum(new) - 1
    new[1:] |= d[1:] != d[:-1]
    pair = np.cumsum(new) - 1
    own = np.bincount(pair)
    others = np.empty(len(h), dtype=np.int64)
    others[order] = counts[gram] - own[pair]
    words = len(grams[0][0])
    left, start = [], 0
    for g, _, at in grams:
        by_place = np.zeros(words, dtype=np.int64)
        by_place[at] = others[start : start + len(g)]
        left.append(by_place)
        start += len(g)
    # From the longest context down: a place is settled where its n-gram occurs elsewhere.
    score, open_places = np.zeros(words), np.ones(words, dtype=bool)
    penalty = np.zeros(words)
    for n in range(len(grams), 1, -1):
        whole = left[n - 1]
        context = np.concatenate([[0], left[n - 2][:-1]])
        possible = np.zeros(words, dtype=bool)
        possible[grams[n - 1][2]] = True
        hit = open_places & possible & (whole > 0)
        score[hit] = penalty[hit] + np.log10(whole[hit] / context[hit])
        open_places &= ~hit
        penalty[open_places & possible] += np.log10(backoff)
    rest = open_places
    score[rest] = penalty[rest] + np.log10(np.maximum(left[0][rest], 1))
    where = grams[0][1]
    return np.bincount(where, weights=score, minlength=n_docs), np.bincount(where[rest], minlength=n_docs)


def backoff_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF,
    block_bytes: int = BLOCK_BYTES, table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """(id, n_words, log10_score), one row per row of ``docs``, whole texts.

    The score of a word after its context is c(context word) / c(context) if that count is not
    0, else ``backoff`` times the score after the context without its first word, down
    to c(word) / corpus size; all counts and the size without the document itself. Counts
    are over all documents, copies included. Null and texts without words have 0 words and
    score 0.

    Texts are dealt once to blocks by a hash of all columns; both passes over the blocks read
    that one shuffle. Rows whose equals fill a block are dealt out by their place besides.
    Blocks and count tables grow in number with the text and the rows, not in size.
    """
    whole = F.xxhash64(*[quoted(c) for c in docs.columns])
    size = F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long") + ROW_BYTES
    by_row = docs.select(whole.alias("row"), size.alias("size")).groupBy("row").agg(F.sum("size").alias("size"))
    by_row = stored(by_row, "row-sizes")
    total = by_row.agg(F.sum("size")).first()[0] or 0
    bits, blocks, tables = hash_bits(total), total // block_bytes + 1, total // table_bytes + 1
    # At most one row for each block.
    hot = by_row.filter(F.col("size") > block_bytes).select("row", (F.floor(F.col("size") / block_bytes) + 1).alias("share"))
    hot = stored(hot, "repeated-rows")
    source = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text"))
    rows = docs.select(whole.alias("row"), quoted(doc_id).alias("id"), quoted(text).alias("text"))
    if not hot.isEmpty():
        # Exact repeats must part too, so the place of the row in its partition deals it out.
        rows = rows.withColumn("place", F.monotonically_increasing_id()).join(broadcast_if_small(hot), "row", "left")
        dealt = F.xxhash64("row", F.pmod("place", F.col("share")))
        rows = rows.withColumn("row", F.coalesce(F.when(F.col("share").isNotNull(), dealt), F.col("row")))
    rows = rows.select(F.pmod("row", F.lit(blocks)).cast("int").alias("block"), "id", "text")

    def ask(group: pa.Table) -> pa.Table:
        known = worker_state("words of n-grams", dict)
        grams = n_grams(group.column("text").to_pylist(), order, known, bits)
        flat = np.sort(np.concatenate([h for h, _, _ in grams]))
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.array([], int)
        distinct, times = flat[first], np.diff(np.append(first, len(flat)))
        starts = table_starts(tables, bits)
        ends = np.append(np.searchsorted(distinct, starts), len(distinct))
        width = [((1 << bits) // tables + 1).bit_length()]
        full = np.flatnonzero(np.diff(ends))
        parts = [(slice(ends[t], ends[t + 1]), starts[t]) for t in full]
        return pa.table({
            "table": pa.array(full, pa.int32()),
            "block": pa.array(np.full(len(full), group.column("block")[0].as_py()), pa.int32()),
            "grams": pa.array([as_filter((distinct[p] - start)[:, None], times[p], width, tight=True) for p, start in parts], pa.binary()),
        })

    def add_up(group: pa.Table) -> pa.Table:
        width = [((1 << bits) // tables + 1).bit_length()]
        sent = [of_filter(x, width, tight=True) for x in group.column("grams").to_pylist()]
        flat = np.concatenate([hashes[:, 0] for hashes, _ in sent])
        order_ = np.argsort(flat, kind="stable")
        new = np.ones(len(flat), dtype=bool)
        new[1:] = flat[order_][1:] != flat[order_][:-1]
        sums = np.add.reduceat(np.concatenate([times for _, times in sent])[order_], np.flatnonzero(new))
        counts = np.empty(len(flat), dtype=np.int64)
        counts[order_] = sums[np.cumsum(new) - 1]
        ends = np.cumsum([len(times) for _, times in sent])
        return pa.table({
            "block": group.column("block"), "table": group.column("table"), "n": pa.array(np.diff(ends, prepend=0), pa.int64()),
            "counts": pa.array([small_numbers(c) for c in np.split(counts, ends[:-1])], pa.binary()),
        })

    def sum_up(group: pa.Table, answers: pa.Table) -> pa.Table:
        known = worker_state("words of n-grams", dict)
        grams = n_grams(group.column("text").to_pylist(), order, known, bits)
        n = group.num_rows
        sizes = np.bincount(grams[0][1], minlength=n)
        if len(grams[0][0]):
            answers = answers.sort_by("table")
            counts = [read_small(x, k)[0] for x, k in zip(answers.column("counts").to_pylist(), answers.column("n").to_pylist())]
            scores, open_terms = block_scores(grams, np.concatenate(counts), n, backoff)
        else:
            scores, open_terms = np.zeros(n), np.zeros(n, dtype=np.int64)
        return pa.table({
            "id": group.column("id"), "n_words": pa.array(sizes, pa.int64()), "score": pa.array(scores, pa.float64()),
            "terms": pa.array(open_terms, pa.int64()),
        })

    asked = rows.groupBy("block").applyInArrow(ask, "table INT, block INT, grams BINARY")
    answers = asked.groupBy("table").applyInArrow(add_up, "block INT, table INT, n BIGINT, counts BINARY")
    made = T.StructType([source.schema["id"], *T.StructType.fromDDL("n_words BIGINT, score DOUBLE, terms BIGINT").fields])
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sum_up, made)
    scored = stored(scored, "lm-scores")
    size = scored.agg(F.sum("n_words")).first()[0] or 0
    others = F.greatest(F.lit(size) - F.col("n_words"), F.lit(1))
    score = F.col("score") - F.col("terms") * F.log10(others.cast("double"))
    return scored.select("id", "n_words", score.alias("log10_score"))
