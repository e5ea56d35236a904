"""Toxicity: cumulative-link ordinal regression on the words of a text and their stems.

P(grade >= k) = sigmoid(score - threshold_k) with one score for all thresholds: the sum
of the weights of the different features in the text, which are words and beginnings of
words. The expected severity is the sum of these probabilities over k.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import packed, quoted, text_slices, unpacked
from lakemark.llm.fingerprints import mixed
from lakemark.llm.ngram_join import minhashes
from lakemark.llm.pairing import local_roots

#: Labelled rows that a fit reads at most.
SAMPLE_ROWS = 8_000
#: Different words of a text that a fit uses at most.
WORDS_OF_TEXT = 20_000
#: Documents of the sample, near copies counting as one, that a feature must occur in.
MIN_DOCS = 3
#: Letters of the beginnings that are features; they stand for all inflected forms. One, two
#: and three different words with a beginning are features of their own.
STEMS = (4, 5, 6, 7)
REPEATS = 3
L1 = 1e-4
STEPS = 500
#: Expected severity from which a document is rejected.
REJECT_AT = 0.5

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of words, and of beginnings that ``n`` words have or more, written
    ``n^begin``; ascending thresholds, and the grades they part."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]
    grades: tuple[int, ...]


def words_of(text: str | None) -> set[str]:
    """The different words of a text in lower case; none for null."""
    return set(WORD.findall(text.lower())) if text else set()


def sample_words(text: str | None) -> list[str]:
    """The sorted words of a text for a fit, at most ``WORDS_OF_TEXT``."""
    words = words_of(text)
    if len(words) > WORDS_OF_TEXT:
        words = sorted(words, key=lambda w: (zlib.crc32(w.encode()), w))[:WORDS_OF_TEXT]
    return sorted(words)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function without overflow."""
    return 0.5 * (1 + np.tanh(0.5 * x))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` between ``offsets``."""
    running = np.concatenate([[0.0], np.cumsum(values)])
    return running[offsets[1:]] - running[offsets[:-1]]


def fit_ordinal(
    offsets: np.ndarray, columns: np.ndarray, n_columns: int, levels: np.ndarray, n_levels: int,
    row_weights: np.ndarray | None = None, l1: float = L1, steps: int = STEPS,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient on the cumulative logit loss.

    Row i has the features ``columns[offsets[i]:offsets[i + 1]]``, each 1, the level
    ``levels[i]`` and its share of the loss. The penalty keeps features that explain
    nothing at weight 0.
    """
    rows = len(levels)
    share = np.ones(rows) if row_weights is None else row_weights
    share = share / share.sum()
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    above = levels[:, None] > np.arange(n_levels - 1)[None, :]
    start = (share @ above).clip(1e-3, 1 - 1e-3)
    weight, cuts = np.zeros(n_columns), np.maximum.accumulate(-np.log(start / (1 - start)))
    w, c, momentum = weight.copy(), cuts.copy(), 1.0
    # A bound of the curvature per feature: a quarter of the shares of its rows, times
    # the features of such a row and the thresholds.
    load = np.bincount(columns, weights=(share * np.diff(offsets))[row_of], minlength=n_columns)
    step_w = 1.0 / (0.5 * (n_levels - 1) * np.maximum(load, 1e-6))
    for _ in range(steps):
        score = row_sums(w[columns], offsets)
        # Gradient of the sum over k of log-loss(level > k, sigmoid(score - cut_k)).
        error = (sigmoid(score[:, None] - c[None, :]) - above) * share[:, None]
        slope = np.bincount(columns, weights=error.sum(axis=1)[row_of], minlength=n_columns)
        moved = w - step_w * slope
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step_w * l1, 0.0)
        cut = np.maximum.accumulate(c + 2.0 * error.sum(axis=0))
        ahead = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        w = moved + (momentum - 1) / ahead * (moved - weight)
        c = cut + (momentum - 1) / ahead * (cut - cuts)
        weight, cuts, momentum = moved, cut, ahead
    return weight, cuts


def copy_shares(sets: list[np.ndarray]) -> np.ndarray:
    """For each set of word codes 1 / the number of sets that are nearly the same."""
    full = [i for i, s in enumerate(sets) if len(s)]
    shares = np.ones(len(sets))
    if not full:
        return shares
    values = minhashes([mixed(sets[i].astype(np.uint64) + np.uint64(1)) for i in full], 24).reshape(len(full), 8, 3)
    links = []
    for band in range(8):
        _, first, group = np.unique(values[:, band], axis=0, return_index=True, return_inverse=True)
        links.append(first[group.ravel()])
    root = local_roots(len(full), np.tile(np.arange(len(full)), 8), np.concatenate(links))
    shares[full] = 1.0 / np.bincount(root, minlength=len(full))[root]
    return shares


def likelihood_ratios(total: np.ndarray, hit: np.ndarray, n: float, p: float) -> np.ndarray:
    """Twice the log-likelihood ratio of features in ``total`` of ``n`` rows, ``hit`` of ``p``
    positive ones, to chance; 0 for those that are rarer in positive rows than chance."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 1e-9, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    ratio = 2 * (
        part(hit, total * p / n) + part(total - hit, total * (n - p) / n)
        + part(p - hit, (n - total) * p / n) + part(n - p - total + hit, (n - total) * (n - p) / n)
    )
    return np.where(hit * n > total * p, ratio, 0.0)


def telling_features(
    words: list[str], codes: np.ndarray, row_of: np.ndarray, positive: np.ndarray, shares: np.ndarray, min_docs: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Features that occur more often in positive rows than chance allows, with the rows of
    each, sorted by row.

    Row ``row_of[i]`` has the word ``words[codes[i]]``. All rows are weighed by ``shares``; the
    likelihood ratio statistic must be above 2 log(number of common features). One kind
    of feature is held at a time, and of it only what can still be chosen.
    """
    n, p = shares.sum(), (shares * positive).sum()
    names, ratios, parts, common = [], [], [], 0
    for length in (None, *STEMS):
        own: dict[str, int] = {}
        of_word = np.array(
            [own.setdefault(w[:length], len(own)) if length is None or len(w) >= length else -1 for w in words], dtype=np.int64
        )
        spread = of_word[codes]
        known = spread >= 0
        pairs, times = np.unique(row_of[known] * len(own) + spread[known], return_counts=True)
        listed = list(own)
        for repeats in range(1, REPEATS + 1 if length else 2):
            rows, features = np.divmod(pairs[times >= repeats], max(len(own), 1))
            total = np.bincount(features, weights=shares[rows], minlength=len(own))
            hit = np.bincount(features, weights=(shares * positive)[rows], minlength=len(own))
            frequent = total >= min_docs - 1e-9
            common += int(frequent.sum())
            ratio = np.where(frequent, likelihood_ratios(total, hit, n, p), 0.0)
            kept = np.flatnonzero(ratio >= 2 * np.log(max(int(frequent.sum()), 2)))
            place = np.full(len(own), -1)
            place[kept] = np.arange(len(kept)) + len(names)
            taken = place[features] >= 0
            parts.append((rows[taken], place[features[taken]]))
            names += [f"{repeats}^{listed[f]}" if length else listed[f] for f in kept.tolist()]
            ratios.append(ratio[kept])
    enough = np.concatenate(ratios) >= 2 * np.log(max(common, 2))
    rows, features = (np.concatenate([part[k] for part in parts]) for k in (0, 1))
    place = np.where(enough, np.cumsum(enough) - 1, -1)
    taken = place[features] >= 0 if len(features) else np.zeros(0, dtype=bool)
    rows, features = rows[taken], place[features[taken]] if len(features) else features
    order = np.argsort(rows, kind="stable")
    return [name for name, e in zip(names, enough) if e], rows[order], features[order]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    grade: str = "grade", sample_rows: int = SAMPLE_ROWS, min_docs: int = MIN_DOCS,
    l1: float = L1, steps: int = STEPS,
) -> OrdinalModel:
    """Fit on at most ``sample_rows`` labelled documents, picked by a hash of their id.

    ``labels`` has ``doc_id`` and an integer ``grade``; null ids and grades are left out, and
    of several grades of a document the highest counts. Of rows that share an id the text with the
    least digest is taken, so the sample has one row an id and does not depend on how rows are
    placed. Only its sets of words come to the driver, of a text with more than
    ``WORDS_OF_TEXT`` different ones those with the least hashes. Without labelled rows, or with one grade alone, all weights are 0
    and the severity of every text is that grade, or 0.
    """
    graded = labels.select(quoted(doc_id).alias("key"), quoted(grade).cast("int").alias("grade"))
    graded = graded.dropna().groupBy("key").agg(F.max("grade").alias("grade"))
    n = graded.count()
    if not n:
        return OrdinalModel({}, (), (0,))
    part = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("key")), F.lit(1 << 30))
    picked = graded.filter(part < F.lit(int((1 << 30) * min(1.0, 0.95 * sample_rows / n))))
    picked = graded if n <= sample_rows else picked
    texts = docs.select(quoted(doc_id).alias("key"), quoted(text).alias("text"))
    # The sample has at most sample_rows rows of 12 bytes: a bounded broadcast.
    texts = texts.join(F.broadcast(picked.limit(sample_rows)), "key")
    # One row an id, the text of the least digest, brought down in every task before it moves.
    least = F.min(F.struct(F.sha2("text", 256).alias("digest"), "text")).alias("least")
    texts = texts.groupBy("key", "grade").agg(least).select("key", "grade", "least.text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = [sample_words(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("key"), batch.column("grade"), pa.array(found, pa.list_(pa.string()))], ["key", "grade", "words"])

    found = T.StructField("words", T.ArrayType(T.StringType()))
    texts = texts.select("key", "grade", "text")
    rows = texts.mapInArrow(features, T.StructType([*texts.schema.fields[:2], found]))
    got = rows.toArrow().combine_chunks()
    if not got.num_rows:
        return OrdinalModel({}, (), (0,))
    # A fixed order makes the floating point sums, and so the model, the same in every run.
    got = got.take(pc.sort_indices(got, sort_keys=[("key", "ascending"), ("grade", "ascending")]))
    lists = got.column("words").combine_chunks()
    grades, levels = np.unique(got.column("grade").to_numpy(), return_inverse=True)
    if len(grades) < 2:
        return OrdinalModel({}, (), tuple(int(g) for g in grades))
    encoded = pc.dictionary_encode(lists.flatten())
    words, codes = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
    sizes = pc.list_value_length(lists).to_numpy()
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    shares = copy_shares(np.split(codes, np.cumsum(sizes)[:-1]))
    names, pair_rows, pair_features = telling_features(words, codes, row_of, levels > 0, shares, min_docs)
    # Of features with the same rows the longest beginning is taken, else the word.
    marks = np.bincount(pair_features, weights=np.random.default_rng(0).random(len(sizes))[pair_rows], minlength=len(names))
    best: dict[float, int] = {}
    for f in sorted(range(len(names)), key=lambda f: ("^" in names[f], len(names[f]), names[f])):
        best[round(marks[f], 9)] = f
    chosen = np.array(sorted(best.values()), dtype=np.int64)
    new_code = np.full(len(names), -1)
    new_code[chosen] = np.arange(len(chosen))
    kept = new_code[pair_features] >= 0
    columns = new_code[pair_features[kept]]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(pair_rows[kept], minlength=len(sizes)))])
    weight, cuts = fit_ordinal(offsets, columns, len(chosen), levels, len(grades), shares, l1, steps)
    return OrdinalModel(
        {names[chosen[i]]: float(weight[i]) for i in np.flatnonzero(weight)}, tuple(float(c) for c in cuts), tuple(int(g) for g in grades)
    )


def severities(model: OrdinalModel, texts: list[str | None]) -> np.ndarray:
    """Expected severity of each text, in grades."""
    features = model.weights
    begins = {f.rpartition("^")[2][: STEMS[0]] for f in features}

    def score(text: str | None) -> float:
        near = [w for w in words_of(text) if w[: STEMS[0]] in begins]
        if not near:
            return 0.0
        counts = Counter(w[:k] for w in near for k in STEMS if len(w) >= k)
        found = {f"{n}^{b}" for b, c in counts.items() for n in range(1, min(c, REPEATS) + 1)}
        return sum(sorted(features[f] for f in features.keys() & found.union(near)))

    scores = np.array([score(t) for t in texts])
    steps = np.diff(np.array(model.grades, dtype=float))
    above = sigmoid(scores[:, None] - np.array(model.thresholds)[None, :])
    return model.grades[0] + (above * steps[None, :]).sum(axis=1)


def score_toxicity(docs: DataFrame, model: OrdinalModel, text: str = "text", name: str = "severity") -> DataFrame:
    """``docs`` with the expected severity of every whole text behind its columns.

    A null or empty text has no words. A column of that name in ``docs`` is replaced.
    Rows stay in their partitions.
    """
    rows, at = packed(docs), docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, at):
            values = severities(model, batch.column(0).field(at).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(values, pa.float64())], ["row_", "severity"])

    done = rows.mapInArrow(scored, T.StructType([*rows.schema, T.StructField("severity", T.DoubleType())]))
    return unpacked(done, docs.columns, **{name: F.col("severity")})
