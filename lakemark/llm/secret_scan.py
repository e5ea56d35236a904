"""Secret scans: fixed patterns, and formats inferred from labelled credentials.

The values found by the patterns are the labelled credentials. For each kind a prefix tree of
their symbol classes is built and statistically compatible states are merged, which gives a
probabilistic automaton. Every run of credential characters of the patterns' least length is then scored:
log-likelihood under the best automaton against that under an automaton of ordinary runs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import packed, quoted, stored, text_slices, unpacked

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "format")
#: Runs that are scored: as long as the values of the patterns, of their characters. An equals sign
#: ends a run, as what follows it is a value of its own, or pads it; dots are inside only.
CANDIDATE = re.compile("(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{4,}[A-Za-z0-9+/_-]={0,2}")
#: Runs whose scores a worker remembers.
REMEMBERED = 500_000

#: Documents from which credentials and ordinary runs are taken for the fit, about.
SAMPLE_DOCS = 50_000
#: Labelled credentials of a kind, and ordinary runs, that a fit uses at most.
SAMPLE_STRINGS = 1_000
#: Credentials of a kind below which no automaton is fitted.
LEAST_STRINGS = 5
#: Confidence of the test that keeps two states apart.
ALPHA = 0.05
#: Log-likelihood ratio to ordinary runs from which a run is a secret.
LEAST_RATIO = math.log(1000)
#: Share of the labelled credentials that may be less typical of their format than a new one.
LEAST_TYPICAL = 0.02

CLASSES = {
    **dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "h"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"),
    **dict.fromkeys("ABCDEF", "H"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "L"),
    **{c: c for c in "+/_=.-"},
}
TRANSLATION = str.maketrans(CLASSES)
SYMBOLS = len(set(CLASSES.values()))


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) of the fixed patterns, per kind leftmost first."""
    found = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return found


def free_runs(text: str, spans: list[tuple]) -> Iterator[re.Match]:
    """The candidates that meet none of ``spans``, in order; each span is looked at once."""
    held = sorted((start, end) for start, end, *_ in spans)
    at, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(held) and held[at][0] < m.end():
            reach = max(reach, held[at][1])
            at += 1
        if reach <= m.start():
            yield m


@dataclass
class Automaton:
    """States with counts of the strings that pass, end and go on by each symbol."""

    passed: list[int] = field(default_factory=lambda: [0])
    ended: list[int] = field(default_factory=lambda: [0])
    after: list[dict[str, int]] = field(default_factory=lambda: [{}])
    taken: list[dict[str, int]] = field(default_factory=lambda: [{}])
    start: int = 0

    def add(self, string: str) -> None:
        """Count a string along the prefix tree."""
        state = self.start
        self.passed[state] += 1
        for symbol in string:
            if symbol not in self.after[state]:
                self.after[state][symbol] = len(self.passed)
                for part, empty in ((self.passed, 0), (self.ended, 0), (self.after, {}), (self.taken, {})):
                    part.append(empty)
            self.taken[state][symbol] = self.taken[state].get(symbol, 0) + 1
            state = self.after[state][symbol]
            self.passed[state] += 1
        self.ended[state] += 1

    def likelihood(self, string: str) -> float:
        """Natural logarithm of the probability of a string of symbols, smoothed."""
        state, total = self.start, 0.0
        for symbol in string:
            if state is None:
                total -= math.log(SYMBOLS + 1)
                continue
            count, passed = self.taken[state].get(symbol, 0), self.passed[state]
            total += math.log((count + 0.1) / (passed + 0.1 * (SYMBOLS + 1)))
            state = self.after[state].get(symbol)
        if state is not None:
            total += math.log((self.ended[state] + 0.1) / (self.passed[state] + 0.1 * (SYMBOLS + 1)))
        return total


def alike(tree: Automaton, one: int, other: int, alpha: float) -> bool:
    """Whether no frequency of two states, or of states reached from both, differs significantly."""
    bound, todo = math.sqrt(0.5 * math.log(2 / alpha)), [(one, other)]
    seen = set()
    while todo:
        pair = todo.pop()
        if pair in seen or pair[0] == pair[1]:
            continue
        seen.add(pair)
        a, b = pair
        na, nb = tree.passed[a], tree.passed[b]
        if not na or not nb:
            continue
        most = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
        if abs(tree.ended[a] / na - tree.ended[b] / nb) > most:
            return False
        for symbol in tree.taken[a].keys() | tree.taken[b].keys():
            if abs(tree.taken[a].get(symbol, 0) / na - tree.taken[b].get(symbol, 0) / nb) > most:
                return False
            if symbol in tree.after[a] and symbol in tree.after[b]:
                todo.append((tree.after[a][symbol], tree.after[b][symbol]))
    return True


def fold(tree: Automaton, into: int, state: int) -> None:
    """Add the counts of a subtree of the prefix tree to ``into`` and what follows it."""
    todo = [(into, state)]
    while todo:
        a, b = todo.pop()
        tree.passed[a] += tree.passed[b]
        tree.ended[a] += tree.ended[b]
        for symbol, count in tree.taken[b].items():
            tree.taken[a][symbol] = tree.taken[a].get(symbol, 0) + count
            if symbol in tree.after[a]:
                todo.append((tree.after[a][symbol], tree.after[b][symbol]))
            else:
                tree.after[a][symbol] = tree.after[b][symbol]


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """Probabilistic automaton of symbol strings by merging compatible states.

    States of the result are kept in the order found; each state that follows them is merged
    into the first of them that is alike, or kept as a new one.
    """
    tree = Automaton()
    for string in sorted(strings):
        tree.add(string)
    kept = [tree.start]
    at = 0
    while at < len(kept):
        source = kept[at]
        for symbol in sorted(tree.after[source]):
            target = tree.after[source][symbol]
            if target in kept:
                continue
            same = next((k for k in kept if alike(tree, k, target, alpha)), None)
            if same is None:
                kept.append(target)
            else:
                tree.after[source][symbol] = same
                fold(tree, same, target)
        # A fold may have given a state handled before new followers.
        open_states = [i for i, k in enumerate(kept) if any(t not in kept for t in tree.after[k].values())]
        at = min(open_states, default=len(kept))
    return tree


@dataclass
class FormatModel:
    """Automata of credentials by kind, each with the least log-likelihood a symbol that is
    typical of it, an automaton of ordinary runs, and the least log ratio."""

    formats: dict[str, tuple[Automaton, float]]
    ordinary: Automaton
    least_ratio: float
    known: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def score(self, run: str) -> float:
        """Best log-likelihood ratio over the formats that the run is typical of, letters
        within a class being alike; minus infinity if it is typical of none."""
        string = run.translate(TRANSLATION)
        found = [a.likelihood(string) for a, typical in self.formats.values() if a.likelihood(string) >= typical * (len(string) + 1)]
        return max(found) - self.ordinary.likelihood(string) if found else -math.inf


    def scored(self, run: str) -> float:
        """``score``, remembered for runs of ordinary length."""
        known = self.known.get(run)
        if known is None:
            known = self.score(run)
            if len(run) < 100:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[run] = known
        return known


def model_of(strings: dict[str, list[str]], alpha: float = ALPHA, least_ratio: float = LEAST_RATIO) -> FormatModel:
    """Automata of the labelled strings by kind; kind ``ordinary`` is what they are held against."""
    coded = {kind: sorted(s.translate(TRANSLATION) for s in own) for kind, own in strings.items()}
    formats = {}
    for kind, own in coded.items():
        if kind != "ordinary" and len(own) >= LEAST_STRINGS:
            automaton = infer(own, alpha)
            rates = sorted(automaton.likelihood(s) / (len(s) + 1) for s in own)
            formats[kind] = automaton, rates[int(LEAST_TYPICAL * len(rates))]
    return FormatModel(formats, infer(coded.get("ordinary", []), alpha), least_ratio)


def fit_formats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS,
    sample_strings: int = SAMPLE_STRINGS, alpha: float = ALPHA, least_ratio: float = LEAST_RATIO,
) -> FormatModel:
    """Fit on the documents of a bounded sample picked by a hash of id and text, so that rows of one
    id, or without one, are in it or not each on its own.

    Only different credentials and ordinary runs come to the driver, at most
    ``sample_strings`` of a kind, so repeated rows count once. A kind with too few credentials,
    as all have in an empty table, gets no automaton. Null texts are left out.
    """
    n = docs.count()
    part = F.pmod(F.xxhash64(F.lit("formats"), quoted(doc_id), quoted(text)), F.lit(1 << 30))
    share = min(1.0, sample_docs / max(n, 1))
    texts = docs if share == 1 else docs.filter(part < F.lit(int((1 << 30) * share)))
    texts = texts.select(quoted(text).alias("text"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = set()
            for t in filter(None, batch.column(0).to_pylist()):
                spans = base_spans(t)
                found.update((kind, t[value:end]) for _, end, kind, value in spans if end - value <= 200)
                found.update(("ordinary", m.group()) for m in free_runs(t, spans) if m.end() - m.start() <= 200)
            pairs = sorted(found)
            yield pa.record_batch([pa.array([k for k, _ in pairs], pa.string()), pa.array([s for _, s in pairs], pa.string())], ["kind", "string"])

    # Written once: the kinds are then read from a small table, not from the texts.
    rows = stored(texts.mapInArrow(strings, "kind string, string string").distinct(), "formats")
    order = F.xxhash64("string")
    got: dict[str, list[str]] = {}
    for kind in (*KINDS[:3], "ordinary"):
        few = rows.filter(F.col("kind") == kind).orderBy(order, "string").limit(sample_strings)
        got[kind] = [r.string for r in few.select("string").collect()]
    return model_of(got, alpha, least_ratio)


def all_spans(model: FormatModel, text: str | None) -> list[tuple[int, int, str, float | None]]:
    """Spans of the patterns, and of runs beside them whose format is that of a credential."""
    if not text:
        return []
    spans = [(start, end, kind, None) for start, end, kind, _ in base_spans(text)]
    # Most texts have no run that is a secret, and the same runs again and again.
    if model.formats and any(model.scored(run) >= model.least_ratio for run in set(CANDIDATE.findall(text))):
        runs = ((m, model.scored(m.group())) for m in free_runs(text, spans))
        spans += [(m.start(), m.end(), "format", score) for m, score in runs if score >= model.least_ratio]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def scan_secrets(docs: DataFrame, model: FormatModel, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with the secrets of every whole text: an array of (kind, start, end, score).

    Places count code points, the end is exclusive; the score is null for the fixed
    patterns. Spans come by start, then kind. A null or empty text has none. A
    column of that name in ``docs`` is replaced. Rows stay in their partitions.
    """
    rows, at = packed(docs), docs.columns.index(text)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, at):
            found = [
                [{"kind": k, "start": s, "end": e, "score": x} for s, e, k, x in all_spans(model, t)]
                for t in batch.column(0).field(at).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(span))], ["row_", "spans"])

    kind = T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
    ]))
    done = rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("spans", kind)]))
    return unpacked(done, docs.columns, **{name: F.col("spans")})
