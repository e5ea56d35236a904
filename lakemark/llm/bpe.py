"""BPE encoding and decoding by dynamic programming over prefixes.

The encoding of a word ends, for each of its prefixes, in one token only. A token that
ends a prefix is that token exactly if BPE keeps it and the last token before it apart:
the pair is compatible. So an automaton with suffix links lists the tokens that end
at each place, the first compatible one is stored, and the stored tokens are followed back
from the end of the word.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lakemark.llm.common import packed, text_slices, unpacked, worker_state

# The last byte of a word is a symbol of its own; it is written as a code point from here on.
END = 0x10000
# Stretches, and words and pairs, that a worker remembers; beyond that it starts anew.
REMEMBERED = 250_000
REMEMBERED_WORDS = 100_000
SPLIT_BY_PYTHON_ONLY = re.compile("[\x1c-\x1f]")
# Stretches of these characters need no Unicode tables: composed, and lower case one by one.
PLAIN = re.compile("[!-~À-ÖØ-Þß-öø-ÿ]*")
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
NEVER = 1 << 60
# Letters of a byte-level vocabulary: printable Latin-1 stands for itself, the other
# bytes follow from code point 256 on.
OWN_BYTES = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in OWN_BYTES)}


@dataclass
class WordBPE:
    """A vocabulary whose merges stay inside words, with an end-of-word suffix."""

    tokenizer: Tokenizer
    tokens: dict[int, str]
    specials: dict[str, int]
    automaton: ahocorasick.Automaton
    born: list[int]
    parts: list[tuple[int, int]]
    merged: dict[int, int]
    parted: re.Pattern | None
    pairs: dict[int, bool] = field(default_factory=dict)
    words: dict[str, list[int]] = field(default_factory=dict)
    chunks: dict[str, bytes] = field(default_factory=dict)


def load_bpe(path: str) -> WordBPE:
    """Read a tokenizer file: BPE, byte-level, with an end-of-word suffix, without prefixes."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model = told["model"]
    suffix, vocab = model["end_of_word_suffix"], model["vocab"]
    if model["type"] != "BPE" or not suffix or model["continuing_subword_prefix"] or model["dropout"]:
        raise ValueError(f"{path}: not a BPE vocabulary with an end-of-word suffix only")
    size = max(vocab.values()) + 1
    born, parts = [-1] * size, [(-1, -1)] * size
    merged: dict[int, int] = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        a, b, whole = vocab[left], vocab[right], vocab[left + right]
        merged[a << 32 | b] = rank
        born[whole], parts[whole] = rank, (a, b)
    automaton = ahocorasick.Automaton()
    for token, i in vocab.items():
        if born[i] < 0 and len(token.removesuffix(suffix)) > 1:
            continue  # no merge makes it
        ended = token.endswith(suffix) and token != suffix
        letters = token.removesuffix(suffix) if ended else token
        letters = letters[:-1] + chr(END + ord(letters[-1])) if ended else letters
        automaton.add_word(letters, (i, len(letters)))
    automaton.make_automaton()
    added = {t["content"]: t["id"] for t in told["added_tokens"]}
    parted = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
    tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in added.items()}
    return WordBPE(
        Tokenizer.from_file(path), tokens, added, automaton, born, parts, merged, parted
    )


def compatible(bpe: WordBPE, left: int, right: int) -> bool:
    """Whether BPE, given the letters of both tokens in a row, ends with just these two.

    Time is run backwards. At the border lie the last piece of ``left`` and the first piece
    of ``right`` as they were before the latest merge undone so far; had a merge of these
    two pieces come before the merge that ended one of them, BPE would have made it. Of
    equal merges the one further left comes first.
    """
    left_ends = right_ends = NEVER
    while True:
        rank = bpe.merged.get(left << 32 | right)
        if rank is not None and rank < left_ends and rank <= right_ends:
            return False
        if bpe.born[left] < 0 and bpe.born[right] < 0:
            return True
        # Undo the later of the merges that made the two pieces; of equal ones the right one.
        if bpe.born[left] > bpe.born[right]:
            left_ends, left = bpe.born[left], bpe.parts[left][1]
        else:
            right_ends, right = bpe.born[right], bpe.parts[right][0]


def encode_word(bpe: WordBPE, word: str) -> list[int]:
    """Ids of one word, given in byte-level letters."""
    letters = word[:-1] + chr(END + ord(word[-1]))
    last: list[tuple[int, int] | None] = [None] * (len(letters) + 1)
    pairs, done = bpe.pairs, -1
    for end, (token, length) in bpe.automaton.iter(letters):
        if end == done:
            continue
        start = end + 1 - length
        if start:
            before = last[start]
            if before is None:
                continue
            pair = before[0] << 32 | token
            fits = pairs.get(pair)
            if fits is None:
                if len(pairs) >= REMEMBERED:
                    pairs.clear()
                fits = pairs[pair] = compatible(bpe, before[0], token)
            if not fits:
                continue
        last[end + 1], done = (token, start), end
    ids, at = [], len(letters)
    while at:
        found = last[at]
        if found is None:
            raise ValueError(f"no encoding of {word!r}")
        token, at = found
        ids.append(token)
    return ids[::-1]


def encode_chunk(bpe: WordBPE, chunk: str) -> bytes:
    """Ids of a stretch of text without blanks or line ends, as 32-bit integers."""
    ids: list[int] = []
    pieces = bpe.parted.split(chunk) if bpe.parted and bpe.parted.search(chunk) else (chunk,)
    for piece in pieces:
        if piece in bpe.specials:
            ids.append(bpe.specials[piece])
            continue
        if PLAIN.fullmatch(piece):
            words = PLAIN_WORDS.findall(piece.lower())
            if not piece.isascii():
                words = [w.encode().decode("latin-1").translate(BYTE_LETTERS) for w in words]
        else:
            normal = bpe.tokenizer.normalizer.normalize_str(piece)
            words = [w for w, _ in bpe.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        for word in words:
            known = bpe.words.get(word)
            if known is None:
                if len(bpe.words) >= REMEMBERED_WORDS:
                    bpe.words.clear()
                known = encode_word(bpe, word)
                if len(word) < 100:
                    bpe.words[word] = known
            ids += known
    return array("i", ids).tobytes()


def encode_text(bpe: WordBPE, text: str | None) -> bytes:
    """Ids of a whole text as 32-bit integers; none for null.

    Blanks and line ends part the text: no token and no normal form reaches over them.
    """
    if not text:
        return b""
    if SPLIT_BY_PYTHON_ONLY.search(text):
        chunks = text.replace("\n", " ").split(" ")
    else:
        chunks = text.split()
    found = list(map(bpe.chunks.get, chunks))
    if None in found:
        for i, known in enumerate(found):
            if known is None:
                chunk = chunks[i]
                known = bpe.chunks.get(chunk)
                if known is None:
                    if len(bpe.chunks) >= REMEMBERED:
                        bpe.chunks.clear()
                    known = encode_chunk(bpe, chunk)
                    if len(chunk) < 100:
                        bpe.chunks[chunk] = known
                found[i] = known
    return b"".join(found)


def decode_ids(tokens: dict[int, str], ids: list[int]) -> str:
    """The tokens joined by one blank, special ones included; unknown ids are left out."""
    return " ".join([tokens[i] for i in ids if i in tokens])


def encode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = "decoded"
) -> DataFrame:
    """``docs`` with the ids of every whole text and, unless ``decoded`` is None, the text
    decoded from these ids.

    Both as the tokenizers library gives them for the file at ``path``, without added
    special tokens; ``path`` must be readable on every executor. A null or empty text has no
    ids and decodes to an empty text. Columns of these names in ``docs`` are replaced.
    Rows stay in their partitions; every text is taken on its own.
    """
    rows, at = packed(docs), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_state(f"bpe {path}", lambda: load_bpe(path))
        size = max(bpe.tokens) + 1
        names = [bpe.tokens.get(i, "") for i in range(size)]
        for batch in text_slices(batches, at):
            blobs = [encode_text(bpe, t) for t in batch.column(0).field(at).to_pylist()]
            ends = np.cumsum([0, *[len(b) // 4 for b in blobs]])
            values = np.frombuffer(b"".join(blobs), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            out = [batch.column(0), lists]
            if decoded is not None:
                said = list(map(names.__getitem__, values.tolist()))
                out.append(pa.array([" ".join(said[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string()))
            yield pa.record_batch(out, ["row_", "ids", "decoded"][: len(out)])

    made = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    done = rows.mapInArrow(run, T.StructType([*rows.schema, *made[: 1 + (decoded is not None)]]))
    new = {ids: F.col("ids")} | ({decoded: F.col("decoded")} if decoded is not None else {})
    return unpacked(done, docs.columns, **new)


def decode(rows: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids; null ids and nulls among them decode to nothing."""
    packed_rows, at = packed(rows), rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_state(f"bpe {path}", lambda: load_bpe(path))
        for batch in batches:
            texts = [decode_ids(bpe.tokens, x or []) for x in batch.column(0).field(at).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["row_", "decoded"])

    schema = T.StructType([*packed_rows.schema, T.StructField("decoded", T.StringType())])
    return unpacked(packed_rows.mapInArrow(run, schema), rows.columns, **{decoded: F.col("decoded")})
