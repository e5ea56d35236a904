"""Compact bytes for sorted hashes and packed keys with their counts."""

from __future__ import annotations

import numpy as np


def small_numbers(values: np.ndarray, halves: bool = False) -> bytes:
    """Numbers from 0 that are mostly small, in a byte each or half of one; larger ones are in a list
    behind."""
    top = 15 if halves else 255
    large = np.flatnonzero(values >= top)
    cells = np.minimum(values, top).astype(np.uint8)
    if halves:
        cells = np.append(cells, np.zeros(len(cells) % 2, dtype=np.uint8))
        cells = cells[::2] << 4 | cells[1::2]
    listed = (np.array([len(large)]), large, values[large])
    return b"".join([cells.tobytes(), *(x.astype(np.int64).tobytes() for x in listed)])


def read_small(data: bytes, count: int, at: int = 0, halves: bool = False) -> tuple[np.ndarray, int]:
    """``count`` numbers of ``small_numbers`` at a place in ``data``, and the place behind them."""
    size = (count + 1) // 2 if halves else count
    cells = np.frombuffer(data, np.uint8, size, at)
    values = (np.stack([cells >> 4, cells & 15], axis=1).ravel()[:count] if halves else cells).astype(np.int64)
    large = int(np.frombuffer(data, np.int64, 1, at + size)[0])
    places, found = np.frombuffer(data, np.int64, 2 * large, at + size + 8).reshape(2, large)
    values[places] = found
    return values, at + size + 8 + 16 * large


def low_bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of unsigned 64-bit numbers, one number behind the other."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(len(values), 8), axis=1)[:, 64 - width :]
    return np.packbits(bits).tobytes()


def read_bits(data: bytes, count: int, width: int, at: int = 0) -> tuple[np.ndarray, int]:
    """``count`` numbers of ``low_bits`` at a place in ``data``, and the place behind them."""
    size = (count * width + 7) // 8
    cells = np.zeros((count, 64), dtype=np.uint8)
    cells[:, 64 - width :] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count * width).reshape(count, width)
    return np.packbits(cells, axis=1).view(">u8")[:, 0].astype(np.uint64), at + size


def as_filter(limbs: np.ndarray, counts: np.ndarray, widths: list[int], tight: bool = False) -> bytes:
    """A counting quotient filter of sorted permuted n-grams.

    The quotient is the first bits of the first limb, so many that a run has one or two n-grams.
    Stored are the run lengths of all quotients, the remainders, that is all other bits, and the
    counters; a length or counter of 255 or more goes to a list behind. Remainders take whole
    bytes, or in a ``tight`` filter as many bits as they have.
    """
    n = len(limbs)
    q = min(max(n.bit_length() - 1, 0), widths[0])
    rest = widths[0] - q
    quotient = (limbs[:, 0] >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(n, dtype=np.int64)

    def low_bytes(limb: np.ndarray, width: int) -> bytes:
        if tight:
            return low_bits(limb, width)
        size = -(-width // 8)
        return np.ascontiguousarray(limb.astype("<u8").view(np.uint8).reshape(n, 8)[:, :size].T).tobytes()

    remainder = limbs[:, 0] & np.uint64((1 << rest) - 1)
    parts = [low_bytes(remainder, rest), *(low_bytes(limbs[:, i], w) for i, w in enumerate(widths) if i)]
    return b"".join([np.array([n, q], dtype=np.int64).tobytes(), small_numbers(np.bincount(quotient, minlength=1 << q), halves=True), *parts, small_numbers(counts)])


def of_filter(data: bytes, widths: list[int], tight: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The sorted permuted n-grams and counts of a filter that was made with the same settings."""
    n, q = (int(x) for x in np.frombuffer(data, np.int64, 2))
    rest = widths[0] - q
    runs, at = read_small(data, 1 << q, 16, halves=True)
    limbs = np.zeros((n, len(widths)), dtype=np.uint64)
    for i, width in enumerate([rest, *widths[1:]]):
        if tight:
            limbs[:, i], at = read_bits(data, n, width, at)
            continue
        size = -(-width // 8)
        cells = np.zeros((n, 8), dtype=np.uint8)
        cells[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
        at += n * size
        limbs[:, i] = cells.view("<u8")[:, 0]
    if q:
        limbs[:, 0] |= np.repeat(np.arange(len(runs), dtype=np.uint64), runs) << np.uint64(rest)
    return limbs, read_small(data, n, at)[0]
