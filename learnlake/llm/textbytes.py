"""Words and character n-grams of whole Arrow batches, hashed with numpy over the UTF-8 bytes.

Texts are cut into pieces of at most ``PIECE`` bytes at white space, so that a text of any length needs bounded memory;
all functions return the piece's texts' numbers, and callers add up over the pieces of one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[ord("a"): ord("z") + 1] = True
_ASCII_LETTER[ord("A"): ord("Z") + 1] = True
LETTER = _ASCII_LETTER.copy()
LETTER[0x80:] = True  # every byte of a character outside ASCII counts as part of a word
WORD = LETTER.copy()
WORD[ord("0"): ord("9") + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


_POW = _powers(int(_BASE), PIECE + 64)
_INV = _powers(pow(int(_BASE), -1, 1 << 64), PIECE + 64)


class Piece(NamedTuple):
    data: np.ndarray  # bytes
    rows: np.ndarray  # number of the text in its batch
    starts: np.ndarray  # of each text's part in data
    ends: np.ndarray


def pieces(texts: pa.Array) -> Iterator[Piece]:
    """The batch's texts in order, as runs of bytes of at most ``PIECE`` (a NULL is an empty text)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    rows, cuts = [], []
    for i in range(n):
        a, end = int(offsets[i]), int(offsets[i + 1])
        while end - a > PIECE:
            back = np.flatnonzero(SPACE[data[a + PIECE // 2: a + PIECE]])
            b = a + PIECE // 2 + int(back[-1]) + 1 if len(back) else a + PIECE
            rows.append(i), cuts.append((a, b))
            a = b
        rows.append(i), cuts.append((a, end))
    rows, cuts = np.array(rows), np.array(cuts)
    first = 0
    while first < len(rows):
        last = int(np.searchsorted(cuts[:, 1], cuts[first, 0] + PIECE, "right"))
        last = max(last, first + 1)
        part = cuts[first:last] - cuts[first, 0]
        yield Piece(data[cuts[first, 0]: cuts[last - 1, 1]], rows[first:last], part[:, 0], part[:, 1])
        first = last


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the capitals of U+00C0 to U+00DE; other characters stay as they are."""
    out = _LOWER[data]
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    out[at] += 32
    return out


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut where a text starts."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inner = starts[(starts > 0) & (starts < len(inside))]
    inner = inner[inside[inner] & inside[inner - 1]]
    if len(inner):
        inner = np.unique(inner)
        s, e = np.sort(np.concatenate([s, inner])), np.sort(np.concatenate([e, inner]))
    return s, e


class Prefix:
    """Hashes of any byte ranges of one piece, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POW[: len(data)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * _INV[starts]
        h ^= h >> np.uint64(31)
        h *= _MIX
        return h ^ (h >> np.uint64(32))


def grams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashes below ``2**bits`` of the n-byte strings starting at each byte (the last ``n - 1`` places are absent)."""
    if len(data) < n:
        return np.zeros(0, np.uint32)
    h = np.full(len(data) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        h += data[k: len(data) - n + 1 + k]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)


def row_of(positions: np.ndarray, piece: Piece) -> np.ndarray:
    """The text (index into ``piece.rows``) in which each position lies."""
    return np.searchsorted(piece.starts, positions, "right") - 1
