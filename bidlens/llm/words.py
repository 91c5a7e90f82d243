"""Words of whole texts as numpy arrays, read straight from Arrow string buffers.

A slice of documents is one run of bytes. Word borders come from a 256-entry
byte table, word hashes from one running sum of the bytes' random 64-bit values
times powers of an odd base, so the work is a few vector passes and no Python
per word. Equal words have equal hashes; unequal ones differ but for 64-bit chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # text handled at once; a longer document is a slice of its own
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPACED = ~_SPACE  # word bytes where ASCII white space alone parts words
ALNUM = np.zeros(256, bool)  # word bytes where only digits, letters and non-ASCII make words
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
_LOWER = _BYTES.copy()
_LOWER[0x41:0x5B] = _BYTES[0x61:0x7B]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse mod 2**64, kept for the next slice."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Slice:
    """Consecutive documents: rows ``first``.. of the batch, their bytes and byte borders."""

    first: int
    data: np.ndarray
    borders: np.ndarray

    @property
    def size(self) -> int:
        return len(self.borders) - 1


@dataclass
class Words:
    """Words of a slice in order: byte span, document and hash; ``firsts`` are the documents' word borders."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    firsts: np.ndarray


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut an Arrow string array into runs of at most ``limit`` bytes (a null text is empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(borders, borders[at] + limit, "right")) - 1)
        yield Slice(at, data[borders[at]:borders[to]], borders[at:to + 1] - borders[at])
        at = to


class Hasher:
    """Hashes of byte spans of one slice."""

    def __init__(self, data: np.ndarray, lower: bool):
        power, self.inverse = _power_tables(len(data) + 1)
        values = (_LOWER if lower else _BYTES)[data]
        values *= power[:len(data)]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mixed(h + (end - start).astype(np.uint64))


def find_words(piece: Slice, kind: np.ndarray = SPACED, lower: bool = False, hasher: Hasher | None = None) -> Words:
    """All maximal runs of word bytes, none across documents."""
    inside = np.zeros(len(piece.data) + 2, np.int8)
    inside[1:-1] = kind[piece.data]
    edge = np.diff(inside)
    starts, ends = edge[:-1] == 1, edge[1:] == -1
    inner = piece.borders[1:-1]
    inner = inner[(inner > 0) & (inner < len(piece.data))]
    cut = inner[(inside[inner + 1] == 1) & (inside[inner] == 1)]  # a word byte on both sides of a border
    starts[cut] = True
    ends[cut - 1] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    firsts = np.searchsorted(start, piece.borders)
    doc = np.repeat(np.arange(piece.size), np.diff(firsts))
    hasher = hasher or Hasher(piece.data, lower)
    return Words(start, end, doc, hasher.spans(start, end), firsts)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (word number in the slice) and hash of every window of ``k`` words within a document."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 1
    for i in range(k):
        factor = factor * 0xD6E8FEB86659FD93 % 2**64
        total += words.hash[i:i + n] * np.uint64(factor)
    at = np.flatnonzero(words.doc[:n] == words.doc[k - 1:])
    return at, mixed(total[at])


def shingle_sets(piece: Slice, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each document, sorted by (document, hash); returns (document, hash).

    A document of 1 to k-1 words has its whole word sequence as its one shingle.
    """
    words = find_words(piece, SPACED, lower)
    at, values = grams(words, k)
    docs = words.doc[at]
    counts = np.diff(words.firsts)
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            total = np.full(len(short), n, np.uint64)
            for i in range(n):
                total = mixed(total * np.uint64(_BASE) + words.hash[words.firsts[short] + i])
            docs, values = np.concatenate([docs, short]), np.concatenate([values, total])
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    keep = np.ones(len(docs), bool)
    keep[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    return docs[keep], values[keep]
