"""Quality rules, with repetition measured by a suffix array over each text's words.

Every longer repeat starts with a window of ``MIN_REPEAT`` words that occurs twice, so the
suffix array is built for the documents that have one. Suffixes are ordered by their
first words and then refined by doubling: the rank of a suffix by 2n words is that of the pair of ranks at its
start and n words on. Each round keeps only suffixes whose rank is still shared. The
common prefix of neighbours in the finished order follows from the ranks of all
rounds, longest first. A suffix's largest common prefix with a neighbour is the
interval of the array it lies deepest in, a maximal repeated substring; the union of
these spans is the covered part.

All documents of a slice are handled by the same vector passes; the work of a text
is near linear in its words. Nothing is shuffled.

Defined cases: a null or empty text has no words and fails; repeated rows are judged
alike; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped
from bidlens.llm.words import SPACED, Hasher, Slice, Words, find_words, grams, slices

MIN_WORDS = 20
MIN_REPEAT = 8
MAX_REPEAT_PERCENT = 30
MAX_COVERED = 0.3  # share of the words in maximal repeats; the same limit as MAX_REPEAT_PERCENT
MAX_LONGEST = 100  # words of the longest repeat
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, longest_repeat long, covered_share double")


def _shared(keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group number of each in that order, whether its group has several) for equal keys."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    for k in keys:
        if len(order) > 1:
            new[1:] &= k[order[1:]] == k[order[:-1]]
    new[1:] = ~new[1:]
    group = np.cumsum(new) - 1
    return order, group, np.bincount(group, minlength=1)[group] > 1


def repeat_lengths(words: Words, size: int = MIN_REPEAT) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word numbers) of repeats of at least ``size`` words, and the longest repeat from each, in words."""
    at, values = grams(words, size)
    order, _, several = _shared((values, words.doc[at]))
    docs = np.unique(words.doc[at[order[several]]])
    n = len(words.hash)
    if not len(docs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # All suffixes of the documents with a repeat, by their first words; 0 stands behind the last word.
    counts = words.firsts[docs + 1] - words.firsts[docs]
    last = np.repeat(words.firsts[docs + 1], counts)
    place = np.arange(len(last)) + np.repeat(words.firsts[docs] - (np.cumsum(counts) - counts), counts)
    keys = [np.where(place + i < last, words.hash[np.minimum(place + i, n - 1)], 0) for i in range(size)]
    order, group, several = _shared((*keys[::-1], words.doc[place]))
    array = place[order]  # the suffix array; suffixes that share their first words lie together
    rank = len(array) + np.arange(n + 1)  # of a suffix: the place where its group starts
    rank[array] = np.searchsorted(group, group)
    levels, width, open_at = [rank], size, np.flatnonzero(several)
    while len(open_at):
        tied = array[open_at]
        order, group, several = _shared((rank[np.minimum(tied + width, n)], rank[tied]))
        array[open_at] = tied[order]
        rank = rank.copy()
        rank[tied[order]] = open_at[np.searchsorted(group, group)]
        levels.append(rank)
        open_at = open_at[several]
        width *= 2
    longest = _longest(array, levels, words, size)
    return array[longest >= size], longest[longest >= size]


def _longest(array: np.ndarray, levels: list[np.ndarray], words: Words, size: int) -> np.ndarray:
    """Longest common prefix (words) of each suffix with a neighbour in the array."""
    n = len(words.hash)
    a, b = array[:-1], array[1:]
    common = np.zeros(len(a), np.int64)
    width = size << (len(levels) - 1)
    for rank in reversed(levels):
        equal = rank[np.minimum(a + common, n)] == rank[np.minimum(b + common, n)]
        common[equal] += width
        width >>= 1
    live = np.flatnonzero(common >= size)
    for _ in range(size - 1):
        x, y = a[live] + common[live], b[live] + common[live]
        inside = np.maximum(x, y) < n
        live, x, y = live[inside], x[inside], y[inside]
        same = (words.hash[x] == words.hash[y]) & (words.doc[x] == words.doc[a[live]]) & (words.doc[y] == words.doc[b[live]])
        live = live[same]
        common[live] += 1
    longest = np.zeros(len(array), np.int64)
    longest[:-1] = common
    longest[1:] = np.maximum(longest[1:], common)
    return longest


def _per_document(mask: np.ndarray, borders: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[borders[1:]] - sums[borders[:-1]]


def duplicate_lines(piece: Slice, hasher: Hasher) -> np.ndarray:
    """Per document: lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(piece.data == 0x0A)
    start = np.unique(np.concatenate([piece.borders[:-1], breaks + 1]))
    start = start[start < len(piece.data)]
    end = np.append(start[1:], len(piece.data)) if len(start) else start
    end = end - (piece.data[end - 1] == 0x0A) if len(end) else end
    doc = np.searchsorted(piece.borders, start, "right") - 1
    end = np.minimum(end, piece.borders[doc + 1]) if len(end) else end
    sums = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum(SPACED[piece.data], out=sums[1:])
    full = sums[end] > sums[start]
    doc, value = doc[full], hasher.spans(start[full], end[full])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    again = np.flatnonzero((doc[1:] == doc[:-1]) & (value[1:] == value[:-1])) + 1
    return np.bincount(doc[again], minlength=piece.size)


def measures(piece: Slice) -> dict[str, np.ndarray]:
    """The measures of every document of a slice."""
    hasher = Hasher(piece.data, False)
    words = find_words(piece, SPACED, hasher=hasher)
    start, length = repeat_lengths(words)
    change = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    covered = _per_document(np.cumsum(change[:-1]) > 0, words.firsts)
    longest = np.zeros(piece.size, np.int64)
    np.maximum.at(longest, words.doc[start], length)
    n_words = np.diff(words.firsts)
    chars = SPACED[piece.data] & ((piece.data & 0xC0) != 0x80)
    failed = (n_words < MIN_WORDS) | (100 * covered > MAX_REPEAT_PERCENT * n_words)
    share = covered / np.maximum(n_words, 1)
    return {
        "n_words": n_words, "word_chars": _per_document(chars, piece.borders),
        "n_symbols": _per_document(_SYMBOL[piece.data], piece.borders), "n_dup_lines": duplicate_lines(piece, hasher),
        "n_repeat_words": covered, "base_failed": failed,
        "kept": ~failed & (share <= MAX_COVERED) & (longest <= MAX_LONGEST), "longest_repeat": longest,
        "covered_share": share,
    }


def assess(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): the measures, whether the base rules fail, and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(1)):
                found = {k: pa.array(v.astype(np.int64) if v.dtype.kind == "i" else v) for k, v in measures(piece).items()}
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(piece.first, piece.size), **found})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return shipped(rows).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text passes; all columns are kept."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [measures(piece)["kept"] for piece in slices(batch.column(place))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return shipped(docs).mapInArrow(run, docs.schema)
