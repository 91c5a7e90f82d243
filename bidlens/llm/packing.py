"""Packing documents into fixed windows by order-preserving dynamic programming.

The tokens of a partition's documents form one stream in row order. Windows are
cut out of it one after another, so order is kept and every token lies in exactly
one window. Cuts may fall behind a document (free), behind a sentence, or, where
neither is near, inside one; the two latter cost a penalty. With ``c`` the cut
positions, ``w`` the window and ``p`` the penalties,

    f[j] = p[j] + min over c[j] - c[i] <= w of  f[i] + padding(c[j] - c[i])

where padding is w minus the length, so the minimum of ``f[i] + c[i]`` over a sliding
window decides: a monotone queue yields it in amortised constant time. Windows
whose length is a power of two need no padding and enter as extra transitions.

The stream is solved in bounded stretches: all windows but the last few of a
stretch are final, the rest is solved again together with what follows. Nothing is
shuffled. Partitions are independent; near the end of one every position is a
possible cut, so its last tokens can fall into power-of-two windows.

Defined cases: a null or empty text is the end id alone; equal rows are documents
of their own; null ids stay null; extra columns are not read; no rows give no rows.
Memory is bounded by a stretch and the largest single document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped
from bidlens.llm.tokens import encoder
from bidlens.llm.words import slices

WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY = 1
INSIDE_PENALTY = 8
PER_WINDOW = 1  # keeps free power-of-two windows from replacing full ones without need
FORCED = 64  # longest stretch without a cut position
STRETCH = 1 << 19  # at least; 64 windows if these are more
TEXT_BYTES = 1 << 20  # text encoded at once; more finds more repeated pieces and takes about 30 bytes of memory a byte
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")


def sentence_ends(tokenizer) -> np.ndarray:
    """By id: whether the token closes a sentence."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    found = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        if token.removesuffix("</w>")[-1:] in (".", "!", "?"):
            found[i] = True
    return found


def cut_positions(ids: np.ndarray, doc_ends: np.ndarray, closing: np.ndarray, last: bool,
                  window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a stream, from 0 to its end, and the penalty of each."""
    n = len(ids)
    penalty = np.full(n + 1, -1, np.int64)
    penalty[1:][closing[ids]] = SENTENCE_PENALTY
    if last:
        tail = penalty[max(0, n - 2 * window):]
        tail[tail < 0] = INSIDE_PENALTY
    penalty[doc_ends] = 0
    penalty[[0, n]] = 0
    cuts = np.flatnonzero(penalty >= 0)
    gap = np.diff(cuts)
    step = min(FORCED, window)
    wide = np.flatnonzero(gap > step)
    if len(wide):
        count = (gap[wide] - 1) // step
        ranks = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        penalty[np.repeat(cuts[wide], count) + (ranks + 1) * step] = INSIDE_PENALTY
        cuts = np.flatnonzero(penalty >= 0)
    return cuts, penalty[cuts]


def best_windows(cuts: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Cuts (positions) of the cheapest split of the stream into windows, the first 0 and the last its end."""
    free: list[list[int] | None] = [None] * len(cuts)
    size = 1
    while size < window:
        at = np.searchsorted(cuts, cuts - size)
        hit = np.flatnonzero((cuts[at] == cuts - size) & (cuts >= size))
        for j, i in zip(hit.tolist(), at[hit].tolist()):
            if free[j] is None:
                free[j] = [i]
            else:
                free[j].append(i)
        size *= 2
    c, p = cuts.tolist(), (penalty + PER_WINDOW).tolist()
    cost, back = [0] * len(c), [0] * len(c)
    queue, value, head = [0] * len(c), [0] * len(c), 0  # candidate starts by rising value of f + c
    tail = 0
    for j in range(1, len(c)):
        end = c[j]
        v = cost[j - 1] + c[j - 1]
        while tail > head and value[tail - 1] >= v:
            tail -= 1
        queue[tail], value[tail] = j - 1, v
        tail += 1
        while c[queue[head]] < end - window:
            head += 1
        best, start = value[head] + window - end, queue[head]
        if free[j] is not None:
            for i in free[j]:
                if cost[i] < best:
                    best, start = cost[i], i
        cost[j], back[j] = best + p[j], start
    at, path = len(c) - 1, [len(c) - 1]
    while at:
        at = back[at]
        path.append(at)
    return cuts[path[::-1]]


class Packer:
    """Packs a stream of documents; ``add`` and ``finish`` yield record batches of pieces."""

    def __init__(self, partition: int, closing: np.ndarray, window: int, with_ids: bool):
        self.sequence = partition << 32
        self.closing, self.window, self.with_ids = closing, window, with_ids
        self.ids = np.zeros(0, np.uint32)
        self.names = pa.array([], pa.int64())
        self.starts = np.zeros(0, np.int64)  # of the documents in the stream; the first may be negative
        self.sizes = np.zeros(0, np.int64)

    def add(self, names: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.names = pa.concat_arrays([self.names, names])
        self.ids = np.concatenate([self.ids, ids])
        # Sixteen windows stay open, so a stretch holds several times as many.
        if len(self.ids) >= max(STRETCH, 64 * self.window):
            yield self._commit(False)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if len(self.ids):
            yield self._commit(True)

    def _commit(self, last: bool) -> pa.RecordBatch:
        cuts, penalty = cut_positions(self.ids, self.starts + self.sizes, self.closing, last, self.window)
        path = best_windows(cuts, penalty, self.window)
        if not last:
            path = path[:np.searchsorted(path, len(self.ids) - 16 * self.window, "right")]
        end = int(path[-1])
        points = np.unique(np.concatenate([path, self.starts[(self.starts > 0) & (self.starts < end)]]))
        start, size = points[:-1], np.diff(points)
        doc = np.searchsorted(self.starts, start, "right") - 1
        seq = np.searchsorted(path, start, "right") - 1
        raw = memoryview(self.ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * s:4 * (s + n)]) for s, n in zip(start.tolist(), size.tolist())]
        columns = {
            "doc_id": self.names.take(pa.array(doc)), "start": start - self.starts[doc], "length": size,
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": self.sizes[doc], "sequence_id": self.sequence + seq,
            "offset": start - path[seq], "sequence_tokens": np.diff(path)[seq],
        }
        if self.with_ids:
            borders = pa.array(np.append(start, end).astype(np.int32))
            columns["ids"] = pa.ListArray.from_arrays(borders, pa.array(self.ids.astype(np.int32)))
        self.sequence += len(path) - 1
        left = int(np.searchsorted(self.starts + self.sizes, end, "right"))
        self.ids, self.starts, self.sizes = self.ids[end:], self.starts[left:] - end, self.sizes[left:]
        self.names = self.names.slice(left)
        return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v, pa.int64())
                                           for k, v in columns.items()})


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in windows of at most ``window`` tokens, a power of two of at least 2.

    One row per piece: its place in its document and in its sequence, the CRC-32 of
    its ids and, with ``with_ids``, the ids. A sequence is padded to ``window``
    unless its length ``sequence_tokens`` is a power of two.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId(), sentence_ends(coder.tokenizer), window, with_ids)
        for batch in batches:
            for piece in slices(batch.column(1), TEXT_BYTES):
                ids, borders = coder.encode(piece)
                sizes = np.diff(borders) + 1
                whole = np.full(int(sizes.sum()), END_ID, np.uint32)
                inner = np.ones(len(whole), bool)
                inner[np.cumsum(sizes) - 1] = False
                whole[inner] = ids
                yield from packer.add(batch.column(0).slice(piece.first, piece.size), whole, sizes)
                pa.default_memory_pool().release_unused()  # else a worker keeps what its largest slice took
        yield from packer.finish()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return shipped(rows).mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
