"""SentencePiece encoding by streaming Viterbi, and decoding.

A text's ids are the split into pieces with the highest sum of scores. The search
runs over the characters once and keeps scores only as far back as the longest piece
reaches. Whenever the best paths to all ends that a later piece may still start from
run through one common boundary, the ids up to it are final and leave the window, so
a text of any length needs little memory. Many such boundaries are known beforehand:
between two characters that stand side by side in no piece, all paths have to meet.
The parts between them are searched once per distinct part of a batch.

Spaces become the mark U+2581, with one put before the text; characters without a
piece become the ids of their UTF-8 bytes. Among equal sums the longer last piece
wins. Decoding joins the pieces, turns byte ids back into characters and drops the
leading space; it restores every text but for U+2581 itself, which is read as a space.

Defined cases: a null or empty text has no ids and decodes to empty; repeated rows are
coded alike; extra columns stay untouched unless named like the result; no rows give
no rows. Ids outside the vocabulary decode like the unknown id, byte ids that are not
UTF-8 to U+FFFD.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from bidlens.llm.ship import shipped
from bidlens.llm.tokens import gathered, tokenizer_path
from bidlens.llm.words import Slice, slices

DEFAULT = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10
MEMO_PARTS = 200_000  # parts remembered between batches; beyond it the memory starts anew, results are the same


class PieceModel:
    """Pieces, whole-number scores and byte ids of a model file."""

    def __init__(self, path: str | None = None):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path or tokenizer_path(DEFAULT))
        self.unknown = model.unk_id()
        self.scores: dict[str, tuple[int, int]] = {}
        self.bytes = [-1] * 256
        surface = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                surface.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_unknown(i):
                surface.append(" ⁇ ".encode())
            elif model.is_control(i) or model.is_unused(i):
                surface.append(b"")
            else:
                self.scores[piece] = (round(model.get_score(i)), i)
                surface.append(piece.replace(MARK, " ").encode())
        self.surface = pa.array(surface, pa.large_binary())
        self.longest = max(map(len, self.scores))
        usual = [s for s, _ in self.scores.values() if s > -1_000_000]
        self.unknown_score = min(usual) - UNKNOWN_PENALTY
        # Pieces by their characters; a node's score, where a piece ends, is under the empty string.
        self.tree: dict = {}
        for piece, (score, _) in self.scores.items():
            node = self.tree
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = score
        # By the bytes on both sides of a place: whether a piece can cross it.
        self.crossed = np.zeros((256, 256), bool)
        for piece in self.scores:
            raw = np.frombuffer(piece.replace(MARK, " ").encode(), np.uint8)
            self.crossed[raw[:-1], raw[1:]] = True

    def fallback(self, char: str) -> list[int]:
        ids = [self.bytes[b] for b in char.encode()]
        return ids if min(ids) >= 0 else [self.unknown]


UNREACHED = -(1 << 62)


class StreamingViterbi:
    """Best split of a stream of characters; ``feed`` and ``finish`` return the ids that have become final."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.widest = 0  # most characters held at once
        self._reset()

    def _reset(self) -> None:
        self.text = ""  # characters not final yet
        self.best = [0]  # score of the best path to each boundary of ``text``
        self.back = [0]
        self.done = 0  # the boundaries before it have been gone on from

    def feed(self, chars: str) -> list[int]:
        final: list[int] = []
        span = 4 * self.model.longest
        for at in range(0, len(chars), span):
            self._extend(chars[at:at + span], False)
            self.widest = max(self.widest, len(self.text))
            boundary = self._common_boundary()
            if boundary:
                final += self._ids(boundary)
                self._drop(boundary)
        return final

    def finish(self) -> list[int]:
        self._extend("", True)
        final = self._ids(len(self.text))
        self._reset()
        return final

    def whole(self, text: str) -> list[int]:
        """Ids of a short text, while nothing else is held."""
        self._extend(text, True)
        final = self._ids(len(text))
        self._reset()
        return final

    def _extend(self, chars: str, last: bool) -> None:
        """Go on from every boundary whose pieces are all in sight (``last``: from every boundary)."""
        model, best, back = self.model, self.best, self.back
        scores, tree, longest, unknown = model.scores, model.tree, model.longest, model.unknown_score
        text = self.text = self.text + chars
        best += [UNREACHED] * len(chars)
        back += [0] * len(chars)
        until = len(text) if last else max(self.done, len(text) - longest + 1)
        for start in range(self.done, until):
            score, node, end = best[start], tree, start
            for char in text[start:start + longest]:
                node = node.get(char)
                if node is None:
                    break
                end += 1
                own = node.get("")
                if own is not None and score + own > best[end]:
                    best[end] = score + own
                    back[end] = start
            if text[start] not in scores and score + unknown > best[start + 1]:
                best[start + 1] = score + unknown
                back[start + 1] = start
        self.done = until

    def _common_boundary(self) -> int:
        """The last boundary that the best paths to all boundaries still in reach have in common."""
        back = self.back
        ends = {i for i in range(self.done, len(self.best)) if self.best[i] != UNREACHED}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(back[last])
        return ends.pop()

    def _ids(self, end: int) -> list[int]:
        model, borders = self.model, [end]
        while borders[-1]:
            borders.append(self.back[borders[-1]])
        borders.reverse()
        ids: list[int] = []
        for i, j in zip(borders, borders[1:]):
            found = model.scores.get(self.text[i:j])
            ids += [found[1]] if found is not None else model.fallback(self.text[i:j])
        return ids

    def _drop(self, boundary: int) -> None:
        base = self.best[boundary]
        self.text = self.text[boundary:]
        self.best = [s if s == UNREACHED else s - base for s in self.best[boundary:]]
        self.back = [max(0, b - boundary) for b in self.back[boundary:]]
        self.done -= boundary


class PieceCoder:
    """Ids of slices of texts, remembering the ids of distinct parts."""

    def __init__(self, path: str | None = None):
        self.model = PieceModel(path)
        self.stream = StreamingViterbi(self.model)
        self.reset()

    def reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.ids = np.zeros(0, np.int32)
        self.sizes: list[int] = []

    def _borders(self, piece: Slice) -> np.ndarray:
        """Byte borders of the parts of a slice: its documents' borders and all places no piece crosses."""
        data = piece.data
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = ~self.model.crossed[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        begins[piece.borders] = True
        return np.flatnonzero(begins)

    def _learn(self, parts: list[str]) -> None:
        stream, found = self.stream, []
        for part in parts:
            marked = part.replace(" ", MARK)
            found.append(stream.feed(marked) + stream.finish() if len(marked) > 64 else stream.whole(marked))
        self.memo.update(zip(parts, range(len(self.memo), len(self.memo) + len(parts))))
        self.sizes += map(len, found)
        self.ids = np.concatenate([self.ids, np.fromiter((i for ids in found for i in ids), np.int32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, borders): text i has ids[borders[i]:borders[i + 1]]."""
        texts = texts.cast(pa.large_string()).fill_null("")
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            texts = pc.replace_substring(texts, MARK, " ")
        texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        ids, counts = [np.zeros(0, np.int32)], []
        for piece in slices(texts):
            borders = self._borders(piece)
            parts = pa.Array.from_buffers(pa.large_string(), len(borders) - 1,
                                          [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(piece.data)])
            coded = parts.dictionary_encode()
            names = coded.dictionary.to_pylist()
            new = [p for p in names if p not in self.memo]
            if len(self.memo) + len(new) > MEMO_PARTS:
                self.reset()
                new = names
            self._learn(new)
            place = np.fromiter(map(self.memo.__getitem__, names), np.int64, len(names))
            which = place[coded.indices.to_numpy(zero_copy_only=False)]
            size = np.array(self.sizes, np.int64)
            got, ends = gathered(self.ids, (np.cumsum(size) - size)[which], size[which])
            at = ends[np.searchsorted(borders, piece.borders)]
            lone = np.flatnonzero(empty[piece.first:piece.first + piece.size])
            if len(lone):  # the space put before an empty text
                keep = np.ones(len(got), bool)
                keep[np.concatenate([np.arange(at[i], at[i + 1]) for i in lone])] = False
                at = np.concatenate([[0], np.cumsum(keep)])[at]
                got = got[keep]
            ids.append(got)
            counts.append(np.diff(at))
        return np.concatenate(ids), np.cumsum(np.concatenate([[0], *counts]).astype(np.int64))

    def decode(self, ids: np.ndarray, borders: np.ndarray) -> list[str]:
        """Texts of id lists."""
        known = len(self.model.surface)
        ids = np.where((ids >= 0) & (ids < known), ids, self.model.unknown)
        joined = self.model.surface.take(pa.array(ids))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(ids) + 1]
        raw = joined.buffers()[2]
        raw = memoryview(raw) if raw is not None else memoryview(b"")
        cuts = offsets[borders].tolist() if len(ids) else [0] * len(borders)
        return [str(raw[i:j], "utf-8", "replace").removeprefix(" ") for i, j in zip(cuts, cuts[1:])]


_coders: dict[str | None, PieceCoder] = {}


def coder(path: str | None = None) -> PieceCoder:
    """The coder of this worker process, loaded once."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def encode(docs: DataFrame, model: str | None = None, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the ids of the text and, as ``<ids>_crc32``, the CRC-32 of them as unsigned 32-bit numbers."""
    kept = [c for c in docs.columns if c not in (ids, f"{ids}_crc32")]
    place = kept.index(text)
    schema = docs.select(*kept).schema.add(ids, ArrayType(IntegerType())).add(f"{ids}_crc32", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(place)):
                part = batch.slice(piece.first, piece.size)
                flat, borders = coder(model).encode(part.column(place))
                raw = memoryview(flat.astype("<u4").tobytes())
                cuts = borders.tolist()
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(cuts, cuts[1:])]
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(crc, pa.int64())],
                                                 names=[*kept, ids, f"{ids}_crc32"])

    return shipped(docs.select(*kept)).mapInArrow(run, schema)


def decode(rows: DataFrame, model: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids (null ids: empty)."""
    kept = [c for c in rows.columns if c != text]
    place = kept.index(ids)
    schema = rows.select(*kept).schema.add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(place)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = coder(model).decode(flat, np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, text])

    return shipped(rows.select(*kept)).mapInArrow(run, schema)
