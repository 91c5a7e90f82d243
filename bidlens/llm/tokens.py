"""Token ids of whole texts by a public tokenizer, encoding each distinct piece of a batch once.

The word vocabulary lower-cases, drops white space and cuts a text by a fixed pattern
before it merges, and no merge crosses a cut. So whole slices of bytes are lower-cased
and cut at once, Arrow finds their distinct pieces, and only pieces not met before go
to the tokenizer, many in one string; the end-of-word mark of their ids tells them
apart. Texts beyond ASCII and the Latin-1 letters, or with control strings of the
vocabulary, go to the tokenizer whole. The ids are always the tokenizer's own.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from bidlens.llm.words import Slice

DEFAULT = "word_bpe_49k.json"
MEMO_PIECES = 400_000  # pieces remembered between batches; beyond it the memory starts anew, results are the same
SPACE, LETTER, DIGIT, SIGN = range(4)
_KIND = np.full(256, SIGN, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = LETTER
_KIND[0x30:0x3A] = DIGIT
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 0x20
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")  # pieces of their own after an apostrophe that starts a piece


def tokenizer_path(name: str = DEFAULT) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def odd_documents(piece: Slice) -> np.ndarray:
    """Documents with bytes beyond ASCII and the Latin-1 letters, or with a control string's start."""
    data = piece.data
    before, after = np.roll(data, 1), np.roll(data, -1)
    latin = (before == 0xC3) & (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    odd = (data >= 0x80) & (data != 0xC3) & ~latin | (data == 0x3C) & (after == 0x7C)
    found = np.zeros(piece.size, bool)
    found[np.searchsorted(piece.borders, np.flatnonzero(odd), "right") - 1] = True
    return found


def spaced_pieces(piece: Slice) -> pa.Array:
    """The texts in lower case with a space at every cut of the vocabulary's pattern (for documents that are not odd)."""
    data = _SMALL[piece.data]
    capital = (data >= 0x80) & (data < 0x9F) & (np.roll(data, 1) == 0xC3)
    data[capital] += 0x20
    kind = _KIND[data]
    cut = np.zeros(len(data) + 1, bool)  # a cut before the byte
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    cut[1:-1] &= (kind[1:] != SPACE) & (kind[:-1] != SPACE)
    first = np.zeros(len(data) + 1, bool)
    first[piece.borders] = True
    marks = np.flatnonzero(data == 0x27)
    marks = marks[first[marks] | (kind[marks - 1] != SIGN)]
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for ending in _ENDINGS:
        hit = marks[np.all([padded[marks + 1 + i] == c for i, c in enumerate(ending)], axis=0)]
        to = hit + 1 + len(ending)
        inside = np.searchsorted(piece.borders, hit, "right") == np.searchsorted(piece.borders, to - 1, "right")
        hit, to = hit[inside], to[inside]
        cut[hit + 1] = False
        letter = to[to < len(data)]
        cut[letter] |= kind[letter] != SPACE
    moved = np.cumsum(cut[:-1], dtype=np.int32 if len(data) < 1 << 30 else np.int64)
    moved += np.arange(len(data), dtype=moved.dtype)
    wide = np.full(len(data) + int(cut[:-1].sum()), 0x20, np.uint8)
    wide[moved] = data
    borders = np.full(len(piece.borders), len(wide), np.int64)
    inner = piece.borders < len(data)
    borders[inner] = moved[piece.borders[inner]]
    return pa.Array.from_buffers(pa.large_string(), piece.size, [None, pa.py_buffer(borders), pa.py_buffer(wide)])


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``flat`` one after another, and their borders."""
    borders = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - borders[:-1], size)
    at += np.arange(len(at))
    return flat[at], borders


class WordEncoder:
    """Ids of texts as one flat array and the texts' borders in it.

    ``special``: whether the vocabulary's control strings inside a text become their
    special ids (the tokenizer's own default) or stay ordinary text.
    """

    def __init__(self, path: str | None = None, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.tokenizer.encode_special_tokens = not special
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.memo: dict[str, int] = {"": 0}  # what lies before a leading space has no ids
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)

    def _whole(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        return (np.concatenate(coded) if coded else np.zeros(0, np.uint32)), np.fromiter(map(len, coded), np.int64)

    def _learn(self, pieces: list[str], run: int = 500) -> None:
        """Add the ids of pieces that are one match of the pattern each."""
        flats, sizes = [], []
        for at in range(0, len(pieces), 20 * run):
            runs = [pieces[i:i + run] for i in range(at, min(at + 20 * run, len(pieces)), run)]
            for names, e in zip(runs, self.tokenizer.encode_batch_fast(list(map(" ".join, runs)), add_special_tokens=False)):
                ids = np.array(e.ids, np.uint32)
                ends = np.flatnonzero(self.ends[ids]) + 1
                size = np.diff(ends, prepend=0)
                if len(ends) != len(names) or ends[-1] != len(ids):
                    ids, size = self._whole(names)
                flats.append(ids)
                sizes.append(size)
        flat, size = np.concatenate(flats), np.concatenate(sizes)
        known = len(self.memo)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while known + len(pieces) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.ids[self.used:self.used + len(flat)] = flat
        self.start[known:known + len(pieces)] = self.used + np.cumsum(size) - size
        self.size[known:known + len(pieces)] = size
        self.used += len(flat)
        self.memo.update(zip(pieces, range(known, known + len(pieces))))

    def _plain(self, piece: Slice) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(spaced_pieces(piece))
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.memo]
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.reset()
            new = [p for p in pieces if p]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        start, size = self.start[place], self.size[place]
        which = coded.indices.to_numpy(zero_copy_only=False)
        ids, borders = gathered(self.ids, start[which], size[which])
        offsets = lists.offsets.to_numpy()
        return ids, borders[offsets - offsets[0]]

    def encode(self, piece: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids, borders): document i of the slice has ids[borders[i]:borders[i + 1]]."""
        ids, borders = self._plain(piece)
        odd = np.flatnonzero(odd_documents(piece))
        if not len(odd):
            return ids, borders
        edges = piece.borders
        other, sizes = self._whole([bytes(piece.data[edges[i]:edges[i + 1]]).decode() for i in odd])
        start, size = borders[:-1].copy(), np.diff(borders)
        start[odd], size[odd] = len(ids) + np.cumsum(sizes) - sizes, sizes
        return gathered(np.concatenate([ids, other]), start, size)


_encoders: dict[tuple[str | None, bool], WordEncoder] = {}


def encoder(path: str | None = None, special: bool = True) -> WordEncoder:
    """The encoder of this worker process, loaded once."""
    key = (path, special)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, special)
    return _encoders[key]

