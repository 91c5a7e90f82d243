"""Spelling variants grouped by PartEnum signatures.

Words are near when one inserted, deleted or replaced letter turns one into the other. As
multisets of letters, written as binary vectors with one place per letter and repeat
(``eel`` has e1, e2 and l1), such words have Hamming distance one or two. PartEnum cuts the places into
``PARTS`` parts; vectors that differ in at most two places agree on all parts but two. So
each word is entered once for every two parts left out, under the others' exact content.

1. Vocabulary: words are counted with partial sums before the shuffle.
2. Signatures: ``PARTS`` over two entries per word, an equi-join on exact content.
3. Words that share a signature are compared in blocks (``buckets``). 64-bit parity sketches of the
   vectors and of the neighbouring letters, which one edit changes in few bits, exact
   lengths, and last the letters themselves decide.
   A pair that shares several signatures counts at the first of them only, so nothing
   has to be made distinct, and each word leaves a block with one row: its near words' number and the best.
4. A word's form is its near word of the largest count, if that is ``RATIO`` times its
   own or more; roots are found by doubling the steps along forms.

Defined cases: a null or empty text has no words; a null id is written as nothing before the
colon; repeated rows count again; ties of the largest count go to the word first in code-point
order; a word without near words has a null form and is its own root; extra columns are not
read; no rows give no rows. Words have no longest length; those over ``WIDE`` letters are compared one by one.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.buckets import BLOCK_ROWS, compare_groups, paired
from bidlens.llm.ship import shipped
from bidlens.llm.words import mixed
from bidlens.session import cut_lineage, settled

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
DAMAGE = 31  # a run loses a letter when this divides its checksum
PARTS = 6
WIDE = 64  # letters of a word compared in numpy
SETTLED = 1 << 14  # pairs whose letters are compared at once
CELLS = 1 << 21  # letters of words laid out side by side at once
LEFT_OUT = list(combinations(range(PARTS), 2))
# Number of the first signature that leaves both parts out.
FIRST = np.array([[next(n for n, pair in enumerate(LEFT_OUT) if {a, b} <= set(pair)) for b in range(PARTS)] for a in range(PARTS)])
SIGNATURE = "key long, number int, word string, n long, parity long"
FOUND = "word string, n_near long, best_n long, best string"


def run_words(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(word) of every run of letters in ``docs`` (doc_id, text) that has ``least`` letters, after its damage."""
    found = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")).select(
        "id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    sums = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return sums.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word")).filter(
        F.length("word") >= least)


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words that occur ``count`` times."""
    return run_words(docs, least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


def letter_rows(words: Sequence[str]) -> np.ndarray:
    """Code points of the words, one row each, zero after their ends."""
    width = max(map(len, words), default=1)
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def _part(letter: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    return ((letter + 3 * repeat) % PARTS).astype(np.int64)


def signatures(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (one row per word, one column per signature) and parity sketches of the words' letter vectors."""
    letters = np.sort(letter_rows(words), axis=1)
    repeat = np.zeros_like(letters)
    for j in range(1, letters.shape[1]):
        repeat[:, j] = np.where(letters[:, j] == letters[:, j - 1], repeat[:, j - 1] + 1, 0)
    place = mixed(letters.astype(np.uint64) << np.uint64(32) | repeat)
    place[letters == 0] = 0
    part = _part(letters, repeat)
    content = [np.where(part == p, place, np.uint64(0)).sum(axis=1, dtype=np.uint64) for p in range(PARTS)]
    keys = np.empty((len(words), len(LEFT_OUT)), np.uint64)
    for number, out in enumerate(LEFT_OUT):
        key = np.full(len(words), number + 1, np.uint64)
        for p in range(PARTS):
            if p not in out:
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + content[p])
        keys[:, number] = key
    bit = np.uint64(1) << (place >> np.uint64(58))
    return keys, np.bitwise_xor.reduce(np.where(letters == 0, np.uint64(0), bit), axis=1)


def _narrow_runs(words: list[str]) -> Iterator[np.ndarray]:
    """Row numbers in runs of similar length, so that few long words don't widen all rows."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * len(words[order[to]]) <= CELLS and (
                len(words[order[to]]) <= max(WIDE, 2 * len(words[order[at]]))):
            to += 1
        yield np.array(order[at:to])
        at = to


def signed_words(words: DataFrame) -> DataFrame:
    """Entries (key, number, word, n, parity) of ``words`` (word, n), one per signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for rows in _narrow_runs(texts):
                keys, parity = signatures([texts[i] for i in rows])
                each = len(LEFT_OUT)
                again = pa.array(np.repeat(rows, each))
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(np.arange(each, dtype=np.int32), len(rows))),
                    batch.column(0).take(again), batch.column(1).take(again), pa.array(np.repeat(parity, each).view(np.int64)),
                ], ["key", "number", "word", "n", "parity"])

    return shipped(words.select("word", "n")).mapInArrow(run, SIGNATURE)


def changed_places(a: str, b: str) -> tuple[tuple[int, int], tuple[int, int]] | None:
    """Vector places (letter, repeat) in which near words differ, the same place twice if only one; None if not near.

    ``a`` is not longer than ``b``.
    """
    if a == b or len(b) - len(a) > 1:
        return None
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    longer = (ord(b[at]), b.count(b[at]) - 1)
    if len(a) < len(b):
        return (longer, longer) if a[at:] == b[at + 1:] else None
    return ((ord(a[at]), a.count(a[at]) - 1), longer) if a[at + 1:] == b[at + 1:] else None


def neighbour_sketch(letters: np.ndarray) -> np.ndarray:
    """64 bits per word, each the parity of its neighbouring letters that hash to it; one edit flips four at most."""
    pair = letters[:, :-1].astype(np.uint64) << np.uint64(32) | letters[:, 1:]
    bit = np.uint64(1) << (mixed(pair) >> np.uint64(58))
    return np.bitwise_xor.reduce(np.where(letters[:, 1:] == 0, np.uint64(0), bit), axis=1)


def from_the_end(letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The words' rows read backwards, zero after their beginnings."""
    at = size[:, None] - 1 - np.arange(letters.shape[1])
    return np.where(at >= 0, np.take_along_axis(letters, np.maximum(at, 0), axis=1), 0).astype(letters.dtype)


def near_rows(letters: np.ndarray, backwards: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray,
              number: np.ndarray) -> np.ndarray:
    """Which pairs of different words (rows of ``letters``) are near and meet at their first shared signature ``number``.

    Lengths differ by one at most. The common beginning and end together reach all letters but one.
    """
    swap = size[i] > size[j]
    a, b = np.where(swap, j, i), np.where(swap, i, j)
    at = (letters[a] != letters[b]).argmax(axis=1)
    near = np.flatnonzero(at + (backwards[a] != backwards[b]).argmax(axis=1) >= size[b] - 1)
    a, b, at = a[near], b[near], at[near]
    x, y = letters[a], letters[b]
    row = np.arange(len(a))
    old, new = x[row, at], y[row, at]
    came = _part(new.astype(np.int64), (y == new[:, None]).sum(axis=1) - 1)
    went = np.where(size[a] == size[b], _part(old.astype(np.int64), (x == old[:, None]).sum(axis=1) - 1), came)
    found = np.zeros(len(i), bool)
    found[near] = FIRST[went, came] == number[i[near]]
    return found


def _best_of(i: np.ndarray, j: np.ndarray, words: list[str], n: np.ndarray) -> pa.RecordBatch:
    """Per word of the near pairs: how many there are, and the one of the largest count, then the first word."""
    one, other = np.concatenate([i, j]), np.concatenate([j, i])
    place = {w: k for k, w in enumerate(sorted({words[k] for k in np.unique(other).tolist()}))}
    rank = np.array([place.get(w, 0) for w in words])
    order = np.lexsort((rank[other], -n[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.diff(one, prepend=-1))
    return pa.RecordBatch.from_arrays([
        pa.array([words[k] for k in one[first].tolist()], pa.string()), pa.array(np.diff(first, append=len(one))),
        pa.array(n[other[first]]), pa.array([words[k] for k in other[first].tolist()], pa.string())],
        ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of all ``words`` (word, n) that have near words."""
    def compare(batch: pa.RecordBatch, group: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        parity, number = batch.column("parity").to_numpy().view(np.uint64), batch.column("number").to_numpy()
        size = np.array([len(t) for t in texts])
        letters = letter_rows([t if len(t) <= WIDE else "" for t in texts])
        neighbours = neighbour_sketch(letters)
        if letters.max(initial=0) < 256:
            letters = letters.astype(np.uint8)
        backwards = from_the_end(letters, np.where(size <= WIDE, size, 0))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def settle() -> None:
            i, j = (np.concatenate(ends) for ends in zip(*held))
            held.clear()
            near = near_rows(letters, backwards, size, i, j, number)
            found.append((i[near], j[near]))

        for i, j in paired(group, side):
            close = np.bitwise_count(parity[i] ^ parity[j]) <= 2
            i, j = i[close], j[close]
            close = np.abs(size[i] - size[j]) <= 1
            i, j = i[close], j[close]
            long = np.maximum(size[i], size[j]) > WIDE
            if long.any():
                for a, b in zip(i[long].tolist(), j[long].tolist()):
                    places = changed_places(*sorted((texts[a], texts[b]), key=len))
                    if places and FIRST[tuple(int(_part(*p)) for p in np.array(places))] == number[a]:
                        found.append((np.array([a]), np.array([b])))
                i, j = i[~long], j[~long]
            close = np.bitwise_count(neighbours[i] ^ neighbours[j]) <= 4
            i, j = i[close], j[close]
            if len(i):
                held.append((i, j))
                waiting += len(i)
            if waiting > SETTLED:
                settle()
                waiting = 0
        if held:
            settle()
        if sum(len(i) for i, _ in found):
            yield _best_of(*(np.concatenate(side) for side in zip(*found)), texts, n)

    entries = cut_lineage(signed_words(words), "signatures")
    parts = compare_groups(entries, ["key", "number"], compare, FOUND, "word", block)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def follow(steps: DataFrame) -> DataFrame:
    """(word, root) of all ``steps`` (word, form): where the way along forms ends. Each round doubles the steps taken."""
    ways = cut_lineage(steps.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = ways.join(on, "root", "left")
        ways = cut_lineage(joined.select("word", F.coalesce("further", "root").alias("root"),
                                         F.col("further").isNotNull().alias("moved")), "ways")
        if ways.filter("moved").isEmpty():
            return ways.drop("moved")
        ways = ways.drop("moved")


def spelling_variants(docs: DataFrame, ratio: int = RATIO, block: int = BLOCK_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text)."""
    def formed() -> DataFrame:
        words = cut_lineage(vocabulary(docs), "words")
        near = words.join(near_words(words, block), "word", "left")
        common: Column = F.col("best_n") >= ratio * F.col("n")
        return near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n"))

    spark = docs.sparkSession
    forms = settled(spark, formed, "forms")
    roots = settled(spark, lambda: follow(forms.filter("form is not null").select("word", "form")), "roots")
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
