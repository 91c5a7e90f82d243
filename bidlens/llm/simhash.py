"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has the bits that are set in over half the hashes of a text's shingles.
Two fingerprints link when they differ in at most ``distance`` = t bits. Cut them into
t + 1 segments on a ring. If all differences sum to at most t, then from some segment on
every chain of consecutive segments stays within its share: none in the first, and at
most l - 1 in the first l. (Were each start to break its budget somewhere, going round
the ring would add up to more than t.)

1. Equal fingerprints are one class, which counts its copies.
2. Each class is entered under the beginnings of all its chains: the first segment and,
   as the second may differ in one bit and both of the next two in two, either the whole
   second segment or one half of each of the next two. These are exact keys.
3. Classes that share a key are candidates. The cumulative differences along the whole
   chain are held against their budgets, and only what stays within all of them comes to the
   full count of differing bits. This happens in blocks (``buckets``), pairs stay inside.
4. Links leave a block as a spanning forest, and ``graph.components`` joins the forests.

Defined cases: a null or empty text, or one without words, has fingerprint zero and links
like any other; a text with fewer words than a shingle is one shingle; repeated rows
are copies; null ids are never a component's number unless it has no other, then that is null;
extra columns are not read; no rows give no rows. Long texts are hashed in bounded pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.buckets import BLOCK_ROWS, compare_groups, paired, spanning
from bidlens.llm.graph import components
from bidlens.llm.ship import shipped
from bidlens.session import cut_lineage, settled

BITS = 64
DISTANCE = 4
SHINGLE = 4
SEED = 42
PIECE = 1 << 20  # bytes of a text that are cut into words at once
HELD_LINKS = 1 << 20  # links of a batch before they are reduced to a forest
_SPACES = b" \t\n\x0b\x0c\r"


def _word_runs(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some at a time; pieces end between words."""
    at = 0
    while at < len(data):
        to = min(at + PIECE, len(data))
        while to < len(data) and data[to] not in _SPACES:
            to += 1
        yield data[at:to].split()
        at = to


def shingle_hashes(text: str | None, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of all ``k``-word shingles of a text, some at a time."""
    tail: list[bytes] = []
    any_yet = False
    for words in _word_runs((text or "").encode().lower()):
        words = tail + words
        if len(words) >= k:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = np.concatenate([[0], ends[:-k]])
            yield np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in
                            zip(starts.tolist(), (ends[k - 1:] - 1).tolist())], np.uint64)
            any_yet = True
        tail = words[-(k - 1):] if k > 1 else []
    if not any_yet and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, from the lowest."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255 * 64):
        raw = hashes[at:at + 255 * 64].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        rest = len(bits) % 255
        total += bits[len(bits) - rest:].sum(axis=0, dtype=np.uint8)
        if len(bits) >= 255:  # 255 ones fit a byte
            total += bits[:len(bits) - rest].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The text's fingerprint as an unsigned number."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, k):
        ones += _ones(hashes)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text); ``fp`` holds the 64 bits as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return shipped(rows).mapInArrow(run, "doc_id long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and size of the ``distance`` + 1 segments of the ring."""
    size, longer = divmod(BITS, distance + 1)
    sizes = [size + (i < longer) for i in range(distance + 1)]
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def _mask(first: int, size: int) -> int:
    return ((1 << size) - 1) << first


def chain_masks(distance: int) -> np.ndarray:
    """Bits of the first l segments from each start, for l from 1: budgets are l - 1."""
    single = [_mask(*s) for s in _segments(distance)]
    m = len(single)
    return np.array([[sum(single[(start + i) % m] for i in range(length)) for length in range(1, m + 1)]
                     for start in range(m)], np.uint64)


def key_masks(distance: int) -> list[tuple[int, int]]:
    """(start, bits) of every exact key: within its budgets a chain agrees on one of its start's."""
    ring = _segments(distance)
    m, masks = len(ring), []
    for start in range(m):
        head = _mask(*ring[start])
        if m < 4:  # too few segments for a budget of two bits ahead of the full count
            masks.append((start, head))
            continue
        (a, n), (b, k) = ring[(start + 1) % m], ring[(start + 2) % m]
        masks.append((start, head | _mask(a, n)))
        for x in (_mask(a, n // 2), _mask(a + n // 2, n - n // 2)):
            for y in (_mask(b, k // 2), _mask(b + k // 2, k - k // 2)):
                masks.append((start, head | x | y))
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def chain_keys(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(kind, key, start, fp) for every class ``fp`` and every key."""
    keys = [F.struct(F.lit(kind).alias("kind"), F.col("fp").bitwiseAND(F.lit(_signed(bits)).cast("long")).alias("key"),
                     F.lit(start).alias("start")) for kind, (start, bits) in enumerate(key_masks(distance))]
    return classes.select("fp", F.explode(F.array(*keys)).alias("_k")).select("_k.*", "fp")


def linked_classes(classes: DataFrame, distance: int = DISTANCE, block: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that join all those linked directly or through others."""
    chains = chain_masks(distance)

    def links(batch: pa.RecordBatch, group: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
        value = batch.column("fp").to_numpy().view(np.uint64)
        mine = chains[batch.column("start").to_numpy()]
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        held, low = 0, np.arange(len(value))
        for i, j in paired(group, side):
            differ = value[i] ^ value[j]
            for length in range(1, distance + 2):
                stays = np.bitwise_count(differ & mine[i, length - 1]) <= length - 1
                if not stays.all():
                    i, j, differ = i[stays], j[stays], differ[stays]
            if len(i):
                ends.append((i, j))
                held += len(i)
            if held > HELD_LINKS:
                low, held, ends = _forest(ends, low)
        low, _, _ = _forest(ends, low)
        leaf = np.flatnonzero(low != np.arange(len(low)))
        if len(leaf):
            yield pa.RecordBatch.from_arrays([pa.array(value[leaf].view(np.int64)), pa.array(value[low[leaf]].view(np.int64))],
                                             ["a", "b"])

    keys = cut_lineage(chain_keys(classes, distance), "chains")
    return compare_groups(keys, ["kind", "key"], links, "a long, b long", "fp", block)


def _forest(ends: list[tuple[np.ndarray, np.ndarray]], low: np.ndarray) -> tuple[np.ndarray, int, list]:
    """Components of the links together with the forest ``low``."""
    own = np.arange(len(low))
    i = np.concatenate([own, *[e[0] for e in ends]])
    j = np.concatenate([low, *[e[1] for e in ends]])
    return spanning(len(low), i, j), 0, []


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, k: int = SHINGLE, block: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component is its smallest id reachable over links."""
    if distance < 0:
        raise ValueError("distance must not be negative")
    rows = cut_lineage(fingerprints(docs, k), "fingerprints")

    def placed() -> DataFrame:
        classes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
        graph = components(linked_classes(classes.select("fp"), distance, block))
        named = classes.join(graph.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "component", F.coalesce("component", "fp"))
        least = named.groupBy("component").agg(F.min("first").alias("component_id"))
        return named.join(least, "component").select("fp", "component_id")

    ids = settled(docs.sparkSession, placed, "components")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    """The 16 lower-case digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
