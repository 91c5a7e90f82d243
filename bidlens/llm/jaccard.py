"""Exact n-gram Jaccard join with a token-group matrix.

Sets of word shingles are linked when ``den * |A & B| >= num * |A | B|``. The join
returns each document's component and its number of links, not all pairs.

1. Equal sets are one class, which counts its copies.
2. Families. Order all shingles by the number of sets that have them, rarest first. The
   a - ceil(a * num / den) + 1 first shingles of two linked sets meet, and a shingle of one
   set alone meets nothing, so most sets drop out; sets whose first shingles meet form a
   family, a superset of the components. Any one order is right, so only a fixed share
   of the shingles by hash, twice as many as are needed, is counted and goes first. The
   few shingles of very many sets go last and are not counted; that list is bounded by
   its threshold. Shingles travel in packets, each once per task and class.
3. Groups. A family is cut into groups of similar size of at most ``GROUP_TOKENS``
   shingles. Each group keeps the union of its members' shingles, a row of the matrix.
4. A set is a query to another group of its family if one of its first shingles is one of
   the group's: its overlap with the group's union bounds its overlap with every member.
   Only groups that reach the least overlap a link needs are opened, and only for those
   queries; there all pairs are verified at once.
5. Links leave a group as one edge per set to the smallest set reached, never as pairs.

No group is gathered whole unless its size is bounded; only the bounded list of frequent
shingles goes to all tasks.

Defined cases: a text with fewer words than a shingle has its whole sequence as its
only one; one without words, null or empty, is empty and linked with nothing; repeated
rows are copies of each other; a null id is larger than all; extra columns are not
read; no rows give no rows. Shingles and classes are told apart by 64-bit hashes, classes by two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.graph import components
from bidlens.llm.rows import numbered, unnumbered
from bidlens.llm.ship import shipped
from bidlens.llm.words import mixed, shingle_sets, slices
from bidlens.session import cut_lineage, settled

GROUP_TOKENS = 1 << 17  # shingles a group may hold; a set counts at least MIN_WEIGHT
MIN_WEIGHT = 128
PART_TOKENS = 1 << 19  # shingles counted in one task at once
FLUSH_TOKENS = 1 << 19  # shingles of a task brought together before they are dealt out
LOCAL_FREQUENT = 8  # sets of a task's batch that make a shingle a candidate for a frequent one
FREQUENT_PARTS = 1_000_000  # a frequent shingle has this part of all shingles, so there are at most as many
LEAST_FREQUENT = 1000  # but at least so many sets
FANOUT = 1024  # targets of a task's shingles at each of two levels
DENSE = 16  # shingles of more sets than this are counted by matrix product
SETS = "row long, id long, n long, set_id long, proof long"
PACKETS = "part long, shingles binary, sets binary, counts binary, needs binary, last binary"
SHARED = "part long, sets binary, shingles binary, having binary, needs binary, last binary"
FIRST = "shingle long, set_id long"
LINKS = "a long, b long, links long"


def size_bands(largest: int, num: int, den: int) -> list[int]:
    """Lower ends of bands of set sizes; linked sets are in the same band or in neighbours."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * den // num + 1)
    return edges


def set_rows(docs: DataFrame, k: int) -> DataFrame:
    """(row, id, n, set_id, proof) of ``rows.numbered`` documents (doc_id, text): the size of the shingle set and two hashes of the whole set.

    Rows without a row number count the sets (n) of a batch that have a shingle (set_id), where they are many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch.column(2)):
                doc, values = shingle_sets(piece, k)
                n = np.bincount(doc, minlength=piece.size)
                set_id, proof = set_hashes(doc, values, piece.size)
                part = batch.slice(piece.first, piece.size)
                yield pa.RecordBatch.from_pydict({
                    "row": part.column(0), "id": part.column(1), "n": pa.array(n.astype(np.int64)),
                    "set_id": pa.array(set_id.view(np.int64)), "proof": pa.array(proof.view(np.int64))})
                held.append(values[_first_copies(set_id)[doc]])
                size += len(held[-1])
                if size >= FLUSH_TOKENS:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(held), return_counts=True)
        often = count >= LOCAL_FREQUENT
        nothing = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_pydict({
            "row": nothing, "id": nothing, "n": pa.array(count[often].astype(np.int64)),
            "set_id": pa.array(value[often].view(np.int64)), "proof": nothing})

    return shipped(_flat(docs)).mapInArrow(run, SETS)


def _first_copies(set_id: np.ndarray) -> np.ndarray:
    """Which documents are the first of a slice with their set."""
    _, one = np.unique(set_id, return_index=True)
    found = np.zeros(len(set_id), bool)
    found[one] = True
    return found


def _flat(docs: DataFrame) -> DataFrame:
    return docs.select("row", F.col("doc.doc_id").cast("long").alias("id"), F.col("doc.text").cast("string").alias("text"))


def set_hashes(doc: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each document's set, from sorted (document, shingle hash)."""
    found = np.zeros((2, size), np.uint64)
    if len(doc):
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            found[k, doc[first]] = mixed(np.add.reduceat(mixed(values ^ np.uint64(salt)), first))
    return found[0], found[1]


def needed(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many first shingles of a set of ``n`` meet those of any set linked with it."""
    return n - -(-n * num // den) + 1


def dealt_shingles(doc: np.ndarray, values: np.ndarray, size: int, frequent: np.ndarray, num: int, den: int):
    """Split sorted (document, shingle) into what is counted and what goes last.

    Returns a mask of the counted shingles, a mask of the frequent ones among the first
    of their set, and per document how many first shingles it needs and how many of the
    counted ones belong to the share that goes first.
    """
    n = np.bincount(doc, minlength=size)
    need = np.where(n > 0, needed(n, num, den), 0)
    place = np.minimum(np.searchsorted(frequent, values), max(0, len(frequent) - 1))
    common = frequent[place] == values if len(frequent) else np.zeros(len(values), bool)
    share = min(2**32, 2 * (den - num) * 2**32 // den)
    early = ((values >> np.uint64(32)) < np.uint64(share)) & ~common

    def rank(mask: np.ndarray) -> np.ndarray:
        sums = np.cumsum(mask) - mask
        first = np.searchsorted(doc, np.arange(size))
        return sums - np.append(sums, 0)[first][doc]

    counted = ~common & (early | (rank(~common) < need[doc]))
    usual = np.bincount(doc[~common], minlength=size)
    last = common & (rank(common) < (need - usual)[doc])
    return counted, last, need, np.bincount(doc[early], minlength=size)


def part_of_values(value: np.ndarray, parts: int) -> np.ndarray:
    return (((value >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def part_of_sets(set_id: np.ndarray, parts: int) -> np.ndarray:
    return (np.ascontiguousarray(set_id).view(np.uint64) % np.uint64(parts)).astype(np.int64)


def _binary(part: list[int], **rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int64()), **{c: pa.array(v, pa.binary()) for c, v in rows.items()}})


def dealt_by_value(value: np.ndarray, owner: np.ndarray, needs: np.ndarray, last: np.ndarray, parts: int, span: int) -> pa.RecordBatch:
    """One packet for every run of ``span`` parts that has any of the values; needs and last go with some packet."""
    part = part_of_values(value, parts) // span
    order = np.lexsort((owner, part))
    value, owner, part = value[order], owner[order], part[order]
    found, cut = np.unique(part, return_index=True)
    if not len(found):
        found, cut = part_of_sets(needs[:1, 0], parts) // span, np.zeros(1, np.int64)
    cut = np.append(cut, len(value))
    rows = {c: [] for c in ("shingles", "sets", "counts", "needs", "last")}
    for lo, hi, info, tail in zip(cut[:-1], cut[1:], np.array_split(needs, len(found)), np.array_split(last, len(found))):
        own = owner[lo:hi]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
        rows["shingles"].append(value[lo:hi].tobytes())
        rows["sets"].append(own[first].tobytes())
        rows["counts"].append(np.diff(np.append(first, len(own))).astype(np.uint32).tobytes())
        rows["needs"].append(info.tobytes())
        rows["last"].append(tail.tobytes())
    return _binary(found.tolist(), **rows)


def dealt_by_set(owner: np.ndarray, value: np.ndarray, having: np.ndarray, needs: np.ndarray, last: np.ndarray, parts: int,
                 span: int) -> pa.RecordBatch:
    """One packet for every run of ``span`` parts that has any of the sets."""
    streams = ((owner, {"sets": owner, "shingles": value, "having": having}), (needs[:, 0], {"needs": needs}), (last[:, 1], {"last": last}))
    to = [part_of_sets(names, parts) // span for names, _ in streams]
    found = np.unique(np.concatenate(to))
    rows = {}
    for part, (_, columns) in zip(to, streams):
        order = np.argsort(part, kind="stable")
        lo, hi = (np.searchsorted(part[order], found, side) for side in ("left", "right"))
        for name, column in columns.items():
            held = column[order]
            rows[name] = [held[a:b].tobytes() for a, b in zip(lo, hi)]
    return _binary(found.tolist(), **rows)


def packets(docs: DataFrame, k: int, num: int, den: int, frequent: np.ndarray, parts: int, span: int = 1) -> DataFrame:
    """The shingles to be counted, dealt to runs of ``span`` of ``parts`` parts by value, and each class's needs."""
    shared_list = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch.column(0)):
                doc, values = shingle_sets(piece, k)
                set_id = set_hashes(doc, values, piece.size)[0]
                one = _first_copies(set_id)
                doc, values = doc[one[doc]], values[one[doc]]
                set_id = set_id.view(np.int64)
                counted, last, need, early = dealt_shingles(doc, values, piece.size, shared_list.value, num, den)
                own = np.unique(doc)
                held.append((values[counted], set_id[doc[counted]], np.stack([set_id[own], need[own], early[own]], 1),
                             np.stack([values[last].view(np.int64), set_id[doc[last]]], 1)))
                size += int(counted.sum())
                if size >= FLUSH_TOKENS:
                    yield from _flushed(held, dealt_by_value, parts, span)
                    held, size = [], 0
        yield from _flushed(held, dealt_by_value, parts, span)

    return shipped(_flat(docs).select("text")).mapInArrow(run, PACKETS)


def _flushed(held: list[tuple], deal, parts: int, span: int) -> Iterator[pa.RecordBatch]:
    if held:
        columns = [np.concatenate(x) for x in zip(*held)]
        if any(map(len, columns)):
            yield deal(*columns, parts, span)


def _values_of(table: pa.Table) -> tuple[np.ndarray, ...]:
    owner = np.repeat(_joined(table, "sets", np.int64), _joined(table, "counts", np.uint32))
    return (_joined(table, "shingles", np.uint64), owner, _joined(table, "needs", np.int64).reshape(-1, 3),
            _joined(table, "last", np.int64).reshape(-1, 2))


def _sets_of(table: pa.Table) -> tuple[np.ndarray, ...]:
    return (_joined(table, "sets", np.int64), _joined(table, "shingles", np.uint64), _joined(table, "having", np.uint32),
            _joined(table, "needs", np.int64).reshape(-1, 3), _joined(table, "last", np.int64).reshape(-1, 2))


def dealt_again(runs: DataFrame, read, deal, parts: int) -> DataFrame:
    """Packets of runs of parts as packets of single parts.

    A task deals its tokens to at most ``FANOUT`` targets at each of the two levels, so packets grow with
    the tokens and not with tokens times parts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                held.append(read(batch.slice(row, 1)))
                size += len(held[-1][0])
                if size >= FLUSH_TOKENS:
                    yield from _flushed(held, deal, parts, 1)
                    held, size = [], 0
        yield from _flushed(held, deal, parts, 1)

    return shipped(runs.repartition("part").sortWithinPartitions("part")).mapInArrow(run, runs.schema)


def _joined(table: pa.Table | pa.RecordBatch, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def shared_shingles(parts: int, span: int = 1):
    """Count the sets of each shingle of a part; shingles of several sets go on, dealt by set."""

    def run(table: pa.Table) -> pa.Table:
        value, owner, needs, last = _values_of(table)
        order = np.lexsort((owner, value))
        value, owner = value[order], owner[order]
        fresh = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])) if len(value) else np.zeros(0, bool)
        value, owner = value[fresh], owner[fresh]
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
        having = np.diff(np.append(first, len(value)))
        having = np.repeat(having, having)
        several = having > 1
        having = np.minimum(having[several], 2**32 - 1).astype(np.uint32)
        return pa.Table.from_batches([dealt_by_set(owner[several], value[several], having, needs, last, parts, span)])

    return run


def first_shingles(table: pa.Table) -> pa.Table:
    """The shared shingles among the first ones of each class of a part."""
    owner, value, having, needs, last = _sets_of(table)
    needs, last = np.unique(needs, axis=0), np.unique(last, axis=0)  # copies in other tasks say the same
    order = np.lexsort((value, having, owner))
    owner, value = owner[order], value[order]
    first = np.searchsorted(owner, needs[:, 0])
    count = np.searchsorted(owner, needs[:, 0], "right") - first
    need, early = needs[:, 1], needs[:, 2]
    # Where the share that goes first is enough, its shingles of one set alone come before the shared ones.
    taken = np.where(early >= need, np.clip(need - (early - count), 0, count), count)
    at = np.repeat(first - (np.cumsum(taken) - taken), taken) + np.arange(int(taken.sum()))
    return pa.table({"shingle": pa.array(np.concatenate([value[at].view(np.int64), last[:, 0]])),
                     "set_id": pa.array(np.concatenate([owner[at], last[:, 1]]))})


def meeting_edges(firsts: DataFrame) -> DataFrame:
    """(a, b): each class with the smallest class of every first shingle it shares; ``firsts`` is read twice."""
    low = firsts.groupBy("shingle").agg(F.min("set_id").alias("b"), F.max("set_id").alias("top")).filter("b < top")
    return firsts.join(low.select("shingle", "b"), "shingle").filter("set_id <> b").select(
        F.col("set_id").alias("a"), "b").distinct()


def overlaps(sets: list[np.ndarray], query: np.ndarray) -> np.ndarray:
    """Numbers of shared values: of every set (row) with every set that is no query (column).

    With queries, only theirs are counted among the rows.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    values = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(values)))
    asked = query if query.any() else np.ones(m, bool)
    row, column = np.cumsum(asked) - 1, np.cumsum(~query) - 1
    total = np.zeros((int(asked.sum()), int((~query).sum())), np.float32)
    for size in range(2, min(DENSE, m) + 1):  # rare values: pairs of their owners
        start = first[count == size]
        if not len(start):
            continue
        for i in range(size):
            for j in range(size):
                x, y = owner[start + i], owner[start + j]
                both = asked[x] & ~query[y] & (x != y)
                np.add.at(total, (row[x[both]], column[y[both]]), 1)
    common = np.flatnonzero(count > DENSE)
    for at in range(0, len(common), 2048):
        part = common[at:at + 2048]
        label = np.repeat(np.arange(len(part)), count[part])
        place = np.arange(len(label)) + np.repeat(first[part] - (np.cumsum(count[part]) - count[part]), count[part])
        held = np.zeros((m, len(part)), np.float32)
        held[owner[place], label] = 1
        total += held[asked] @ held[~query].T
    return total


def linked(sets: list[np.ndarray], num: int, den: int, query: np.ndarray | None = None) -> np.ndarray:
    """Boolean matrix of the links between sets; with queries, of those between a query and another set only."""
    m = len(sets)
    query = np.zeros(m, bool) if query is None else query
    shared = overlaps(sets, query)
    asked = np.flatnonzero(query) if query.any() else np.arange(m)
    own = np.flatnonzero(~query)
    n = np.array([len(x) for x in sets], np.int64)
    found = np.zeros((m, m), bool)
    for at in range(0, len(asked), 256):  # a few rows at once, as whole numbers take eight bytes
        rows = asked[at:at + 256]
        both = np.rint(shared[at:at + 256]).astype(np.int64)
        found[np.ix_(rows, own)] = (den + num) * both >= num * (n[rows][:, None] + n[own][None, :])
    np.fill_diagonal(found, False)
    return found | found.T


def smallest_reached(links: np.ndarray) -> np.ndarray:
    """For each set the first one of its component."""
    x, y = np.nonzero(links)
    label = np.arange(len(links))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def verifier(num: int, den: int):
    """Links among the rows of one opened group: each set with its component's first set and its number of linked documents.

    Rows with ``query`` true come from another group and are compared with the group's own rows only.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("set_id")
        names, copies = (table.column(c).to_numpy() for c in ("set_id", "copies"))
        query = table.column("query").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        links = linked(sets, num, den, query)
        label = smallest_reached(links)
        count = np.array([int(copies[row].sum()) for row in links], np.int64)
        hit = np.flatnonzero(count)
        return pa.table({"a": names[hit], "b": names[label[hit]], "links": pa.array(count[hit], pa.int64())})

    return run


def union_of_group(table: pa.Table) -> pa.Table:
    """One row of the token-group matrix: the distinct shingles of a group."""
    union = np.unique(_joined(table, "shingles", np.uint64))
    return pa.table({"group": table.column("group").slice(0, 1), "union": pa.array([union.tobytes()], pa.binary())})


def qualifying(num: int, den: int):
    """Queries whose overlap with a group's union reaches the least overlap a link needs."""

    def run(unions: pa.Table, queries: pa.Table) -> pa.Table:
        union = _joined(unions, "union", np.uint64)
        kept = []
        for row, raw in enumerate(queries.column("shingles").to_pylist()):
            own = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(union, own), max(0, len(union) - 1))
            bound = int((union[at] == own).sum()) if len(union) else 0
            if den * bound >= num * len(own):
                kept.append(row)
        return queries.select(["pair", "set_id"]).take(pa.array(kept, pa.int64()))

    return run


def member_sets(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``members`` (row, set_id, n, copies, group) with their shingles, made anew from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(0)):
                doc, values = shingle_sets(piece, k)
                cut = (8 * np.searchsorted(doc, np.arange(piece.size + 1))).astype(np.int64)
                shingles = pa.Array.from_buffers(pa.large_binary(), piece.size, [None, pa.py_buffer(cut), pa.py_buffer(values)])
                part = batch.slice(piece.first, piece.size)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], shingles.cast(pa.binary())], names=[*names, "shingles"])

    names = ["set_id", "n", "copies", "group"]
    joined = _flat(docs).join(members, "row").select("text", *names)
    return shipped(joined).mapInArrow(
        run, "set_id long, n long, copies long, group struct<family:long, band:int, salt:long>, shingles binary")


def with_groups(members: DataFrame, bands: list[int], group_tokens: int) -> DataFrame:
    """Deal each family's sets to groups (column ``group``) of similar size and bounded weight."""
    edges = F.array(*[F.lit(e) for e in bands])
    weight = F.greatest("n", F.lit(MIN_WEIGHT))
    banded = members.withColumn("band", F.size(F.filter(edges, lambda e: e <= F.col("n"))))
    cells = (banded.groupBy("family", "band").agg(F.sum(weight).alias("weight"))
             .select("family", "band", F.ceil(F.col("weight") / group_tokens).alias("salts")))
    return banded.join(cells, ["family", "band"]).withColumn(
        "group", F.struct("family", "band", F.pmod(F.xxhash64("set_id"), F.col("salts")).alias("salt"))).drop("salts", "band")


def asking(firsts: DataFrame, placed: DataFrame) -> DataFrame:
    """(pair, set_id): sets with the other groups that they may be linked with, as ``pair`` (group, other: the set's own).

    The matrix turned round: rows of (shingle, group) for the groups' first shingles, met by the sets' own. Rows
    grow with what sets and groups share, not with all pairs of groups of a family.
    """
    mine = cut_lineage(firsts.join(placed.select("set_id", "group"), "set_id"), "first-groups")
    matrix = cut_lineage(mine.select("shingle", F.col("group").alias("met")).distinct(), "matrix")
    met = mine.join(matrix, "shingle").filter("met < group and abs(met.band - group.band) <= 1")
    return met.select(F.struct(F.col("met").alias("group"), F.col("group").alias("other")).alias("pair"), "set_id").distinct()


def links_within_families(docs: DataFrame, members: DataFrame, firsts: DataFrame, k: int, num: int, den: int,
                          group_tokens: int) -> DataFrame:
    """(a, b, links): every linked set with the first set of its component within an opened group."""
    largest = members.agg(F.max("n")).first()[0]
    if largest is None:
        return docs.sparkSession.createDataFrame([], LINKS)
    bands = size_bands(largest, num, den)
    sets = cut_lineage(member_sets(docs, with_groups(members, bands, group_tokens), k), "members")
    inner = sets.select("group", "set_id", "copies", "shingles", F.lit(False).alias("query"))
    found = inner.groupBy("group").applyInArrow(verifier(num, den), LINKS)
    queries = cut_lineage(asking(firsts, sets), "asking")
    pairs = cut_lineage(queries.select("pair", F.col("pair.group").alias("group")).distinct(), "pairs")
    if pairs.isEmpty():
        return found
    unions = (sets.join(pairs.select("group").distinct(), "group", "left_semi").groupBy("group")
              .applyInArrow(union_of_group, _schema(sets, "group").add("union", "binary")))
    asked = queries.join(sets.select("set_id", "shingles"), "set_id").select("pair", "set_id", "shingles")
    open_for = (unions.join(pairs, "group").select("pair", "union").groupBy("pair")
                .cogroup(asked.groupBy("pair"))
                .applyInArrow(qualifying(num, den), _schema(pairs, "pair").add("set_id", "long")))
    open_for = cut_lineage(open_for, "queries")
    queries = open_for.join(sets, "set_id").select("pair", "set_id", "copies", "shingles", F.lit(True).alias("query"))
    opened = (sets.join(open_for.select("pair").distinct().withColumn("group", F.col("pair.group")), "group")
              .select("pair", "set_id", "copies", "shingles", F.lit(False).alias("query")))
    return found.unionByName(queries.unionByName(opened).groupBy("pair").applyInArrow(verifier(num, den), LINKS))


def _schema(df: DataFrame, column: str):
    return df.select(column).schema


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                       group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): row, id, n_shingles, component_id, component_row, n_links."""
    return settled(docs.sparkSession, lambda: linked_rows(numbered(docs, ["doc_id", "text"]), k, num, den, group_tokens), "components")


def linked_rows(docs: DataFrame, k: int, num: int, den: int, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Per document of ``rows.numbered``: row, id, n_shingles, component_id, component_row, n_links.

    ``row`` is the row's number, ``component_row`` the lowest of its component;
    ``component_id`` is the smallest id reachable by links, ``n_links`` the number of
    documents it is linked with, copies included.
    """
    spark = docs.sparkSession
    found = cut_lineage(set_rows(docs, k), "sets")
    rows = found.filter("row is not null")
    classes = cut_lineage(rows.filter("n > 0").groupBy("set_id", "proof", "n").agg(
        F.min("id").alias("id"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_FREQUENT, (rows.agg(F.sum("n")).first()[0] or 0) // FREQUENT_PARTS)
    # At most as many as all rows' shingles over the least count.
    frequent = (found.filter("row is null").groupBy("set_id").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
                .select("set_id").toPandas()["set_id"].to_numpy(np.int64).view(np.uint64))
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-total * 2 * (den - num) // den // PART_TOKENS))
    span = -(-parts // FANOUT)
    by_value = packets(docs, k, num, den, np.sort(frequent), parts, span)
    if span > 1:
        by_value = dealt_again(by_value, _values_of, dealt_by_value, parts)
    by_set = by_value.groupBy("part").applyInArrow(shared_shingles(parts, span), SHARED)
    if span > 1:
        by_set = dealt_again(by_set, _sets_of, dealt_by_set, parts)
    firsts = cut_lineage(by_set.groupBy("part").applyInArrow(first_shingles, FIRST), "firsts")
    families = components(meeting_edges(firsts))
    members = classes.join(families, F.col("set_id") == F.col("node")).select(
        "row", "set_id", "n", "copies", F.col("component").alias("family"))
    links = cut_lineage(links_within_families(docs, members, firsts, k, num, den, group_tokens), "links")
    joined = components(links.select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "set_id")
    named = (classes.join(joined, F.col("set_id") == F.col("node"), "left").join(counts, "set_id", "left")
             .withColumn("component", F.coalesce("component", "set_id")))
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"), F.min("row").alias("component_row"))
    result = named.join(lowest, "component").select("set_id", "proof", "component_id", "component_row", "copies", "links")
    return rows.join(result, ["set_id", "proof"], "left").select(
        "row", "id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("component_row")).otherwise(F.col("row")).alias("component_row"),
        F.when(F.col("n") > 0, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"))


def keep_one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` (doc_id, text and more) with one row of each component, that of the lowest number; all columns are kept."""
    rows = numbered(docs)
    dropped = settled(docs.sparkSession, lambda: linked_rows(rows, k, num, den).filter("row <> component_row").select("row"), "dropped")
    return unnumbered(rows.join(dropped, "row", "left_anti"))
