"""Pairs of rows that share a key, compared within tasks in blocks of bounded size.

Keys with more rows than a block holds are counted by a shuffle first. Their rows are
dealt into blocks by a hash, and every two blocks of a key meet in a group of their own,
so a hot key is shared out over many tasks and no task holds more than two blocks of it.
Pairs never leave a task: the comparing function returns what follows from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped
from bidlens.session import cut_lineage, pin_small

BLOCK_ROWS = 2048  # rows of one key that are compared at once; two blocks meet
BATCH_ROWS = 1 << 16  # rows handed over at once, besides those of a group that is cut
# Record batch of whole groups, number of each row's group, and its block's side (0 or 1) in it.
Compare = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]


def in_blocks(rows: DataFrame, keys: Sequence[str], member: str, block: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``_p``, ``_q`` (the two blocks that meet) and ``_side`` (which of the two a row is of).

    ``rows`` is a written table with one row per (keys, member). Rows of keys within a
    block come once, all others once per block of their key.
    """
    count = F.count(F.lit(1))
    heavy = cut_lineage(rows.groupBy(*keys).agg(count.alias("_n")).filter(F.col("_n") > block), "hot-keys")
    one = [F.lit(0).alias("_p"), F.lit(0).alias("_q"), F.lit(0).alias("_side")]
    if heavy.isEmpty():
        return rows.select("*", *one)
    many = F.ceil(F.col("_n") / block).cast("int")
    known = rows.join(pin_small(heavy.select(*keys, many.alias("_blocks"))), list(keys), "left").withColumn(
        "_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64(F.col(member), F.lit(1)), F.col("_blocks").cast("bigint")).cast("int")
    met = known.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.select(*rows.columns, F.least("_own", "_other").alias("_p"), F.greatest("_own", "_other").alias("_q"),
                      (F.col("_own") > F.col("_other")).cast("int").alias("_side"))


def compare_groups(rows: DataFrame, keys: Sequence[str], compare: Compare, schema: str, member: str,
                   block: int = BLOCK_ROWS) -> DataFrame:
    """What ``compare`` returns for all groups of ``rows`` that share ``keys``; integer keys."""
    kept = [c for c in rows.columns if c not in keys]
    ids = [*keys, "_p", "_q"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < BATCH_ROWS:
                continue
            whole = pa.concat_batches(held)
            last = np.flatnonzero(_borders(whole, ids))[-1]  # where the last group, maybe not whole, begins
            if last:
                yield from _compared(whole.slice(0, last), ids, kept, compare)
            held, size = [whole.slice(last)], whole.num_rows - last
        if size:
            yield from _compared(pa.concat_batches(held), ids, kept, compare)

    dealt = in_blocks(rows, keys, member, block).select(*ids, "_side", *kept)
    return shipped(dealt.repartition(*ids).sortWithinPartitions(*ids)).mapInArrow(run, schema)


def _borders(batch: pa.RecordBatch, ids: Sequence[str]) -> np.ndarray:
    """Whether each row is the first of its group."""
    first = np.zeros(batch.num_rows, bool)
    first[0] = True
    for name in ids:
        value = batch.column(name).to_numpy(zero_copy_only=False)
        first[1:] |= value[1:] != value[:-1]
    return first


def _compared(batch: pa.RecordBatch, ids: Sequence[str], kept: Sequence[str],
              compare: Compare) -> Iterator[pa.RecordBatch]:
    group = np.cumsum(_borders(batch, ids))
    sizes = np.bincount(group)
    shared = np.flatnonzero(sizes[group] > 1)
    if len(shared):
        inner = batch.take(pa.array(shared))
        # Blocks that meet themselves have one side only, all their pairs count.
        own = (inner.column("_p").to_numpy() == inner.column("_q").to_numpy())
        side = np.where(own, -1, inner.column("_side").to_numpy())
        yield from compare(inner.select([*kept, *[i for i in ids if not i.startswith("_")]]), group[shared], side)


def paired(group: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j), i < j, of all pairs to compare, in runs of equal distance; groups are consecutive rows.

    Rows of one group pair when they are of different sides, or of any two when the side is -1.
    """
    end = np.searchsorted(group, group, "right")
    sided, apart = (side >= 0).any(), 1
    left = np.arange(len(group))
    while len(left := left[left + apart < end[left]]):
        right = left + apart
        if sided:
            met = (side[left] < 0) | (side[left] != side[right])
            yield left[met], right[met]
        else:
            yield left, right
        apart += 1


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under the links (i, j)."""
    low = np.arange(n)
    while True:
        a, b = low[i], low[j]
        least = np.minimum(a, b)
        if (a == b).all():
            return low
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        while (low[low] != low).any():
            low = low[low]
