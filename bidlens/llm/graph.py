"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bidlens.session import cut_lineage


ROWS_PER_TASK = 200_000


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, whose rows are about as many as told, in no more tasks than these are worth; many rows stay as they are."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)))


def _written(edges: DataFrame, rows: int | None = None) -> tuple[DataFrame, tuple]:
    """Distinct ``edges`` as a written table, and what tells one set of edges from another, observed while writing."""
    seen = Observation()
    marks = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
             F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")).alias("s")]
    table = cut_lineage((edges.distinct() if rows is None else _few(edges.distinct(), rows)).observe(seen, *marks), "edges")
    return table, tuple(seen.get[k] for k in ("n", "x", "s"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Alternating large and small stars: each node passes its smallest neighbour on,
    first to its larger neighbours, then to its smaller ones, until every edge points
    to its component's smallest node. Minima are combined before the shuffle, and a
    node's among all its neighbours is written before it is joined, so that a hub is a skewed join,
    which adaptive execution splits. Rounds are logarithmic, and each is a written table.
    """
    own = F.col("a") != F.col("b")
    stars, state = _written(edges.filter(own).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while state[0]:
        both = stars.union(stars.select("b", "a"))
        count = 2 * state[0]
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        low = cut_lineage(_few(low, count), "low")
        # Read twice, and one row per edge, so it is written as well.
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = cut_lineage(_few(large, count), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = _few(large.join(low, "a"), count).select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
        before = state
        stars, state = _written(small.select("e.a", F.col("e.low").alias("b")).filter(own), count)
        if state == before:
            break
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
