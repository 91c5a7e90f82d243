"""Diffusion of node features along edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.session import cut_lineage, pin_small


def diffusion_features(edges: DataFrame, nodes: DataFrame, features: Sequence[str], hops: int,
                       node: str = "node") -> DataFrame:
    """Features of each node after 0 … ``hops - 1`` steps, as (node, hop, features…).

    Step h holds the mean over the out-neighbours of their step h - 1; repeated edges
    count once. A node without out-edges is null after step 0, and null neighbours
    are left out of a mean.

    Each step joins the edges to one row per node and averages by source. It is
    written out before the next, so the plan does not grow with the hops.
    """
    links = cut_lineage(edges.select("src", "dst").distinct(), "links")
    ids = nodes.select(node)
    state = nodes.select(node, *features)
    out = state.withColumn("hop", F.lit(0))
    for hop in range(1, hops):
        values = state.select(F.col(node).alias("dst"), *features)
        means = links.join(values, "dst").groupBy("src").agg(*[F.avg(f).alias(f) for f in features])
        state = cut_lineage(ids.join(means.withColumnRenamed("src", node), node, "left"), "hop")
        out = out.unionByName(state.withColumn("hop", F.lit(hop)))
    return out.select(node, "hop", *features)


def diffusion_weighted(diffused: DataFrame, weights: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scale each (hop, feature) by its weight; ``weights`` has one row per hop."""
    named = weights.select("hop", *[F.col(f).alias(f"_w_{f}") for f in features])
    joined = diffused.join(pin_small(named), "hop")
    return joined.withColumns({f: F.col(f) * F.col(f"_w_{f}") for f in features}).drop(*[f"_w_{f}" for f in features])
