"""Second-order factorization scores over long (row, feature, x) input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FACTORS = 1024


def _few_factors(factors: DataFrame) -> list | None:
    """The factors' numbers; None when there are too many to lie side by side."""
    found = factors.select("k").distinct().limit(MAX_FACTORS + 1).collect()
    return sorted(row["k"] for row in found) if len(found) <= MAX_FACTORS else None


def interactions(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """The interaction of each factor on its own as (row, k, bi), for any number of factors.

    Rows meet a feature's factors one by one and are added up by (row, k), before the shuffle and after it.
    """
    vx = F.col("v") * F.col("x")
    sums = rows.join(factors, "feature").groupBy("row", "k").agg(F.sum(vx).alias("s"), F.sum(vx * vx).alias("q"))
    return sums.select("row", "k", ((F.col("s") * F.col("s") - F.col("q")) / 2).alias("bi"))


def _linear_part(rows: DataFrame, linear: DataFrame | None) -> DataFrame:
    if linear is None:
        return rows.groupBy("row").agg(F.lit(0.0).alias("linear"))
    weighted = rows.join(linear.select("feature", F.col("w").alias("_w")), "feature", "left")
    return weighted.groupBy("row").agg(F.sum(F.coalesce("_w", F.lit(0.0)) * F.col("x")).alias("linear"))


def _factor_sums(rows: DataFrame, factors: DataFrame, linear: DataFrame | None) -> tuple[DataFrame, list[int]]:
    """Per row: sum of v x and of v² x² for every factor, and the linear part.

    Factors lie side by side, so a row's features are shuffled once, whatever the
    number of factors, and are combined before it.
    """
    ks = _few_factors(factors)
    if ks is None:
        raise ValueError(f"over {MAX_FACTORS} factors: use interactions(), which has a row for each")
    wide = factors.groupBy("feature").agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"_v{k}") for k in ks])
    joined = rows.join(wide, "feature", "left")
    weight: Column = F.lit(0.0)
    if linear is not None:
        joined = joined.join(linear.select("feature", F.col("w").alias("_w")), "feature", "left")
        weight = F.coalesce("_w", F.lit(0.0)) * F.col("x")
    sums = [F.sum(weight).alias("linear")]
    for k in ks:
        vx = F.coalesce(f"_v{k}", F.lit(0.0)) * F.col("x")
        sums += [F.sum(vx).alias(f"_s{k}"), F.sum(vx * vx).alias(f"_q{k}")]
    return joined.groupBy("row").agg(*sums), ks


def _interaction(k: int) -> Column:
    return (F.col(f"_s{k}") * F.col(f"_s{k}") - F.col(f"_q{k}")) / 2


def fm_score(rows: DataFrame, factors: DataFrame, linear: DataFrame | None = None, bias: float = 0.0) -> DataFrame:
    """Linear part plus all pairwise interactions, as (row, score); beyond ``MAX_FACTORS`` these are added up by (row, k)."""
    if _few_factors(factors) is None:
        pairs = interactions(rows, factors).groupBy("row").agg(F.sum("bi").alias("bi"))
        return _linear_part(rows, linear).join(pairs, "row", "left").select(
            "row", (F.col("linear") + bias + F.coalesce("bi", F.lit(0.0))).alias("score"))
    sums, ks = _factor_sums(rows, factors, linear)
    return sums.select("row", sum((_interaction(k) for k in ks), F.col("linear") + bias).alias("score"))


def bi_interaction(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """The interaction of each factor on its own, as (row, bi_0, bi_1, …)."""
    sums, ks = _factor_sums(rows, factors, None)
    return sums.select("row", *[_interaction(k).alias(f"bi_{k}") for k in ks])
