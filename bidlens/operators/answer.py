"""Bid-aware shaping of predictions, ranking metrics and fold summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.functions.metrics import Metric
from bidlens.functions.scalar import blend_fixed, clip_low, round_half_even
from bidlens.operators.ranking import GROUP_LIMIT, average_rank, running_totals, value_positions
from bidlens.session import cut_lineage

BID_STEP = 1e-4  # fixed value: prediction gap between neighbouring bids


def group_size(df: DataFrame, key: str = "ad_id", into: str = "size") -> DataFrame:
    """Rows per key, as a table; a window would gather a hot key in one task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(into))


def groups_of_size(df: DataFrame, size: int, key: str = "ad_id") -> DataFrame:
    """Rows of the groups with exactly ``size`` rows."""
    return df.join(group_size(df, key).filter(F.col("size") == size), key, "left_semi")


def bid_places(df: DataFrame, key: str, bid: str, limit: int = GROUP_LIMIT) -> DataFrame:
    """Per (key, bid): mean rank of the bid, and ``mid``, the rank of the key's middle row."""
    sizes = group_size(df, key).select(key, F.ceil(F.col("size") / 2).alias("mid"))
    placed = value_positions(df, [key], bid, limit).withColumn(
        "bid_rank", (F.col("n_before") + (F.col("n") + 1) / 2).cast("double"))
    return placed.join(sizes, key)


def middle_bid_row(df: DataFrame, value: str, key: str = "ad_id", bid: str = "bid",
                   row: str = "test_id", strict: bool = False, places: DataFrame | None = None) -> DataFrame:
    """Value at the middle bid of each key.

    The default picks one row, the first by ``row`` among equal middle bids. ``strict``
    takes every row whose mean rank is the middle rank: with tied bids none or several.
    """
    placed = places if places is not None else bid_places(df, key, bid)
    if strict:
        hit = placed.filter(F.col("bid_rank") == F.col("mid"))
        return df.select(key, bid, value).join(hit.select(key, bid), [key, bid]).select(key, value)
    at = F.ceil(F.col("n_total") / 2)
    hit = placed.filter((F.col("n_before") < at) & (at <= F.col("n_before") + F.col("n")))
    return (df.select(key, bid, row, value).join(hit.select(key, bid), [key, bid])
            .groupBy(key).agg(F.min_by(value, row).alias(value)))


def bid_rank_centered(df: DataFrame, key: str = "ad_id", bid: str = "bid") -> DataFrame:
    """Rank of the bid counted from the key's middle rank."""
    placed = bid_places(df, key, bid).select(key, bid, (F.col("bid_rank") - F.col("mid")).alias("bid_offset"))
    return df.join(placed, [key, bid], "left")


def answer_by_bid(df: DataFrame, value: str = "predict_val", key: str = "ad_id", bid: str = "bid",
                  row: str = "test_id", strict: bool = False) -> DataFrame:
    """Spread the middle-bid prediction over the ad, at least 1, rising slightly with the bid."""
    placed = cut_lineage(bid_places(df, key, bid), "places")
    middle = middle_bid_row(df, value, key, bid, row, strict, placed)
    offsets = placed.select(key, bid, (F.col("bid_rank") - F.col("mid")).alias("_offset"))
    spread = df.drop(value).join(offsets, [key, bid], "left").join(middle, key, "left")
    return spread.withColumn(value, clip_low(value) + F.col("_offset") * BID_STEP).select(row, value)


def answer_with_bid(df: DataFrame, value: str = "predict_val", key: str = "ad_id", bid: str = "bid",
                    row: str = "test_id") -> DataFrame:
    """Each row's own prediction, rising slightly with the bid."""
    ranked = average_rank(df, key, bid, "_rank")
    return ranked.select(row, (F.col(value) + F.col("_rank") * BID_STEP).alias(value))


def final_answer(df: DataFrame, tree_fm: str, tree: str, net: str, key: str = "ad_id", bid: str = "bid",
                 row: str = "test_id", strict: bool = False) -> DataFrame:
    """Blend the three models, round half to even, and shape by bid."""
    blended = df.select(row, key, bid, round_half_even(blend_fixed(tree_fm, tree, net)).alias("predict_val"))
    return answer_by_bid(blended, key=key, bid=bid, row=row, strict=strict)


def auc_score(df: DataFrame, label: str, score: str, limit: int = GROUP_LIMIT) -> DataFrame:
    """Area under the ROC curve, ties counting half."""
    positive = F.col(label).cast("double") > 0
    counted = df.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    ranked = running_totals(counted, [], "_s", ["neg"], limit)
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return ranked.agg((won / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def fold_scores(df: DataFrame, label: str, prediction: str, metric: Metric, fold: str = "fold") -> DataFrame:
    """Score per fold as ``fold``, ``score``."""
    return df.groupBy(fold).agg(metric(F.col(label), F.col(prediction)).alias("score"))


def fold_summary(df: DataFrame, label: str, prediction: str, metric: Metric, fold: str = "fold") -> DataFrame:
    """Mean and population deviation over the folds, and the score of all rows together."""
    folds = fold_scores(df, label, prediction, metric, fold)
    total = df.agg(metric(F.col(label), F.col(prediction)).alias("total_score"))
    return folds.agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score")).withColumn(
        "total_score", total.scalar())
