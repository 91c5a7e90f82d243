"""Feature scores and feature lists."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlens.operators.ranking import GROUP_LIMIT, value_positions
from bidlens.session import cut_lineage

PairScore = Callable[[Column, Column], Column]
SCORES_PER_PASS = 200
CLUMPS = 256  # places a free line may take, a power of two
GRID_POWER = 0.6  # fixed value: a grid may have up to n^0.6 cells

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this module


def relation_scores(df: DataFrame, features: Sequence[str], label: str, score: PairScore = F.corr) -> DataFrame:
    """Score of each feature against the label, as ``feature``, ``score``.

    ``score`` maps (feature, label) to an aggregate column. All features are scored in one
    pass over the unchanged rows; only the single result row is turned.
    """
    y = F.col(label).cast("double")
    parts = []
    for at in range(0, len(features), SCORES_PER_PASS):
        names = list(features[at:at + SCORES_PER_PASS])
        row = df.agg(*[score(F.col(f).cast("double"), y).alias(f) for f in names])
        parts.append(row.unpivot([], names, "feature", "score"))
    return reduce(DataFrame.unionByName, parts)


def _upper_bound(value: Column, starts: Column, size: int) -> Column:
    """How many of the ascending ``starts`` are at or below the value, by bisection."""
    steps = F.lit([1 << i for i in reversed(range(size.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= size) & (F.element_at(starts, F.least(at + s, F.lit(size))) <= value), at + s).otherwise(at))


def equal_frequency_bins(df: DataFrame, cols: Sequence[str], bins: int, limit: int = GROUP_LIMIT) -> dict[str, Column]:
    """Per column its bin from 0: rows below the value, times ``bins``, over all rows, rounded down.

    Only the smallest value of each bin reaches the driver. ``df`` is a written table of doubles.
    """
    placed = value_positions(df.unpivot([], list(cols), "stat", "value"), ["stat"], "value", limit)
    at = F.floor(F.col("n_before") * bins / F.col("n_total")).cast("int")
    starts: dict[str, list] = {c: [] for c in cols}
    for row in placed.groupBy("stat", at.alias("bin")).agg(F.min("value").alias("start")).collect():
        starts[row["stat"]].append((row["bin"], row["start"]))
    found = {}
    for c, edges in starts.items():
        numbers, lows = zip(*sorted(edges))
        found[c] = F.element_at(F.lit(list(numbers)), _upper_bound(F.col(c), F.lit([float(v) for v in lows]), len(lows)))
    return found


def mic_scores(df: DataFrame, features: Sequence[str], label: str, power: float = GRID_POWER,
               limit: int = GROUP_LIMIT) -> DataFrame:
    """Information coefficient in [0, 1] of each feature with the label.

    The highest normalised mutual information over all grids of equal-frequency bins, powers
    of two per axis, with at most n^power cells (at least 4). Grids with freely placed lines
    could reach more, so this bounds the maximal information coefficient from below.

    Rows are counted once, by their places on the finest bins. For each number of bins of the feature these
    counts are summed on the grid with the most bins of the label; the other grids are sums of these.
    """
    names = [*features, label]
    used = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in names]).na.drop("any"), "pairs")
    rows = used.count()
    if not rows:
        return df.sparkSession.createDataFrame([], "feature string, score double")
    cells = max(rows ** power, 4.0)
    widest = [1 << i for i in range(1, 63) if 2 << i <= cells]
    finest = widest[-1]
    bins = equal_frequency_bins(used, names, finest, limit)
    binned = used.select(*[bins[c].alias(f"b{i}") for i, c in enumerate(names)])
    last = f"b{len(features)}"
    grids = F.lit([[a, max(b for b in widest if a * b <= cells)] for a in widest])
    # Rows of one place on the finest bins count together, so that each row is counted once and not once a grid.
    places = binned.unpivot([last], [f"b{i}" for i in range(len(features))], "_f", "bx").groupBy(
        "_f", "bx", F.col(last).alias("by")).agg(F.count(F.lit(1)).alias("n"))
    long = places.select("_f", "bx", "by", "n", F.explode(grids).alias("_g"))

    def shrunk(number: str, of: Column, into: Column) -> Column:
        return F.floor(F.col(number).cast("bigint") * into / of)

    full = long.select("_f", "n", F.col("_g")[0].alias("a"), F.col("_g")[1].alias("most"), shrunk("bx", F.lit(finest), F.col("_g")[0]).alias("bx"),
                       shrunk("by", F.lit(finest), F.col("_g")[1]).alias("by")).groupBy("_f", "a", "most", "bx", "by").agg(
        F.sum("n").alias("n"))
    spread_out = full.withColumn("b", F.explode(F.filter(F.lit(widest), lambda b: b <= F.col("most"))))
    grid = ["_f", "a", "b"]
    coarse = spread_out.groupBy(*grid, "bx", shrunk("by", F.col("most"), F.col("b")).alias("by")).agg(F.sum("n").alias("n"))
    over = lambda *extra: F.sum("n").over(Window.partitionBy(*grid, *extra))
    shares = coarse.withColumns({"nx": over("bx"), "ny": over("by"), "nn": over()})
    part = F.col("n") / F.col("nn") * F.log(F.col("n").cast("double") * F.col("nn") / (F.col("nx").cast("double") * F.col("ny")))
    info = shares.groupBy(*grid).agg(F.sum(part).alias("mi"))
    best = info.groupBy("_f").agg(
        F.max(F.greatest(F.col("mi"), F.lit(0.0)) / F.log(F.least("a", "b").cast("double"))).alias("score"))
    titles = F.create_map(*[F.lit(v) for i, f in enumerate(features) for v in (f"b{i}", f)])
    return best.select(titles[F.col("_f")].alias("feature"), "score")


def _xlogx(c: np.ndarray) -> np.ndarray:
    return c * np.log(np.maximum(c, 1))


def best_lines(table: np.ndarray, lines: int) -> float:
    """Highest normalised information over all ways to join the table's rows, in order, to 2..``lines`` runs; columns stay.

    Dynamic programming over the last run's start: ``saved[j]`` is the best sum of c log c of the cells, less that
    of the runs, over the first j rows.
    """
    table = table[:, table.sum(axis=0) > 0].astype(np.float64)
    n, b = table.sum(), table.shape[1]
    if b < 2 or len(table) < 2:
        return 0.0
    upto = np.concatenate([np.zeros((1, b)), np.cumsum(table, axis=0)])
    totals = upto.sum(axis=1)
    run = np.full((len(upto), len(upto)), -np.inf)
    for i in range(len(table)):
        run[i, i + 1:] = _xlogx(upto[i + 1:] - upto[i]).sum(axis=1) - _xlogx(totals[i + 1:] - totals[i])
    own = np.log(n) - _xlogx(table.sum(axis=0)).sum() / n
    saved, best = run[0].copy(), 0.0
    for count in range(2, min(lines, len(table)) + 1):
        saved = np.maximum(saved, (saved[:, None] + run).max(axis=0))
        best = max(best, (own + saved[-1] / n) / np.log(min(count, b)))
    return best


def free_line_scores(df: DataFrame, features: Sequence[str], label: str, power: float = GRID_POWER,
                     limit: int = GROUP_LIMIT) -> DataFrame:
    """Information coefficient in [0, 1] of each feature with the label, one axis of a grid cut freely.

    For every power of two b, one axis has b equal-frequency bins; the other's lines are placed best over up to
    ``CLUMPS`` equal-frequency clumps, as many lines as n^power cells allow, by dynamic programming; both
    axes take both parts. The result is never below that of ``mic_scores``, whose grids with more lines count too.

    Places of values are joined as tables. What one task holds is a table of clumps and bins, bounded by the
    cells and not by the rows; only sums go there.
    """
    names = [*features, label]
    used = cut_lineage(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]).na.drop("any"), "pairs")
    rows = used.count()
    if not rows:
        return df.sparkSession.createDataFrame([], "feature string, score double")
    cells = max(rows ** power, 4.0)
    most = [1 << i for i in range(1, 63) if 2 << i <= cells]
    last = f"c{len(features)}"
    placed = cut_lineage(value_positions(used.unpivot([], used.columns, "stat", "value"), ["stat"], "value", limit)
                         .select("stat", "value", "n_before"), "places")
    own = placed.filter(F.col("stat") == last).select(F.col("value").alias(last), F.col("n_before").alias("y"))
    others = placed.filter(F.col("stat") != last).withColumnRenamed("n_before", "x")
    long = used.join(own, last).unpivot(["y"], used.columns[:-1], "stat", "value").join(others, ["stat", "value"])

    def at(place: str, of: Column | int) -> Column:
        return F.floor(F.col(place) * of / rows)

    fine = long.select("stat", F.explode(F.array(
        F.struct(F.lit(False).alias("turned"), at("x", CLUMPS).alias("clump"), at("y", most[-1]).alias("bin")),
        F.struct(F.lit(True).alias("turned"), at("y", CLUMPS).alias("clump"), at("x", most[-1]).alias("bin")))).alias("c"))
    fine = cut_lineage(fine.groupBy("stat", "c").agg(F.count(F.lit(1)).alias("n")), "cells").select("stat", "c.*", "n")
    # With few lines, fewer clumps will do: sixteen to a line.
    clumps = [min(CLUMPS, 1 << (int(16 * cells / b) - 1).bit_length()) for b in most]
    levels = F.lit([[b, k] for b, k in zip(most, clumps)])
    grids = fine.select("stat", "turned", "clump", "bin", "n", F.explode(levels).alias("l")).groupBy(
        "stat", "turned", F.col("l")[0].alias("b"), F.floor(F.col("clump") * F.col("l")[1] / CLUMPS).alias("clump"),
        F.floor(F.col("bin").cast("bigint") * F.col("l")[0] / most[-1]).alias("bin")).agg(F.sum("n").alias("n"))

    def scored(table: pa.Table) -> pa.Table:
        clump, of_clump = np.unique(table.column("clump").to_numpy(), return_inverse=True)
        bins, of_bin = np.unique(table.column("bin").to_numpy(), return_inverse=True)
        whole = np.zeros((len(clump), len(bins)), np.int64)
        whole[of_clump, of_bin] = table.column("n").to_numpy()
        b = table.column("b")[0].as_py()
        return table.slice(0, 1).select(["stat"]).append_column("score", pa.array([best_lines(whole, int(cells // b))]))

    found = grids.groupBy("stat", "turned", "b").applyInArrow(scored, "stat string, score double")
    titles = F.create_map(*[F.lit(v) for i, f in enumerate(features) for v in (f"c{i}", f)])
    free = found.select(titles[F.col("stat")].alias("feature"), F.least("score", F.lit(1.0)).alias("score"))
    return free.unionByName(mic_scores(df, features, label, power, limit)).groupBy("feature").agg(F.max("score").alias("score"))


def mic_pair(df: DataFrame, x: str, y: str, **options) -> DataFrame:
    return mic_scores(df, [x], y, **options).select("score")


def top_features(importance: DataFrame, step: int, target: int, count: int) -> DataFrame:
    """Keep the ``max(count - step, target)`` most important of ``count`` features."""
    return importance.orderBy(F.desc("importance"), "feature").limit(max(count - step, target))


def bottom_features(importance: DataFrame, step: int) -> DataFrame:
    """The ``step`` least important features."""
    return importance.orderBy("importance", "feature").limit(step)


def feature_intersection(lists: Sequence[DataFrame]) -> DataFrame:
    """Features found in every list."""
    return reduce(DataFrame.intersect, [names.select("feature") for names in lists])
