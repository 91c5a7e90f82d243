"""Positions, order statistics and exact quantiles that split hot groups.

A plain ``row_number``, ``rank`` or ``percentile`` sends a whole group to one task.
Here the distinct values of each group are counted first, so copies combine before
the shuffle, and written once. Groups whose distinct values fit a checked limit are
then ordered as a whole. Larger groups are cut into value ranges by a bounded
sketch; each range is ordered on its own and they are joined by running totals.
Both ways place the same rows and share all arithmetic, so they agree to the bit: the
sketch only decides where to cut.

Quantiles of whole columns are one path at any size: a sketch brackets each wanted row
by two values, the rows below these are counted in the tasks, and only rows inside
a bracket are shuffled.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlens.session import PIN_ROWS, cut_lineage, pin_small

GROUP_LIMIT = 1_000_000  # distinct values one task may order
RANGES = 256
SKETCH_ACCURACY = 2000
BRACKET_ROWS = 20_000  # rows between two values that one task orders in a fit
BRACKETS_PER_PASS = 100  # wanted quantiles, of all columns, in one pass
TASK_VALUES = 2_000_000  # values that one task turns from columns to rows and counts, about 80 bytes each
PIN_CUTS = 5000  # groups whose cuts (2 KB each) are broadcast


def part_hot_groups(values: DataFrame, keys: Sequence[str],
                    limit: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of the groups within ``limit`` and rows of the larger groups (None: no such rows).

    ``values`` is a written table, so counting all of it reads no values.
    """
    if not keys:
        return (None, values) if values.count() > limit else (values, None)
    heavy = (values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
             .filter(F.col("_rows") > limit).select(*keys))
    rows = heavy.limit(PIN_ROWS + 1).collect()
    if not rows:
        return values, None
    if len(rows) <= PIN_ROWS:
        heavy = F.broadcast(values.sparkSession.createDataFrame(rows, heavy.schema))
    return (values.join(heavy, list(keys), "left_anti"), values.join(heavy, list(keys), "left_semi"))


def split_ranges(values: DataFrame, keys: Sequence[str], order: str, ranges: int = RANGES) -> DataFrame:
    """Add ``_range``: the value range of each row within its group, in order of ``order``."""
    grid = F.lit([i / ranges for i in range(1, ranges)])
    cuts = F.percentile_approx(F.col(order).cast("double"), grid, SKETCH_ACCURACY)
    if keys:
        # Only hot groups come here, so the cuts are few; beyond the pin they join by shuffle.
        cut = values.join(pin_small(values.groupBy(*keys).agg(cuts.alias("_cuts")), PIN_CUTS), list(keys))
    else:
        cut = values.withColumn("_cuts", values.agg(cuts).scalar())
    return cut.withColumn("_range", cuts_below("_cuts", F.col(order).cast("double"), ranges)).drop("_cuts")


def cuts_below(cuts: str, value: Column, most: int) -> Column:
    """How many entries of a sorted array of at most ``most`` lie below ``value``, by halving steps."""
    steps = F.lit([1 << i for i in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(cuts, at + step - 1) < value, step).otherwise(0))


def _range_totals(ranged: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Per range: weight in the range, in the group's earlier ranges, and in the whole group."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(w).alias(f"_in_{w}") for w in weights])
    columns = []
    for w in weights:
        columns.append(F.coalesce(F.sum(f"_in_{w}").over(earlier), F.lit(0)).alias(f"_ahead_{w}"))
        columns.append(F.sum(f"_in_{w}").over(group).alias(f"{w}_total"))
    totals = totals.select(*keys, "_range", *[f"_in_{w}" for w in weights], *columns)
    # Without keys there are at most as many rows as ranges.
    return totals if keys else F.broadcast(totals)


def _running(by: Sequence[str], order: str):
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _whole(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def running_totals(values: DataFrame, keys: Sequence[str], order: str, weights: Sequence[str],
                   limit: int = GROUP_LIMIT, ranges: int = RANGES) -> DataFrame:
    """Add ``<w>_before`` and ``<w>_total`` for rows unique per (keys, order).

    ``<w>_before`` sums ``w`` over the smaller values of the group.
    """
    values = cut_lineage(values, "values")
    light, heavy = part_hot_groups(values, keys, limit)
    kept = [*values.columns]
    for w in weights:
        kept += [f"{w}_before", f"{w}_total"]
    parts = []
    if light is not None:
        run = _running(keys, order)
        parts.append(light.withColumns({
            **{f"{w}_before": F.coalesce(F.sum(w).over(run), F.lit(0)) for w in weights},
            **{f"{w}_total": F.sum(w).over(_whole(keys)) for w in weights}}).select(*kept))
    if heavy is not None:
        ranged = split_ranges(heavy, keys, order, ranges)
        joined = ranged.join(_range_totals(ranged, keys, weights), [*keys, "_range"])
        run = _running([*keys, "_range"], order)
        parts.append(joined.withColumns({
            f"{w}_before": F.col(f"_ahead_{w}") + F.coalesce(F.sum(w).over(run), F.lit(0))
            for w in weights}).select(*kept))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def value_positions(df: DataFrame, keys: Sequence[str], order: str, limit: int = GROUP_LIMIT) -> DataFrame:
    """Distinct values of each group with ``n`` copies, ``n_before`` smaller rows, ``n_total`` rows."""
    counted = (df.filter(F.col(order).isNotNull())
               .groupBy(*keys, order).agg(F.count(F.lit(1)).alias("n")))
    return running_totals(counted, keys, order, ["n"], limit)


def average_rank(df: DataFrame, key: str, order: str, into: str, limit: int = GROUP_LIMIT) -> DataFrame:
    """Rank from 1 within the group, ties sharing their mean rank; null stays null."""
    ranks = value_positions(df, [key], order, limit).select(
        key, order, (F.col("n_before") + (F.col("n") + 1) / 2).cast("double").alias(into))
    return df.join(ranks, [key, order], "left")


def _position(p: float) -> tuple[Column, Column, Column]:
    """Lower row, upper row and the share of the upper row for quantile ``p`` of ``n_total`` rows."""
    at = (F.col("n_total") - 1) * F.lit(float(p))
    # A hair of slack keeps products such as 0.95 * 20 on their integer.
    near = F.when(F.abs(at - F.rint(at)) < 1e-9, F.rint(at)).otherwise(at)
    return F.floor(near), F.ceil(near), near - F.floor(near)


def _wanted(probs: Sequence[float]) -> Column:
    """Whether a range holds a row that one of the quantiles needs."""
    wanted = F.lit(False)
    for p in probs:
        low, high, _ = _position(p)
        wanted = wanted | ((F.col("_ahead_n") <= high) & (F.col("_ahead_n") + F.col("_in_n") > low))
    return wanted


def _picked(near: DataFrame, ids: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles from rows with ``value``, its copies ``n``, the rows before it ``_run`` and ``n_total``."""
    def row(at: Column) -> Column:
        return F.max(F.when((F.col("_run") <= at) & (at < F.col("_run") + F.col("n")), F.col("value")))

    picks, results = [], []
    for i, p in enumerate(probs):
        low, high, part = _position(p)
        picks += [row(low).alias(f"_l{i}"), row(high).alias(f"_h{i}"), F.max(part).alias(f"_f{i}")]
        step = (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_f{i}")
        results.append((F.col(f"_l{i}") + step).alias(f"q{i}"))
    return near.groupBy(*ids).agg(*picks).select(*ids, *results)


def dealt(df: DataFrame, each: int, most: int = TASK_VALUES) -> DataFrame:
    """``df`` over so many tasks that none makes more than ``most`` rows when every row becomes ``each``.

    A scan's tasks are cut by bytes, so they would hold ever more of these rows up to that size.
    """
    parts = math.ceil(df.count() * each / most)
    return df.repartition(parts) if parts > 1 else df


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
                    limit: int = GROUP_LIMIT, ranges: int = RANGES) -> DataFrame:
    """Linearly interpolated quantiles: one row per (keys, ``stat``) with ``q0``, ``q1``, …

    Null and NaN values are left out.
    """
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    long = dealt(wide, len(cols)).unpivot(list(keys), list(cols), "stat", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value"))
    ids = [*keys, "stat"]
    counted = cut_lineage(long.groupBy(*ids, "value").agg(F.count(F.lit(1)).alias("n")), "values")
    light, heavy = part_hot_groups(counted, ids, limit)
    before = F.coalesce(F.sum("n").over(_running(ids, "value")), F.lit(0))
    near = light.withColumns({"_run": before, "n_total": F.sum("n").over(_whole(ids))})
    if heavy is not None:
        ranged = split_ranges(heavy, ids, "value", ranges)
        target = _range_totals(ranged, ids, ["n"]).filter(_wanted(probs))
        run = F.col("_ahead_n") + F.coalesce(F.sum("n").over(_running([*ids, "_range"], "value")), F.lit(0))
        near = near.unionByName(ranged.join(target, [*ids, "_range"]).withColumn("_run", run).select(*near.columns))
    return _picked(near, ids, probs)


def grouped_medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    limit: int = GROUP_LIMIT) -> DataFrame:
    """Exact median of each column per group, one row per group; null keys are left out."""
    medians = exact_quantiles(df.na.drop("any", subset=list(keys)), cols, [0.5], keys, limit)
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("stat") == c, F.col("q0"))).alias(c) for c in cols])


@dataclass
class _Gap:
    """Rows of a column strictly between two of its values (None: no bound), ``before`` smaller ones, and the rows wanted of them."""

    column: str
    low: float | None
    high: float | None
    before: int
    rows: int
    wanted: list[int]

    def holds(self, value: Column) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (value > F.lit(self.low))
        return inside if self.high is None else inside & (value < F.lit(self.high))


def _wanted_rows(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """Lower row, upper row and the share of the upper row of each quantile of ``n`` rows, as ``_position`` has them."""
    places = []
    for p in probs:
        at = (n - 1) * float(p)
        near = float(round(at)) if abs(at - round(at)) < 1e-9 else at
        places.append((math.floor(near), math.ceil(near), near - math.floor(near)))
    return places


def _brackets(shares: Sequence[float], accuracy: int) -> Column:
    """Shares a little below and above the wanted ones, by more than a sketch of that accuracy errs."""
    slack = 1.5 / accuracy
    return F.lit(sorted({min(max(s + d, 0.0), 1.0) for s in shares for d in (-slack, slack)}))


def _cut(wide: DataFrame, gaps: list[_Gap], cuts: list[list[float]], found: dict[tuple[str, int], float]) -> list[_Gap]:
    """Cut gaps at the given values of theirs; rows that are one of these are found, the others lie in a smaller gap."""
    marks = [(g, c) for g, values in zip(gaps, cuts) for c in values]
    counts = wide.agg(*[F.count_if(op(F.col(g.column), F.lit(c))) for g, c in marks for op in (operator.lt, operator.le)]).head()
    below = iter(zip(marks, counts[::2], counts[1::2]))
    smaller = []
    for gap, values in zip(gaps, cuts):
        low, before, end = gap.low, gap.before, gap.before + gap.rows
        for value in [*values, None]:
            less, upto = next(below)[1:] if value is not None else (end, end)
            wanted = [w for w in gap.wanted if before <= w < less]
            if wanted:
                smaller.append(_Gap(gap.column, low, gap.high if value is None else value, before, less - before, wanted))
            found.update({(gap.column, w): value for w in gap.wanted if less <= w < upto})
            low, before = value, upto
    return smaller


def _values_at(wide: DataFrame, gaps: list[_Gap], found: dict[tuple[str, int], float]) -> None:
    """Order the rows of gaps, each few, and add those wanted to ``found``."""
    number = F.lit(None).cast("int")
    columns = sorted({g.column for g in gaps})
    for i, g in enumerate(gaps):
        number = F.when((F.col("stat") == g.column) & g.holds(F.col("value")), F.lit(i)).otherwise(number)
    inside = wide.unpivot([], columns, "stat", "value").filter(F.col("value").isNotNull()).select(
        "value", number.alias("gap")).filter(F.col("gap").isNotNull())
    counted = inside.groupBy("gap", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = counted.withColumn("run", F.coalesce(F.sum("n").over(_running(["gap"], "value")), F.lit(0)))
    asked = wide.sparkSession.createDataFrame([(i, w - g.before) for i, g in enumerate(gaps) for w in g.wanted], "gap int, at long")
    hit = placed.join(F.broadcast(asked), "gap").filter((F.col("run") <= F.col("at")) & (F.col("at") < F.col("run") + F.col("n")))
    for row in hit.select("gap", "at", "value").collect():
        gap = gaps[row["gap"]]
        found[gap.column, row["at"] + gap.before] = row["value"]


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], ranges: int = SKETCH_ACCURACY,
                  few: int = BRACKET_ROWS) -> dict[str, list[float]]:
    """Quantiles of whole columns as parameters: one row per column reaches the driver.

    A sketch that cuts a column into about ``ranges`` parts brackets each wanted row by
    two of the column's values. The rows below and at these are counted in one pass without a shuffle, which
    tells exactly between which values a wanted row lies, also where the sketch missed it. Gaps of more
    than ``few`` rows are bracketed again; then only rows inside gaps are shuffled and ordered, gap by gap.
    Wide tables are read anew for every few columns, so that no plan grows with their number.
    """
    if not probs:
        return {c: [] for c in cols}
    step = max(1, BRACKETS_PER_PASS // len(probs))
    fitted: dict[str, list[float]] = {}
    for at in range(0, len(cols), step):
        fitted |= _fit_some(df, cols[at:at + step], probs, ranges, few)
    return fitted


def _fit_some(df: DataFrame, cols: Sequence[str], probs: Sequence[float], ranges: int, few: int) -> dict[str, list[float]]:
    names = [f"c{i}" for i in range(len(cols))]
    wide = df.select(*[F.col(c).cast("double").alias(n) for n, c in zip(names, cols)])
    wide = wide.select(*[F.when(~F.isnan(n), F.col(n)).alias(n) for n in names])
    edges = _brackets(probs, ranges)
    row = wide.agg(*[f.alias(f"{k}{n}") for n in names for k, f in (
        ("n", F.count(n)), ("at", F.percentile_approx(n, edges, ranges)))]).head()
    places = {n: _wanted_rows(row[f"n{n}"], probs) if row[f"n{n}"] else [] for n in names}
    found: dict[tuple[str, int], float] = {}
    gaps = [_Gap(n, None, None, 0, row[f"n{n}"], sorted({w for low, high, _ in places[n] for w in (low, high)}))
            for n in names if places[n]]
    ready = [g for g in gaps if g.rows <= few]
    open_gaps = [g for g in gaps if g.rows > few]
    cuts = [sorted(set(row[f"at{g.column}"])) for g in open_gaps]
    while open_gaps:
        smaller = _cut(wide, open_gaps, cuts, found)
        ready += [g for g in smaller if g.rows <= few]
        open_gaps = [g for g in smaller if g.rows > few]
        if open_gaps:
            cuts = [sorted(set(c)) for c in wide.agg(*[
                F.percentile_approx(F.when(g.holds(F.col(g.column)), F.col(g.column)),
                                    _brackets([(w - g.before) / max(g.rows - 1, 1) for w in g.wanted], ranges), ranges)
                for g in open_gaps]).head()]
    if ready:
        _values_at(wide, ready, found)
    results = {}
    for n, c in zip(names, cols):
        values = [(found[n, low], found[n, high], part) for low, high, part in places[n]]
        results[c] = [low + (high - low) * part for low, high, part in values] or [None] * len(probs)
    return results


def nth_smallest(df: DataFrame, order: str, count: int, limit: int = GROUP_LIMIT):
    """The ``count``-th smallest value of ``order`` (None when ``count`` is below 1)."""
    if count < 1:
        return None
    placed = value_positions(df, [], order, limit)
    return (placed.filter((F.col("n_before") < count) & (F.col("n_before") + F.col("n") >= count))
            .select(order).head()[0])
