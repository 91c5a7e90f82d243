"""Cleaning and encoding: a fit yields a small table or a few numbers, a transform applies it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.functions.scalar import EPOCH, safe_ratio
from bidlens.operators.ranking import fit_quantiles, running_totals
from bidlens.session import pin_small

Rule = Callable[[DataFrame], DataFrame]


def union_sets(sets: dict[str, DataFrame], origin: str = "origin") -> DataFrame:
    """Stack data sets by column name, remembering where each row came from."""
    stacked = None
    for name, df in sets.items():
        marked = df.withColumn(origin, F.lit(name))
        stacked = marked if stacked is None else stacked.unionByName(marked, allowMissingColumns=True)
    return stacked


def split_back(stacked: DataFrame, name: str, origin: str = "origin") -> DataFrame:
    return stacked.filter(F.col(origin) == name).drop(origin)


def select_by_pattern(df: DataFrame, fixed: Sequence[str], marks: Sequence[str] = ("_2day", "_3day")) -> DataFrame:
    """The fixed columns and every column whose name contains one of ``marks``."""
    named = [c for c in df.columns if c not in fixed and any(m in c for m in marks)]
    return df.select(*fixed, *named)


def drop_uninformative(df: DataFrame, rule: Rule | None = None) -> DataFrame:
    """Drop columns that are all null, then those with a single value; or apply ``rule`` instead."""
    if rule is not None:
        return rule(df)
    aggs = []
    for i, c in enumerate(df.columns):
        aggs += [F.count(c).alias(f"n{i}"), (F.max(c) == F.min(c)).alias(f"same{i}")]
    row = df.agg(*aggs).head()
    return df.select(*[c for i, c in enumerate(df.columns) if row[f"n{i}"] and not row[f"same{i}"]])


def value_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value of each column (smallest on a tie) as ``stat``, ``mode``.

    Columns share one type. Values are counted across the cluster first, so no task
    holds all distinct values of a column.
    """
    counted = (df.select(*cols).unpivot([], list(cols), "stat", "value")
               .filter(F.col("value").isNotNull()).groupBy("stat", "value").agg(F.count(F.lit(1)).alias("n")))
    return counted.groupBy("stat").agg(F.min(F.struct(-F.col("n"), "value"))["value"].alias("mode"))


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, bounds, mean and mode of numeric columns, one row per column."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "stat", "value")
    basic = long.groupBy("stat").agg(F.count("value").alias("n"), F.min("value").alias("low"),
                                     F.max("value").alias("high"), F.avg("value").alias("mean"))
    return basic.join(value_modes(wide, cols), "stat", "left")


def distinct_values(df: DataFrame, col: str, order: str) -> DataFrame:
    """Distinct values with the place of their first appearance, counted from 0.

    ``order`` is a numeric row order.
    """
    first = df.groupBy(col).agg(F.min(order).alias("_first"), F.lit(1).cast("bigint").alias("_one"))
    return running_totals(first, [], "_first", ["_one"]).select(col, F.col("_one_before").alias("place"))


def _mean_fill(df: DataFrame, col: str) -> tuple[Column, Column] | None:
    """(aggregate, fill from its value ``_mean``) of a column with a mean; None for text."""
    kind, mean = df.schema[col].dataType, F.col("_mean")
    if isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.DateType):
        return F.avg(F.unix_date(col)), F.date_from_unix_date(F.floor(mean).cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.avg(F.unix_micros(col)), F.timestamp_micros(F.floor(mean))
    if isinstance(kind, T.TimestampNTZType):
        start = F.lit(EPOCH).cast("timestamp_ntz")
        return (F.avg(F.timestamp_diff("MICROSECOND", start, F.col(col))),
                F.timestamp_add("MICROSECOND", F.floor(mean), start))
    return F.avg(F.col(col).cast("double")), mean


def impute_with_flag(df: DataFrame, cols: Sequence[str] | None = None, rule: Rule | None = None) -> DataFrame:
    """Fill partly missing columns and add a ``<col>_na`` flag: texts by their mode, others by their mean.

    Dates and times are rounded down; other columns become double, as a mean is fractional.
    """
    if rule is not None:
        return rule(df)
    cols = list(cols or df.columns)
    means = {c: _mean_fill(df, c) for c in cols}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
                 *[means[c][0].alias(f"mean{i}") for i, c in enumerate(cols) if means[c]]).head()
    partial = [(i, c) for i, c in enumerate(cols) if 0 < row[f"n{i}"] < row["rows"]]
    texts = [c for _, c in partial if means[c] is None]
    modes = {m["stat"]: m["mode"] for m in value_modes(df, texts).collect()} if texts else {}
    filled = df
    for i, c in partial:
        filled = filled.withColumn(f"{c}_na", F.col(c).isNull().cast("int"))
        if c in modes:
            filled = filled.withColumn(c, F.coalesce(F.col(c), F.lit(modes[c])))
        else:
            fill = filled.withColumn("_mean", F.lit(row[f"mean{i}"]).cast("double"))
            timed = isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            kept = F.col(c) if timed else F.col(c).cast("double")
            filled = fill.withColumn(c, F.coalesce(kept, means[c][1])).drop("_mean")
    return filled


def fit_categories(df: DataFrame, col: str, order: str, max_columns: int = 2000) -> list:
    """Categories by first appearance, for ``one_hot``; more of them call for ``one_hot_vector``."""
    rows = distinct_values(df, col, order).limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"{col} has over {max_columns} categories; use one_hot_vector")
    return [row[col] for row in sorted(rows, key=lambda row: row["place"])]


def one_hot(df: DataFrame, col: str, categories: Sequence) -> DataFrame:
    """Replace ``col`` by one 0/1 column per category, named ``<col>_<value>``."""
    hot = {f"{col}_{v}": F.col(col).eqNullSafe(F.lit(v)).cast("int") for v in categories}
    return df.withColumns(hot).drop(col)


def one_hot_vector(fitted_on: DataFrame, df: DataFrame, col: str, order: str) -> DataFrame:
    """Sparse one-hot vector ``<col>_hot`` by place of first appearance, for any number of categories.

    Only their number reaches the driver; the index itself is a table.
    """
    index = fit_index(fitted_on, [col], order)
    places = index_encode(df, index, "_at")
    encoder = OneHotEncoder(inputCols=[f"{col}_at"], outputCols=[f"{col}_hot"], dropLast=False)
    return encoder.fit(index_encode(fitted_on, index, "_at")).transform(places).drop(f"{col}_at")


def min_max_scale(fitted_on: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale to [0, 1] by the bounds of ``fitted_on``; a constant column becomes 0."""
    row = fitted_on.agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(cols)
                          for n, f in (("low", F.min), ("high", F.max))]).head()
    scaled = {}
    for i, c in enumerate(cols):
        low, high = row[f"low{i}"], row[f"high{i}"]
        if low is not None:
            span = high - low
            scaled[c] = (F.col(c) - low) / span if span else F.when(F.col(c).isNotNull(), F.lit(0.0))
    return df.withColumns(scaled)


def frequency_table(sets: Sequence[DataFrame], col: str) -> DataFrame:
    """Rows per value over all sets; null is a value of its own."""
    stacked = sets[0].select(col)
    for other in sets[1:]:
        stacked = stacked.unionByName(other.select(col))
    return stacked.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _lookup(table: DataFrame, col: str, value: str) -> DataFrame:
    return pin_small(table.select(F.col(col).alias("_key"), F.col(value).alias("_value")))


def _attach(df: DataFrame, lookup: DataFrame, col: str, into: str) -> DataFrame:
    """Look ``col`` up in a table unique on it, null matching null."""
    joined = df.join(lookup, F.col(col).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn(into, F.col("_value")).drop("_key", "_value")


def fit_frequency(sets: Sequence[DataFrame], cols: Sequence[str]) -> dict[str, DataFrame]:
    """Lookup table of occurrences over all sets, per column."""
    return {c: _lookup(frequency_table(sets, c), c, "n") for c in cols}


def frequency_encode(df: DataFrame, fitted: dict[str, DataFrame], suffix: str = "") -> DataFrame:
    """Replace ids by how often they occur in the fitted sets together."""
    for c, lookup in fitted.items():
        df = _attach(df, lookup, c, c + suffix)
    return df


def fit_index(fitted_on: DataFrame, cols: Sequence[str], order: str) -> dict[str, DataFrame]:
    """Lookup table of the place of first appearance, per column."""
    return {c: _lookup(distinct_values(fitted_on, c, order), c, "place") for c in cols}


def index_encode(df: DataFrame, fitted: dict[str, DataFrame], suffix: str = "") -> DataFrame:
    """Replace values by their place of first appearance; a value not fitted raises."""
    for c, lookup in fitted.items():
        df = _attach(df, lookup, c, "_place")
        shown = F.coalesce(F.col(c).cast("string"), F.lit("null"))
        unseen = F.raise_error(F.concat(F.lit(f"unseen value in {c}: "), shown)).cast("bigint")
        df = df.withColumn(c + suffix, F.coalesce("_place", unseen)).drop("_place")
    return df


def vector_entries(vector: Column | str) -> Column:
    """Positions ``at`` and ``values`` that a sparse vector holds; rows never hold its length."""
    entries = F.udf(lambda v: None if v is None else (v.indices.tolist(), v.values.tolist()),
                    "at array<bigint>, values array<double>")
    return entries(vector)


def nominal(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Mark columns that hold codes from 0 as categories, so that trees split them by sets of codes."""
    marked = {c: F.col(c).cast("double").alias(c, metadata={"ml_attr": {"name": c, "type": "nominal", "num_vals": n}})
              for c, n in sizes.items()}
    return df.select(*[marked.get(c, F.col(c)) for c in df.columns])


def most_categories(df: DataFrame, cols: Sequence[str]) -> int:
    """Size of the largest column marked by ``nominal``; 0 without one."""
    return max((df.schema[c].metadata.get("ml_attr", {}).get("num_vals", 0) for c in cols), default=0)


def fit_percentile_scale(df: DataFrame, cols: Sequence[str], percentile: float = 90) -> dict[str, tuple[float, float, float]]:
    """Per column: minimum, percentile above the minimum, mean of the scaled column.

    Nearly constant columns are left out.
    """
    row = df.agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(cols)
                   for n, f in (("low", F.min), ("std", F.stddev_samp), ("mean", F.avg))]).head()
    varied = [(i, c) for i, c in enumerate(cols) if (row[f"std{i}"] or 0.0) > 1e-5]
    tops = fit_quantiles(df, [c for _, c in varied], [percentile / 100]) if varied else {}
    fitted = {}
    for i, c in varied:
        low, span = row[f"low{i}"], tops[c][0] - row[f"low{i}"]
        fitted[c] = (low, span, (row[f"mean{i}"] - low) / span if span else 0.0)
    return fitted


def percentile_scale(df: DataFrame, fitted: dict[str, tuple[float, float, float]]) -> DataFrame:
    """(x - min) / percentile - mean; null where the percentile equals the minimum."""
    return df.withColumns({
        c: safe_ratio(F.col(c).cast("double") - low, F.lit(span)) - mean
        for c, (low, span, mean) in fitted.items()})


def fit_quantile_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner edges of equal-frequency bins; equal edges collapse, as does one at the minimum."""
    found = fit_quantiles(df, cols, [i / bins for i in range(bins)])
    return {c: sorted({e for e in edges[1:] if e is not None and e > edges[0]}) for c, edges in found.items()}


def quantile_bin(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Replace values by the number of inner edges at or below them."""
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), sum(((F.col(c) >= e).cast("int") for e in inner), F.lit(0)))
        for c, inner in edges.items()})


def fit_sqrt_label(df: DataFrame, label: str, percentile: float = 90) -> float:
    """Percentile of the square root of the label."""
    roots = df.select(F.sqrt(label).alias("_root"))
    return fit_quantiles(roots, ["_root"], [percentile / 100])["_root"][0]


def sqrt_label(label: Column | str, ratio: float) -> Column:
    return F.sqrt(label) / ratio


def unsqrt_label(scaled: Column | str, ratio: float) -> Column:
    c = F.col(scaled) if isinstance(scaled, str) else scaled
    return F.pow(c * ratio, F.lit(2.0))
