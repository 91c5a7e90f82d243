"""Down-sampling, up-sampling and fold numbering by reproducible arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlens.functions.scalar import SPREAD_RANGE, spread
from bidlens.operators.ranking import GROUP_LIMIT, nth_smallest, value_positions
from bidlens.session import cut_lineage, pin_small

CELLS = 4096  # equal parts of the hash's range whose rows are ordered together

def downsample_zero(df: DataFrame, label: str, key: str, fraction: float = 0.4, exact: bool = False,
                    salt: int = 0, limit: int = GROUP_LIMIT) -> DataFrame:
    """Keep ``fraction`` of the rows with label 0 and all others.

    By default each row decides by the hash of ``key``: no shuffle, count right on
    average. ``exact`` keeps round(fraction * n) rows, those of smallest hash; it
    needs a unique key under 2^31.
    """
    hashed = spread(key, salt)
    if not exact:
        return df.filter((F.col(label) != 0) | (hashed < int(fraction * SPREAD_RANGE)))
    zeros = df.filter(F.col(label) == 0).select(hashed.alias("_hash"))
    last = nth_smallest(zeros, "_hash", round(fraction * zeros.count()), limit)
    return df.filter((F.col(label) != 0) | (hashed <= (-1 if last is None else last)))


def upsample_minority(df: DataFrame, label: str) -> DataFrame:
    """Repeat the rarer of labels 0 and 1 floor(major / minor) times; a missing class raises."""
    ones, zeros = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).head()
    if not ones or not zeros:
        raise ValueError("both classes need rows")
    minor, ratio = (0, ones // zeros) if ones > zeros else (1, zeros // ones)
    copies = F.when(F.col(label) == minor, F.lit(ratio)).otherwise(F.lit(1))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def shuffled_places(df: DataFrame, key: str, salt: int = 0, into: str = "place", limit: int = GROUP_LIMIT) -> DataFrame:
    """Add each row's place, from 0, in a shuffled order of all rows with a ``key``, which is unique.

    Keys from 2^31 on may share a hash; they follow each other in their own order. Rows without a key have no place.
    """
    keyed = df.filter(F.col(key).isNotNull())
    hashed = keyed.withColumn("_hash", spread(key, salt))
    placed = value_positions(hashed, [], "_hash", limit).select("_hash", F.col("n_before").alias("_before"))
    tie = F.row_number().over(Window.partitionBy("_hash").orderBy(key)) - 1
    found = hashed.join(placed, "_hash").withColumn(into, F.col("_before") + tie).drop("_hash", "_before")
    return found.unionByName(df.filter(F.col(key).isNull()).withColumn(into, F.lit(None).cast("bigint")))


def fold_by_hash(key: Column | str, k: int = 5, salt: int = 0) -> Column:
    """Fold number of a shuffled split, decided row by row."""
    return F.floor(spread(key, salt) * k / SPREAD_RANGE).cast("int")


def _contiguous(at: Column, n: Column, k: int) -> Column:
    """Fold of row ``at`` when ``n`` rows are cut into ``k`` runs, the first ones longer by one."""
    size, extra = F.floor(n / k), n % k
    longer = extra * (size + 1)
    return F.when(at < longer, F.floor(at / (size + 1))).otherwise(
        extra + F.floor((at - longer) / F.greatest(size, F.lit(1)))).cast("int")


def _cell(hashed: Column) -> Column:
    return F.floor(hashed / (SPREAD_RANGE // CELLS)).cast("int")


def _cell_totals(hashed: DataFrame) -> DataFrame:
    """Rows of each label by cell of their hash, and those of the label's earlier cells."""
    counted = hashed.filter("_hash is not null").groupBy("_label", _cell(F.col("_hash")).alias("_cell")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_label").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(counted.withColumn("_ahead", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))), "cells")


def _placed_in_cells(hashed: DataFrame, totals: DataFrame, k: int, into: str) -> DataFrame:
    """Deal each label's rows over ``k`` folds in order of their hash; the rows travel once, by cell.

    Rows without a hash are spread over cells of their own and get no fold.
    """
    none = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(CELLS))
    celled = hashed.withColumn("_cell", F.when(F.col("_hash").isNull(), none).otherwise(_cell(F.col("_hash"))).cast("int"))
    known = celled.join(pin_small(totals.drop("_rows")), ["_label", "_cell"], "left")
    place = F.col("_ahead") + F.rank().over(Window.partitionBy("_label", "_cell").orderBy("_hash")) - 1
    return known.withColumn(into, (place % k).cast("int")).select(*hashed.columns, "_cell", into)


def assign_folds(df: DataFrame, key: str, k: int = 5, how: str = "hash", label: str | None = None,
                 salt: int = 0, into: str = "fold", limit: int = GROUP_LIMIT) -> DataFrame:
    """Add a fold number; rows without a key stay, with a null fold.

    ``hash``: shuffled, no data movement. ``contiguous``: runs in the order of the
    unique ``key``. ``stratified``: each label spread evenly over the folds, null being a label.
    """
    if how == "hash":
        return df.withColumn(into, fold_by_hash(key, k, salt))
    if how == "contiguous":
        placed = value_positions(df, [], key, limit).select(
            key, _contiguous(F.col("n_before"), F.col("n_total"), k).alias(into))
        return df.join(placed, key, "left")
    if how == "stratified":
        # A struct is equal to itself also where the label in it is null.
        hashed = df.withColumns({"_hash": spread(key, salt), "_label": F.struct(label)})
        totals = _cell_totals(hashed)
        if (totals.agg(F.max("_rows")).head()[0] or 0) <= limit:
            return _placed_in_cells(hashed, totals, k, into).drop("_hash", "_label", "_cell")
        placed = value_positions(hashed, ["_label"], "_hash", limit).select(
            "_label", "_hash", (F.col("n_before") % k).cast("int").alias(into))
        return hashed.join(placed, ["_label", "_hash"], "left").drop("_hash", "_label")
    raise ValueError(f"unknown split {how}")


def threshold_route(df: DataFrame, score: str, threshold: float, into: str = "above") -> DataFrame:
    """Mark rows whose score is strictly over the threshold."""
    return df.withColumn(into, F.col(score) > threshold)
