"""Stratified folds by cells of the hash are those by positions of all values."""

from collections import Counter

from pyspark.sql import functions as F

from bidlens.operators import sampling


def folds(rows, limit):
    return Counter(map(tuple, sampling.assign_folds(rows, "key", 5, "stratified", "label", limit=limit).collect()))


def test_rows_travel_once(spark, monkeypatch):
    rows = spark.range(20_000).select((F.col("id") * 3).alias("key"), F.when(F.col("id") % 7 > 0, F.col("id") % 2 * 1.0).alias("label"), "id")
    want = folds(rows, 0)
    asked = []
    monkeypatch.setattr(sampling, "value_positions", lambda *args: asked.append(args))
    assert folds(rows, 1_000_000) == want and not asked


def test_repeated_and_missing_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 200).alias("key"), (F.col("id") % 3).alias("label"), "id")
    want = folds(rows, 0)
    assert folds(rows, 1_000_000) == want and sum(want.values()) == 3000
    assert {fold for key, _, _, fold in want if key is None} == {None}
