"""The value range of a row is found by halving steps, not by comparing it with every cut."""

import pytest
from pyspark.sql import functions as F

from bidlens.operators import ranking


@pytest.mark.parametrize("count", [0, 1, 2, 7, 8, 255])
def test_cuts_below(spark, count):
    cuts = sorted(float(i * 7 % 90) for i in range(count))  # some are equal
    values = [v / 2 for v in range(-3, 190)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").withColumn(
        "cuts", F.lit(cuts) if cuts else F.array().cast("array<double>"))
    found = rows.select("v", ranking.cuts_below("cuts", F.col("v"), count).alias("at")).collect()
    assert {r["v"]: r["at"] for r in found} == {v: sum(c < v for c in cuts) for v in values}


@pytest.mark.parametrize("ranges", [2, 5, 256])
def test_ranges_compare_few_cuts(spark, ranges):
    rows = spark.range(2000).select((F.col("id") * 37 % 1000).alias("x"), (F.col("id") % 3).alias("key"))
    ranged = ranking.split_ranges(rows, ["key"], "x", ranges)
    assert "filter(_cuts" not in ranged._jdf.queryExecution().optimizedPlan().toString()
    edges = ranged.groupBy("key", "_range").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()
    for key in range(3):
        spans = sorted((r["_range"], r["low"], r["high"]) for r in edges if r["key"] == key)
        assert len(spans) > ranges // 2
        assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
