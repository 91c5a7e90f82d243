"""Rows are counted once for all grids."""

from pyspark.sql import functions as F

from bidlens.operators import select


def test_rows_are_counted_before_the_grids(spark):
    rows = spark.range(3000).select((F.col("id") * 37 % 50).alias("x"), (F.col("id") * 7919 % 3001).alias("z"),
                                    (F.col("id") % 50 * 10 + F.col("id") % 7).alias("y"))
    found = select.mic_scores(rows, ["x", "z"], "y")
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grids = max(i for i, line in enumerate(plan) if "Generate explode(" in line)
    assert any("Aggregate [" in line for line in plan[grids:])
    scores = {r["feature"]: r["score"] for r in found.collect()}
    assert 1 >= scores["x"] > scores["z"] >= 0
