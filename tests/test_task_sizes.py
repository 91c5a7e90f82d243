"""What one task holds does not grow with the input."""

import pytest
from pyspark.sql import functions as F

from bidlens import session
from bidlens.catalog.tables import Tables
from bidlens.operators import ranking

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_are_cut_by_the_size_of_the_input(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
    try:
        t = Tables(spark, folder)
        assert int(spark.conf.get(INITIAL)) > 100
        plan = t.track_log()._jdf.queryExecution().executedPlan().toString()
        assert f", {spark.conf.get(INITIAL)})" in plan, plan
        monkeypatch.undo()
        Tables(spark, folder)
        assert spark.conf.get(INITIAL, None) is None
    finally:
        spark.conf.unset(INITIAL)


def test_rows_are_dealt_before_their_columns_become_rows(spark):
    rows = spark.range(0, 1000, 1, 1).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"))
    assert ranking.dealt(rows, 2, 100).rdd.getNumPartitions() == 20
    assert ranking.dealt(rows, 2, 2000).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("most", [50, 10 ** 9])
def test_quantiles_of_dealt_rows(spark, monkeypatch, most):
    rows = spark.range(0, 1000, 1, 1).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"))
    seen, real = [], ranking.dealt
    monkeypatch.setattr(ranking, "dealt", lambda df, each: seen.append(each) or real(df, each, most))
    found = {(r["k"], r["stat"]): r["q0"] for r in ranking.exact_quantiles(rows, ["a", "b"], [0.5], ["k"]).collect()}
    assert seen == [2]
    assert found == {(0, "a"): 499.5, (1, "a"): 499.0, (2, "a"): 500.0, (0, "b"): 3.0, (1, "b"): 3.0, (2, "b"): 3.0}
