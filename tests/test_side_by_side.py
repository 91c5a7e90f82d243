"""Fits of different folds, or of different models, run at once and read only their folds."""

import threading

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from bidlens.operators import cv, eliminate, leaves
from bidlens.session import cut_lineage, side_by_side


@pytest.fixture
def rows(spark):
    return cut_lineage(spark.range(80).select(
        (F.col("id") % 4).cast("int").alias("fold"), "id", F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("Y")))


@pytest.fixture
def met(monkeypatch):
    """A fit that waits until another one has begun; alone it raises."""
    both = threading.Barrier(2, timeout=60)
    seen = []

    def waits(kind):
        real = kind.fit

        def fit(self, df, *rest):
            seen.append(df)
            both.wait()
            return real(self, df, *rest)

        monkeypatch.setattr(kind, "fit", fit)

    for kind in (DecisionTreeRegressor, LinearRegression):
        waits(kind)
    return seen


def test_folds_are_fitted_at_once(rows, met):
    folds = cv.kfold_oof(rows, cv.Learner(LinearRegression(), ("a",)), "Y")
    assert len(folds.models) == 4
    got = folds.oof.select("fold", "id", "Y", "prediction_oof").collect()
    assert sorted((r.fold, r.id) for r in got) == sorted((i % 4, i) for i in range(80))
    assert all(abs(r.prediction_oof - r.Y) < 1e-6 for r in got)
    for train in met:  # the files of the other folds only
        assert len({f.split("fold=")[1].split("/")[0] for f in train.inputFiles()}) == 4
        plan = train._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(fold" in plan, plan


def test_leaf_folds_are_fitted_at_once(rows, met):
    class One:
        size = 1

        def apply(self, df, into="leaves"):
            return df.withColumn(into, F.array(F.lit(0)))

    folds = leaves.leaf_fm_kfold(rows, lambda part, seed: One(), LinearRegression(), "Y")
    got = {r.id: r.prediction_oof for r in folds.oof.collect()}
    for fold in range(4):  # a constant feature gives the mean of the other folds
        others = [2.0 * i + 1 for i in range(80) if i % 4 != fold]
        assert all(abs(got[i] - sum(others) / 60) < 1e-6 for i in range(80) if i % 4 == fold)


def test_models_are_fitted_at_once(rows, met):
    trees = [DecisionTreeRegressor(maxDepth=1), DecisionTreeRegressor(maxDepth=2)]
    assert eliminate.rfe_multi(rows.withColumn("flat", F.lit(1.0)), trees, ["flat", "a"], "Y", 1, 1) == ["a"]


def test_results_keep_their_order_and_local_properties_apart(spark):
    def job(i):
        spark.sparkContext.setLocalProperty("side", str(i))
        found = spark.range(i + 1).count()
        return i, found, spark.sparkContext.getLocalProperty("side")

    table = spark.range(4)
    assert side_by_side(table, [lambda i=i: job(i) for i in range(6)]) == [(i, i + 1, str(i)) for i in range(6)]
    assert spark.sparkContext.getLocalProperty("side") is None
    with pytest.raises(ZeroDivisionError):
        side_by_side(table, [lambda: 1, lambda: 1 // 0])


@pytest.mark.parametrize("tasks, most", [(4, 4), (8, 2), (100, 1)])
def test_large_tables_are_fitted_one_at_a_time(spark, tasks, most):
    running, counts, lock = [], [], threading.Lock()

    def job():
        with lock:
            running.append(1)
            counts.append(len(running))
        threading.Event().wait(0.5)
        with lock:
            running.pop()

    side_by_side(spark.range(0, 1000, 1, tasks), [job] * 4)  # four cores
    assert max(counts) == most
