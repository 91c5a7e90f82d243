"""Invariants of the fitted operators on small data."""

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import FMRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from bidlens.functions import metrics
from bidlens.operators import boost, cv, eliminate, hurdle, leaves, mixed, sampling, stack

N = 600


@pytest.fixture(scope="module")
def table(spark):
    noise = (F.pmod(F.col("id") * 2654435761, F.lit(4294967296)) % 100) / 100.0
    df = spark.range(N).select(
        "id", ((F.col("id") * 7) % 23).cast("double").alias("a"), ((F.col("id") * 13) % 17).cast("double").alias("b"),
        noise.alias("c"), (F.col("id") % 4).alias("kind"))
    df = df.withColumn("Y", F.col("a") * 3 + F.col("kind") * 2 + noise).withColumn("bin", (F.col("a") > 11).cast("double"))
    return sampling.assign_folds(df, "id")


def loss(df, label="Y", p="model_predict"):
    return df.agg(F.avg(F.abs(F.col(label) - F.col(p)))).head()[0]


def test_each_row_is_predicted_once_out_of_fold(table):
    folds = cv.kfold_oof(table, cv.Learner(LinearRegression(), ("a", "b", "c")), "Y")
    assert len(folds.models) == 5
    assert folds.oof.count() == N == folds.oof.select("id").distinct().count()
    assert folds.oof.filter("prediction_oof is null").count() == 0
    row = folds.scores(metrics.mean_absolute_error).head()
    assert row["mean_score"] < 5 and row["std_score"] >= 0 and row["total_score"] > 0


def test_extra_rows_join_training_only(spark, table):
    extra = table.limit(50).withColumn("Y", F.lit(1e6))
    folds = cv.kfold_oof(table, cv.Learner(LinearRegression(), ("a", "b")), "Y", extra=extra)
    assert folds.oof.count() == N
    assert folds.oof.agg(F.avg("prediction_oof")).head()[0] > 1000


def test_fold_mean_is_the_mean(table):
    folds = cv.kfold_oof(table, cv.Learner(LinearRegression(), ("a",)), "Y")
    row = folds.predict(table).filter("id = 3").head()
    each = [m.predict(m.transform(cv.assemble(table.filter("id = 3"), ["a"], "_x")).head()["_x"]) for m in folds.models]
    assert row["model_predict"] == pytest.approx(sum(each) / 5)


def test_importances(spark, table):
    folds = cv.kfold_oof(table, cv.Learner(RandomForestRegressor(numTrees=3, seed=1), ("a", "b", "c")), "Y")
    rows = {r["feature"]: r["importance"] for r in folds.importances(spark).collect()}
    assert set(rows) == {"a", "b", "c"} and min(rows.values()) >= 0
    assert max(rows, key=rows.get) == "a" and sum(rows.values()) == pytest.approx(5)


def test_boosting_lowers_its_loss(table):
    params = boost.BoostParams(rounds=4, rate=0.5, max_depth=4, l1=0.0, min_rows=5, columns=1.0, write_every=2)
    booster = boost.custom_objective_boost(table, ["a", "b", "c"], "Y", params=params)
    assert len(booster.trees) == 4
    score = lambda n: boost.Booster(booster.features, booster.num_leaves, booster.trees[:n]).predict(table).agg(
        metrics.exposure_score("Y", "model_predict")).head()[0]
    scores = [score(n) for n in range(5)]
    assert scores == sorted(scores) and scores[-1] > scores[0] + 5
    ids = booster.apply(table).select(F.explode("leaves").alias("l")).agg(F.max("l"), F.min("l")).head()
    assert 0 <= ids[1] and ids[0] < booster.size


def test_leaf_regularisation():
    p = boost.BoostParams(rate=1.0, l1=10.0, max_step=150.0)
    rows = [{"_leaf": 0.0, "g": 5.0, "h": 1.0}, {"_leaf": 1.0, "g": -30.0, "h": 4.0}, {"_leaf": 2.0, "g": 40.0, "h": 0.0}]
    assert boost._leaf_values(rows, 4, p) == [0.0, 5.0, -150.0, 0.0]


def test_leaves_are_distinct_across_trees(table):
    trees = leaves.multi_tree_leaves(table, [
        cv.Learner(RandomForestRegressor(numTrees=2, maxDepth=2, seed=1), ("a",)),
        cv.Learner(RandomForestRegressor(numTrees=3, maxDepth=3, seed=2), ("b", "c"))], "Y")
    rows = trees.apply(table).select("leaves").collect()
    assert trees.size == 5 * 8
    for row in rows[:50]:
        assert len(row["leaves"]) == 5
        assert all(8 * i <= v < 8 * (i + 1) for i, v in enumerate(row["leaves"]))


def test_leaf_logistic_separates(table):
    model = leaves.leaf_logistic(table, [cv.Learner(GBTClassifier(maxIter=2, maxDepth=2, seed=1), ("a", "b"))], "bin")
    out = model.predict(table, keep_label=True)
    assert out.filter(F.col("label_predict") == F.col("bin")).count() > 0.95 * N
    assert out.filter("model_predict < 0 or model_predict > 1").count() == 0


def test_leaf_fm_folds(table):
    fit = lambda rows, seed: leaves.multi_tree_leaves(
        rows, [cv.Learner(RandomForestRegressor(numTrees=2, maxDepth=2), ("a", "b"))], "Y", seed)
    folds = leaves.leaf_fm_kfold(table.filter("fold < 2"), fit, FMRegressor(factorSize=2, maxIter=3), "Y")
    assert len(folds.models) == 2
    assert folds.oof.count() == table.filter("fold < 2").count()
    assert folds.predict(table).filter("model_predict is null").count() == 0


def test_hurdle_zeroes_rows_under_the_threshold(table):
    fitted = hurdle.hurdle_fit(table, cv.Learner(LogisticRegression(maxIter=5), ("a", "b")),
                               cv.Learner(LinearRegression(), ("a", "b")), "Y", 40)
    oof = fitted.oof.collect()
    assert len(oof) == N
    assert all((r["prediction_oof"] == 0.0) == (r["probability_oof"] <= fitted.threshold) for r in oof)
    out = fitted.predict(table)
    assert out.filter((F.col("probability_mean") <= fitted.threshold) & (F.col("model_predict") != 0)).count() == 0


def test_mixed_ids_and_numbers(table):
    fitted = mixed.mixed_regressor_kfold(table, table, ["kind"], ["a", "b", "c"], "Y", "id",
                                         estimator=LinearRegression())
    assert fitted.oof.count() == N
    assert loss(fitted.predict(table)) < 10


def test_stack(table):
    learners = [cv.Learner(LogisticRegression(maxIter=5), ("a",)),
                cv.Learner(RandomForestClassifier(numTrees=2, maxDepth=2, seed=1), ("b", "c"))]
    fitted = stack.stack_fit(table, learners, LogisticRegression(maxIter=5), "bin", "id", k=3, upsample=True)
    assert fitted.level.count() == N and len(fitted.top.models) == 3
    out = fitted.predict(table)
    assert out.filter("model_predict between 0 and 1").count() == N
    again = stack.stack_refit_top(fitted, LogisticRegression(maxIter=2), k=2)
    assert len(again.top.models) == 2 and again.level is fitted.level


def test_elimination(spark, table):
    left = eliminate.rfe_multi(table, [RandomForestRegressor(numTrees=2, seed=1), RandomForestRegressor(numTrees=3, seed=2)],
                               ["a", "b", "c"], "Y", 1, 1)
    assert left == ["a"]
    scores, best = eliminate.rfe_single(
        table.filter("fold < 4"), cv.Learner(RandomForestRegressor(numTrees=2, seed=1), ("a", "b", "c")), "Y", 1, 1,
        table.filter("fold = 4"), metrics.mean_absolute_error)
    assert len(scores) == 3 and "a" in best


def test_adversarial_validation_finds_the_shifted_column(table):
    train, test = table.filter("id < 400"), table.filter("id >= 400").withColumn("b", F.col("b") + 100)
    importances, probability, auc = eliminate.adversarial_validation(
        train, test, ["a", "b", "c"], "id", RandomForestClassifier(numTrees=3, maxDepth=3, seed=1))
    assert importances.orderBy(F.desc("importance")).head()["feature"] == "b"
    assert probability.count() == 400
    assert auc.head()["auc"] > 0.95
