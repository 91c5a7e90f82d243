"""Feature elimination and train/test comparison by model importances."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import partial

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.functions.metrics import Metric
from bidlens.operators.answer import auc_score
from bidlens.operators.cv import Learner, assemble, importance_sum, kfold_oof
from bidlens.operators.encode import split_back, union_sets
from bidlens.operators.sampling import assign_folds
from bidlens.operators.select import bottom_features, feature_intersection, top_features
from bidlens.session import cut_lineage, side_by_side

Combine = Callable[[list[DataFrame]], DataFrame]
WORST_SCORE = 100.0  # fixed value: lower scores are better and start from here


def _names(features: DataFrame) -> set[str]:
    return {row["feature"] for row in features.select("feature").collect()}


def rfe_multi(df: DataFrame, estimators: Sequence[Estimator], features: Sequence[str], label: str, step: int,
              target: int, combine: Combine = feature_intersection) -> list[str]:
    """Drop features until at most ``target`` are left that every model keeps.

    Each model keeps its most important ones; ``combine`` merges the lists. Stops as well
    when a round drops nothing, since the next would repeat it.
    """
    table = cut_lineage(df.select(label, *features), "rfe")
    left = list(features)
    while True:
        rows = assemble(table, left, "_x").select("_x", label)
        models = side_by_side(rows, [
            partial(Learner(est, tuple(left)).configured(label, "_x", None).fit, rows) for est in estimators])
        kept = [top_features(importance_sum(df.sparkSession, [model], left), step, target, len(left)) for model in models]
        names = _names(combine(kept))
        remaining = [f for f in left if f in names]
        if len(remaining) <= target or len(remaining) == len(left):
            return remaining
        left = remaining


def rfe_single(df: DataFrame, learner: Learner, label: str, step: int, target: int, valid: DataFrame,
               metric: Metric, fold: str = "fold") -> tuple[list[float], list[str]]:
    """Drop the least important features of a k-fold model round by round.

    Returns the holdout score of each round and the features of the best (lowest) one.
    """
    table, holdout = cut_lineage(df, "rfe"), cut_lineage(valid, "rfe-valid")
    left, scores, best, best_score = list(learner.features), [], [], WORST_SCORE
    while True:
        folds = kfold_oof(table, replace(learner, features=tuple(left)), label, fold)
        score = folds.predict(holdout, "_p").agg(metric(F.col(label), F.col("_p"))).head()[0]
        scores.append(score)
        if score < best_score:
            best_score, best = score, list(left)
        if len(left) <= target:
            return scores, best
        dropped = _names(bottom_features(folds.importances(df.sparkSession), step))
        left = [f for f in left if f not in dropped]
        if not left:
            return scores, best


def adversarial_validation(train: DataFrame, test: DataFrame, features: Sequence[str], key: str,
                           estimator: Estimator | None = None, k: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How well a model tells test rows from train rows.

    Returns importances summed over the folds, the out-of-fold probability of being a
    test row for each train row, and the AUC over all rows. ``key`` tells rows apart
    within each set.
    """
    stacked = union_sets({"train": train.select(key, *features), "test": test.select(key, *features)})
    marked = stacked.withColumns({"_test": (F.col("origin") == "test").cast("double"),
                                  "_row": F.col(key) * 2 + (F.col("origin") == "test").cast("int")})
    rows = assign_folds(marked, "_row", k, how="stratified", label="_test")
    learner = Learner(estimator or GBTClassifier(seed=2019), tuple(features), proba=True)
    folds = kfold_oof(rows, learner, "_test", into="probability")
    oof = cut_lineage(folds.oof, "adversarial")
    return (folds.importances(train.sparkSession), split_back(oof, "train").select(key, "probability"),
            auc_score(oof, "_test", "probability"))
