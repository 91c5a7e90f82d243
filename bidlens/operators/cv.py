"""Cross-validated fits of Spark ML estimators and what is read off them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import ClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.functions.metrics import Metric
from bidlens.operators.answer import fold_summary
from bidlens.operators.sampling import upsample_minority
from bidlens.session import cut_lineage, side_by_side, stage_path

# Seed of the first fold and the step to the next.
FIRST_SEED, SEED_STEP = 10086, 500
OUTPUTS = ["rawPrediction", "probability", "prediction"]


@dataclass(frozen=True)
class Learner:
    """An estimator with the columns it sees; ``proba`` predicts the probability of label 1."""

    estimator: Estimator
    features: tuple[str, ...]
    proba: bool = False

    def configured(self, label: str, vector: str, seed: int | None) -> Estimator:
        est = self.estimator.copy({self.estimator.featuresCol: vector, self.estimator.labelCol: label})
        if seed is not None and est.hasParam("seed"):
            est.set(est.getParam("seed"), seed)
        return est


def assemble(df: DataFrame, features: Sequence[str], into: str) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=into, handleInvalid="error").transform(df)


def fit_bare(est: Estimator, rows: DataFrame) -> Model:
    """Fit and leave out the training summary of a classifier.

    The summary holds the session, which tasks cannot receive any more once a query of it has observed
    metrics. A saved model has none and predicts the same.
    """
    model = est.fit(rows)
    if not (isinstance(model, ClassificationModel) and getattr(model, "hasSummary", False)):
        return model
    path = stage_path(rows.sparkSession, "model")
    model.save(path)
    return type(model).load(path)


def predicted(df: DataFrame, model: Model, proba: bool, into: str) -> DataFrame:
    """Add one prediction column and drop the model's other outputs."""
    out = model.transform(df)
    value: Column = vector_to_array("probability")[1] if proba else F.col("prediction")
    return out.withColumn(f"_{into}", value).drop(*OUTPUTS).withColumnRenamed(f"_{into}", into)


@dataclass
class FoldModels:
    """One model per fold with the out-of-fold predictions of the rows they were fitted on."""

    learner: Learner
    models: list[Model]
    oof: DataFrame
    label: str
    fold: str
    prediction: str = "prediction_oof"
    extra: dict = field(default_factory=dict)

    def predict(self, df: DataFrame, into: str = "model_predict") -> DataFrame:
        """Mean prediction of the fold models: narrow column work, no join."""
        out = assemble(df, self.learner.features, "_x")
        names = []
        for i, model in enumerate(self.models):
            names.append(f"_p{i}")
            out = predicted(out, model, self.learner.proba, f"_p{i}")
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
        return out.withColumn(into, mean).drop("_x", *names)

    def scores(self, metric: Metric) -> DataFrame:
        """Mean and deviation of the fold scores, and the score of all rows."""
        return fold_summary(self.oof, self.label, self.prediction, metric, self.fold)

    def eval_scores(self, valid: DataFrame, metric: Metric) -> DataFrame:
        """Score of each fold model on further rows."""
        base = assemble(valid, self.learner.features, "_x")
        parts = [predicted(base, m, self.learner.proba, "_p").agg(metric(F.col(self.label), F.col("_p")).alias("score"))
                 .withColumn("fold", F.lit(i)) for i, m in enumerate(self.models)]
        return reduce(DataFrame.unionByName, parts)

    def importances(self, spark: SparkSession) -> DataFrame:
        return importance_sum(spark, self.models, self.learner.features)


def importance_sum(spark: SparkSession, models: Sequence[Model], features: Sequence[str]) -> DataFrame:
    """Importances added up over the models, as (feature, importance); gain-based."""
    totals = [0.0] * len(features)
    for model in models:
        for i, v in enumerate(model.featureImportances.toArray()):
            totals[i] += float(v)
    return spark.createDataFrame(list(zip(features, totals)), "feature string, importance double")


def fold_numbers(df: DataFrame, fold: str) -> list[int]:
    return sorted(row[0] for row in df.select(fold).distinct().collect())


def kfold_oof(df: DataFrame, learner: Learner, label: str, fold: str = "fold", extra: DataFrame | None = None,
              upsample: bool = False, into: str = "prediction_oof", keep_seed: bool = True) -> FoldModels:
    """Fit one model per fold on the other folds and predict the fold with it.

    ``extra`` rows join every training part and are never predicted. The assembled
    table is written once, by fold; each fit then reads the files of its folds, side by side with others.
    """
    vector = "_x"
    table = cut_lineage(assemble(df, learner.features, vector), "folds", by=fold)
    more = None if extra is None else assemble(extra, learner.features, vector).select(vector, label)

    def fit(i: int, number: int) -> Model:
        train = table.filter(F.col(fold) != number).select(vector, label)
        if upsample:
            train = upsample_minority(train, label)
        if more is not None:
            train = train.unionByName(more)
        return fit_bare(learner.configured(label, vector, None if keep_seed else FIRST_SEED + SEED_STEP * i), train)

    numbers = fold_numbers(table, fold)
    models = side_by_side(table, [partial(fit, i, number) for i, number in enumerate(numbers)])
    parts = [predicted(table.filter(F.col(fold) == number), model, learner.proba, into).drop(vector)
             for number, model in zip(numbers, models)]
    return FoldModels(learner, models, reduce(DataFrame.unionByName, parts), label, fold, into)
