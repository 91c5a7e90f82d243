"""Two-stage prediction: is there a value at all, and if so which."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions.metrics import Metric
from bidlens.operators.cv import FoldModels, Learner, kfold_oof
from bidlens.operators.ranking import fit_quantiles
from bidlens.operators.sampling import threshold_route
from bidlens.session import cut_lineage


@dataclass
class Hurdle:
    classifier: FoldModels
    regressor: FoldModels
    threshold: float
    oof: DataFrame

    def predict(self, df: DataFrame, into: str = "model_predict") -> DataFrame:
        """Value where the mean probability exceeds the threshold, else 0; keeps ``probability_mean``."""
        out = self.classifier.predict(df, "probability_mean")
        out = self.regressor.predict(out, "_value")
        over = F.col("probability_mean") > self.threshold
        return out.withColumn(into, F.when(over, F.col("_value")).otherwise(0.0)).drop("_value")

    def score(self, label: str, metric: Metric) -> DataFrame:
        return self.oof.agg(metric(F.col(label), F.col("prediction_oof")).alias("score"))


def hurdle_fit(df: DataFrame, classifier: Learner, regressor: Learner, label: str, percentile: float,
               fold: str = "fold", positive: Column | None = None) -> Hurdle:
    """Classify label > 1, then regress on the rows above a percentile of the out-of-fold probability."""
    marked = df.withColumn("_positive", (positive if positive is not None else F.col(label) > 1).cast("double"))
    first = kfold_oof(marked, replace(classifier, proba=True), "_positive", fold, into="probability_oof")
    table = cut_lineage(first.oof, "hurdle")
    threshold = fit_quantiles(table, ["probability_oof"], [percentile / 100])["probability_oof"][0]
    routed = threshold_route(table, "probability_oof", threshold, "_over")
    second = kfold_oof(routed.filter("_over"), regressor, label, fold)
    zeros = routed.filter("not _over").withColumn("prediction_oof", F.lit(0.0))
    return Hurdle(first, second, threshold, second.oof.unionByName(zeros).drop("_positive", "_over"))
