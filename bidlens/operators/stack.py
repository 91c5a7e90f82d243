"""Two-level stacking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from bidlens.operators.cv import FoldModels, Learner, kfold_oof
from bidlens.operators.sampling import assign_folds
from bidlens.session import cut_lineage

TOP_SALT = 777  # fixed value: the top level is split differently from the base level


@dataclass
class Stack:
    base: list[FoldModels]
    top: FoldModels
    level: DataFrame  # out-of-fold base predictions with key and label
    key: str
    label: str

    def predict(self, df: DataFrame, into: str = "model_predict") -> DataFrame:
        """Base models averaged over their folds, then the top models over theirs."""
        out = df
        for i, folds in enumerate(self.base):
            out = folds.predict(out, f"m{i}")
        return self.top.predict(out, into).drop(*[f"m{i}" for i in range(len(self.base))])


def _fit_top(level: DataFrame, top: Estimator, names: Sequence[str], label: str, key: str, k: int, proba: bool,
             how: str) -> FoldModels:
    rows = assign_folds(level, key, k, how=how, label=label, salt=TOP_SALT, into="top_fold")
    return kfold_oof(rows, Learner(top, tuple(names), proba), label, "top_fold")


def stack_fit(df: DataFrame, learners: Sequence[Learner], top: Estimator, label: str, key: str,
              fold: str = "fold", k: int = 5, binary: bool = True, upsample: bool = False,
              extra: DataFrame | None = None) -> Stack:
    """Out-of-fold predictions of the base models become the columns of the top model."""
    base, level = [], None
    for i, learner in enumerate(learners):
        folds = kfold_oof(df, replace(learner, proba=binary), label, fold, extra, upsample, into=f"m{i}")
        base.append(folds)
        side = folds.oof.select(key, *([label] if level is None else []), f"m{i}")
        level = side if level is None else level.join(side, key)
    level = cut_lineage(level, "level")
    names = [f"m{i}" for i in range(len(learners))]
    fitted = _fit_top(level, top, names, label, key, k, binary, "stratified" if binary else "hash")
    return Stack(base, fitted, level, key, label)


def stack_refit_top(stack: Stack, top: Estimator, k: int = 5) -> Stack:
    """A new top model on the kept base predictions; earlier scores are not carried over."""
    proba = stack.top.learner.proba
    names = stack.top.learner.features
    return replace(stack, top=_fit_top(stack.level, top, names, stack.label, stack.key, k, proba,
                                       "stratified" if proba else "hash"))
