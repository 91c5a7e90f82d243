"""Scores and losses as aggregate columns over (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions.scalar import _col, clip_low

# A metric maps (label column, prediction column) to one aggregate column.
Metric = Callable[[Column, Column], Column]


def exposure_score(label: Column | str, prediction: Column | str | float) -> Column:
    """Accuracy score on exposure counts: 90 when perfect, both sides floored at 1."""
    p = F.lit(float(prediction)) if isinstance(prediction, (int, float)) else prediction
    y, p = clip_low(label), clip_low(p)
    smape = F.avg(F.abs(y - p) / ((y + p) / 2))
    return 40 * (1 - smape / 2) + 50


def floor_rectify(x: Column | str, slope: float = 0.0) -> Column:
    """Values under 1 become 1 (or fall off with ``slope`` below it)."""
    v = _col(x).cast("double")
    return F.when(v >= 1, v).otherwise((v - 1) * slope + 1)


def smape_loss(label: Column | str, prediction: Column | str, slope: float = 0.0) -> Column:
    """Summed relative error; ``slope`` lets predictions under 1 keep a gradient."""
    p, y = floor_rectify(prediction, slope), floor_rectify(label)
    return F.sum(F.abs(p - y) / F.abs(p + y))


def leaky_smape_loss(label: Column | str, prediction: Column | str) -> Column:
    return smape_loss(label, prediction, slope=0.01)


def mean_absolute_error(label: Column, prediction: Column) -> Column:
    return F.avg(F.abs(_col(label) - _col(prediction)))


def log_loss(label: Column, probability: Column) -> Column:
    p = F.least(F.greatest(_col(probability), F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.avg(F.when(_col(label) > 0, F.log(p)).otherwise(F.log(1 - p)))


def relative_gradients(label: Column | str, prediction: Column | str, delta: float = 150.0,
                       floor: float = 0.1) -> tuple[Column, Column]:
    """First and second derivative of the label-relative error.

    Quadratic within ``delta`` of the label, linear (no curvature) beyond it.
    """
    y = F.greatest(_col(label).cast("double"), F.lit(floor))
    err = _col(prediction).cast("double") - y
    near = F.abs(err) < delta
    grad = F.when(near, 2 * err / y).otherwise(delta * F.signum(err) / y)
    hess = F.when(near, 2 / y).otherwise(F.lit(0.0))
    return grad, hess
