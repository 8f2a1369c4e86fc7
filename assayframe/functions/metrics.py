"""Binary classification metrics as expressions on the four cell counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column, default: float | None = None) -> Column:
    value = F.try_divide(a.cast("double"), b.cast("double"))
    return value if default is None else F.coalesce(value, F.lit(default))


def _c(name: str) -> Column:
    return F.col(name).cast("double")


def accuracy() -> Column:
    return _ratio(_c("tp") + _c("tn"), _c("tp") + _c("tn") + _c("fp") + _c("fn"))


def precision() -> Column:
    return _ratio(_c("tp"), _c("tp") + _c("fp"), 0.0)


def recall() -> Column:
    return _ratio(_c("tp"), _c("tp") + _c("fn"), 0.0)


def specificity() -> Column:
    return _ratio(_c("tn"), _c("tn") + _c("fp"), 0.0)


def balanced_accuracy() -> Column:
    """Mean recall over the classes that occur."""
    positive = _ratio(_c("tp"), _c("tp") + _c("fn"))
    negative = _ratio(_c("tn"), _c("tn") + _c("fp"))
    return F.coalesce((positive + negative) / 2, positive, negative)


def f1() -> Column:
    return _ratio(2 * _c("tp"), 2 * _c("tp") + _c("fp") + _c("fn"), 0.0)


def mcc() -> Column:
    product = (_c("tp") + _c("fp")) * (_c("tp") + _c("fn")) * (_c("tn") + _c("fp")) * (_c("tn") + _c("fn"))
    return _ratio(_c("tp") * _c("tn") - _c("fp") * _c("fn"), F.sqrt(product), 0.0)


METRICS: dict[str, Callable[[], Column]] = {
    "accuracy": accuracy,
    "balanced_accuracy": balanced_accuracy,
    "precision": precision,
    "recall": recall,
    "f1": f1,
    "specificity": specificity,
    "mcc": mcc,
}


#: Metrics of users, see :func:`assayframe.functions.user.register_metric`.
USER_METRICS: dict[str, Callable[[], Column]] = {}


def named_metric(name: str) -> Callable[[], Column]:
    """A built-in or a user's metric by name."""
    if name in METRICS:
        return METRICS[name]
    if name in USER_METRICS:
        return USER_METRICS[name]
    raise ValueError(f"unknown metric {name!r}: use one of {sorted([*METRICS, *USER_METRICS])}")


def cell_counts(truth: Column, predicted: Column) -> list[Column]:
    """The aggregates every metric is made of; rows with a missing side do not count."""
    return [
        F.count_if((truth == 1) & (predicted == 1)).alias("tp"),
        F.count_if((truth == 0) & (predicted == 1)).alias("fp"),
        F.count_if((truth == 1) & (predicted == 0)).alias("fn"),
        F.count_if((truth == 0) & (predicted == 0)).alias("tn"),
    ]
