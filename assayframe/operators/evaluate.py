"""Scores of 0/1 predictions. All metrics of all groups come from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions.metrics import METRICS, USER_METRICS, cell_counts, named_metric


def binary_metrics(
    df: DataFrame,
    *,
    truth: str,
    predicted: str,
    metrics: Sequence[str] | None = None,
    by: Sequence[str] = (),
    digits: int | None = 3,
) -> DataFrame:
    """The chosen metrics, by default all, per group. Unknown names are left out."""
    names = [m for m in (metrics if metrics is not None else METRICS) if m in METRICS or m in USER_METRICS]
    if not names:
        raise ValueError(f"no known metric: use some of {sorted(METRICS)}")
    cells = df.groupBy(*by).agg(*cell_counts(F.col(truth), F.col(predicted)))
    values = {m: named_metric(m)() for m in names}
    if digits is not None:
        values = {m: F.round(v, digits) for m, v in values.items()}
    return cells.select(*by, *[v.alias(m) for m, v in values.items()])


def metrics_at_threshold(
    df: DataFrame,
    *,
    truth: str,
    probability: str,
    thresholds: Sequence[float],
    metrics: Sequence[str] | None = None,
    digits: int | None = 3,
) -> DataFrame:
    """Metrics with class 1 from each probability threshold on.

    All thresholds are judged in one pass: each row is counted once per threshold
    inside its own task, before anything is shuffled.
    """
    if not thresholds:
        raise ValueError("at least one threshold is needed")
    every = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    judged = df.select(truth, probability, every.alias("threshold")).withColumn(
        "__predicted", F.when(F.col(probability) >= F.col("threshold"), 1).when(F.col(probability).isNotNull(), 0)
    )
    return binary_metrics(
        judged, truth=truth, predicted="__predicted", metrics=metrics, by=["threshold"], digits=digits
    )


def cv_scores(
    df: DataFrame, *, truth: str, predicted: str, fold: str = "fold", metric: str = "balanced_accuracy"
) -> DataFrame:
    """(fold, score, mean_score): a metric per fold and its mean over the folds."""
    per_fold = binary_metrics(df, truth=truth, predicted=predicted, metrics=[metric], by=[fold], digits=None)
    per_fold = per_fold.withColumnRenamed(metric, "score")
    # one row per fold
    return per_fold.withColumn("mean_score", F.avg("score").over(Window.partitionBy()))
