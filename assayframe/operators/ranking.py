"""Feature ranking and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.operators.model import complete_rows


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson r over the rows where both are known; null when one is constant."""
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation_ranking(df: DataFrame, columns: Sequence[str], *, target: str) -> DataFrame:
    """Features by absolute correlation with the target, with a strength band.

    All correlations come from one pass. Features without a defined correlation
    are dropped.
    """
    columns = [c for c in columns if c != target]
    row = df.agg(*[F.abs(safe_corr(F.col(c), F.col(target))).alias(c) for c in columns])
    strength = F.col("abs_corr")
    # The bounds of the bands.
    band = F.when(strength < 0.3, "weak").when(strength <= 0.5, "moderate").otherwise("strong")
    return (
        row.unpivot([], columns, "feature", "abs_corr")
        .filter("abs_corr IS NOT NULL")
        .withColumn("band", band)
        .orderBy(F.col("abs_corr").desc(), "feature")
    )


def importance_selection(
    df: DataFrame,
    columns: Sequence[str],
    *,
    target: str,
    model: str = "random_forest",
    threshold: float | None = None,
    seed: int = 1,
    missing: str = "error",
    **params,
) -> DataFrame:
    """Importance of each feature in a tree ensemble and whether it is kept.

    A feature is kept from the threshold on, by default the median importance.
    The forest is trained by Spark; only one number per feature comes back. A row
    without one of the columns is an error, or left out with ``missing="skip"``.
    """
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    makers = {"random_forest": RandomForestClassifier, "boosted_trees": GBTClassifier}
    if model not in makers:
        raise ValueError(f"unknown model {model!r}: use one of {sorted(makers)}")
    columns = [c for c in columns if c != target]
    assembler = VectorAssembler(inputCols=columns, outputCol="__x", handleInvalid="error")
    known = complete_rows(df.select(*columns, F.col(target).cast("double").alias("__y")), [*columns, "__y"], missing)
    training = assembler.transform(known)
    fitted = makers[model](featuresCol="__x", labelCol="__y", seed=seed, **params).fit(
        training.select("__x", "__y")
    )
    rows = [(c, float(v)) for c, v in zip(columns, fitted.featureImportances.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    if threshold is None:
        # one row per feature
        limit = table.agg(F.percentile("importance", F.lit(0.5)).alias("m")).scalar()
    else:
        limit = F.lit(float(threshold))
    return table.withColumn("kept", F.col("importance") >= limit).orderBy(
        F.col("importance").desc(), "feature"
    )
