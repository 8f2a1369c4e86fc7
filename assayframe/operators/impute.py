"""Imputation and scaling. Every statistic of every column comes from one aggregate."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.operators.quantiles import exact_quantiles
from assayframe.operators.rows import drop_missing, nan_to_null
from assayframe.runtime import one_row, small


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the numeric columns; booleans are not numeric."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and (columns is None or f.name in columns)
    ]


def string_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    ]


def _per_name_row(long: DataFrame, names: Sequence[str], value: Column) -> DataFrame:
    """(name, ...) rows to one row with a column per name."""
    return long.agg(*[F.max(F.when(F.col("name") == n, value)).alias(n) for n in names])


def impute_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, *, strategy: str = "mean", approx: bool = False
) -> DataFrame:
    """Fill nulls of numeric columns with the column's mean or median.

    The median is exact unless ``approx`` is set. Filled columns become double;
    a column without any value stays null.
    """
    names = numeric_columns(df, columns)
    if not names:
        return df
    clean = nan_to_null(df, names)
    if strategy == "mean":
        stats = clean.agg(*[F.avg(c).alias(c) for c in names])
    elif strategy == "median" and approx:
        stats = clean.agg(*[F.percentile_approx(c, 0.5).cast("double").alias(c) for c in names])
    elif strategy == "median":
        stats = _per_name_row(exact_quantiles(clean, names, [0.5]), names, F.col("quantiles")[0])
    else:
        raise ValueError(f"unknown strategy {strategy!r}: use 'mean' or 'median'")
    fill = one_row(stats)
    return clean.withColumns({c: F.coalesce(F.col(c).cast("double"), fill[c]) for c in names})


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of string columns with the most frequent value, the lowest on a tie."""
    names = string_columns(df, columns)
    if not names:
        return df
    counted = (
        df.select(*names)
        .unpivot([], names, "name", "value")
        .filter("value IS NOT NULL")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counted.groupBy("name").agg(F.min(F.struct(-F.col("n"), "value"))["value"].alias("mode"))
    fill = one_row(_per_name_row(best, names, F.col("mode")))
    return df.withColumns({c: F.coalesce(F.col(c), fill[c]) for c in names})


def _z(value: Column, mean: Column, std: Column) -> Column:
    # A constant column is only centred.
    return (value - mean) / F.when(std == 0, 1.0).otherwise(std)


def standard_scale(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """z-scores with the population deviation."""
    names = numeric_columns(df, columns)
    stats = one_row(
        df.agg(
            *[F.avg(c).alias(f"{c}__mean") for c in names],
            *[F.stddev_pop(c).alias(f"{c}__std") for c in names],
        )
    )
    return df.withColumns({c: _z(F.col(c), stats[f"{c}__mean"], stats[f"{c}__std"]) for c in names})


def sample_standardize(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(x - mean) / sample deviation; a constant column becomes null."""
    names = numeric_columns(df, columns)
    stats = one_row(
        df.agg(
            *[F.avg(c).alias(f"{c}__mean") for c in names],
            *[F.stddev_samp(c).alias(f"{c}__std") for c in names],
        )
    )
    return df.withColumns(
        {c: F.try_divide(F.col(c) - stats[f"{c}__mean"], stats[f"{c}__std"]) for c in names}
    )


def minmax_scale(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    names = numeric_columns(df, columns)
    stats = one_row(
        df.agg(
            *[F.min(c).alias(f"{c}__lo") for c in names], *[F.max(c).alias(f"{c}__hi") for c in names]
        )
    )

    def scaled(c: str) -> Column:
        width = stats[f"{c}__hi"] - stats[f"{c}__lo"]
        return (F.col(c) - stats[f"{c}__lo"]) / F.when(width == 0, 1.0).otherwise(width)

    return df.withColumns({c: scaled(c) for c in names})


def scale_with_train_stats(
    df: DataFrame, columns: Sequence[str], *, by: Sequence[str], role: str = "role", train: str = "train"
) -> DataFrame:
    """z-scores per fold, all roles scaled with the statistics of the training rows.

    The statistics have one row per fold. They are broadcast after their rows have
    been counted, since a shuffle by fold would put a whole fold into one task.
    """
    is_train = F.col(role) == train
    stats = df.groupBy(*by).agg(
        *[F.avg(F.when(is_train, F.col(c))).alias(f"__{c}_mean") for c in columns],
        *[F.stddev_pop(F.when(is_train, F.col(c))).alias(f"__{c}_std") for c in columns],
    )
    joined = df.join(small(stats), list(by))
    scaled = joined.withColumns({c: _z(F.col(c), F.col(f"__{c}_mean"), F.col(f"__{c}_std")) for c in columns})
    return scaled.select(*df.columns)


def clean_features(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    numeric: str = "mean",
    strings: bool = True,
    scale: bool = False,
    scale_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Impute, optionally scale, then drop rows that still miss a value.

    Booleans are not imputed. A numeric column without any value is dropped, with
    a warning, since nothing can be filled in.
    """
    chosen = list(columns) if columns is not None else df.columns
    df = nan_to_null(df)
    numbers = numeric_columns(df, chosen)
    if numbers:
        known = df.agg(*[F.count(c).alias(c) for c in numbers]).first()
        empty = [c for c in numbers if known[c] == 0]
        # an empty table has no column to judge
        if empty and any(known[c] for c in numbers):
            warnings.warn(f"columns without any value are dropped: {empty}", stacklevel=2)
            df = df.drop(*empty)
            numbers = [c for c in numbers if c not in empty]
    filled = impute_numeric(df, numbers, strategy=numeric) if numbers else df
    if strings:
        filled = impute_mode(filled, chosen)
    if scale:
        targets = scale_columns if scale_columns is not None else numbers
        filled = standard_scale(filled, targets)
    return drop_missing(filled)
