"""Duplicate keys, conflicting labels and the cleaning report.

No operator here puts all rows of a key into one task: keys are summarised with
partial aggregation and the summaries are joined back with heavy keys salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.structure import largest_fragment
from assayframe.operators.rows import binarize_outcome, drop_missing
from assayframe.operators.skew import attach


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], *extra: Column) -> DataFrame:
    """The first row per key in the given order, as a partial aggregate."""
    rest = [c for c in df.columns if c not in order]
    row = F.struct(*[F.col(c) for c in [*order, *rest]])
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min(row).alias("__row"), *extra
    )


def list_duplicates(df: DataFrame, *, key: str, spread_by: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, sorted by key."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    repeated = sizes.filter("n_rows > 1")
    return attach(df, repeated, [key], "n_rows", spread_by).orderBy(key, *spread_by)


def _label_summary(df: DataFrame, key: str, label: str, value: str | None = None) -> DataFrame:
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.min(label).alias("__lo"),
        F.max(label).alias("__hi"),
        F.max(F.col(label).isNull()).alias("__some_null"),
        F.max(F.col(label).isNotNull()).alias("__some_known"),
    ]
    if value:
        aggs.append((F.max(value) - F.min(value)).alias("__range"))
    return df.groupBy(key).agg(*aggs)


def _conflicting(max_range: float | None) -> Column:
    # A missing label counts as a value of its own, so it conflicts with a known one.
    rule = (F.col("__lo") != F.col("__hi")) | (F.col("__some_null") & F.col("__some_known"))
    rule = F.coalesce(rule, F.lit(False))
    if max_range is not None:
        rule = rule | F.coalesce(F.col("__range") > max_range, F.lit(False))
    return rule


def drop_conflicts_keep_replicates(
    df: DataFrame,
    *,
    key: str,
    label: str,
    spread_by: Sequence[str],
    value: str | None = None,
    max_range: float | None = None,
) -> DataFrame:
    """Drop every row of a key whose label takes more than one value.

    Replicates that agree are all kept, and so are rows without a key, which
    belong to no compound. With ``value`` and ``max_range``, a key whose values
    lie further apart than that is a conflict too.
    """
    if (value is None) != (max_range is None):
        raise ValueError("value and max_range go together")
    conflicts = (
        _label_summary(df, key, label, value)
        .filter(_conflicting(max_range) & F.col(key).isNotNull())
        .select(key, "n_rows")
    )
    return attach(df, conflicts, [key], "n_rows", spread_by, "left_anti")


def drop_conflicts_keep_first(df: DataFrame, *, key: str, label: str, order: Sequence[str]) -> DataFrame:
    """As above, then one row per key: the first in ``order``. Rows without key go.

    The first row is found while the key is summarised, so this is one shuffle
    of at most one row per key and map task. With no row left the result is empty.
    """
    summary = _first_row(
        df.filter(F.col(key).isNotNull()),
        [key],
        order,
        F.min(label).alias("__lo"),
        F.max(label).alias("__hi"),
        F.max(F.col(label).isNull()).alias("__some_null"),
        F.max(F.col(label).isNotNull()).alias("__some_known"),
    )
    kept = summary.filter(~_conflicting(None))
    return kept.select("__row.*").select(*df.columns)


def first_per_key(df: DataFrame, *, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of every key in ``order``; rows without key count as one key."""
    return _first_row(df, [key], order).select("__row.*").select(*df.columns)


def conflict_report(df: DataFrame, *, key: str, label: str) -> DataFrame:
    """Keys with more than one label value: rows and number of values.

    Counted over (key, label) pairs so that a frequent key is already reduced to
    its few labels before it is shuffled.
    """
    pairs = df.filter(F.col(key).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"))
        .filter("n_values > 1")
    )


def cleaning_report(df: DataFrame, *, structure: str, outcome: str, key: str) -> DataFrame:
    """One row: rows, missing structures and outcomes, unique keys, duplicate rows."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(structure).isNull()).alias("no_structure"),
        F.count_if(F.col(outcome).isNull()).alias("no_outcome"),
    )
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.sum("no_structure").alias("n_missing_structure"),
        F.sum("no_outcome").alias("n_missing_outcome"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_duplicate_rows"),
    )


def clean_assay(
    df: DataFrame,
    *,
    structure: str,
    outcome: str,
    row_id: str,
    label: str = "label",
    positive: str = "Active",
    fragment: str = "fragment",
    key: str | None = None,
) -> DataFrame:
    """The whole cleaning step for an assay table.

    Drops rows without structure or outcome, adds the 0/1 label and the largest
    fragment, and drops compounds with conflicting labels. Compounds are told
    apart by ``key`` or, without one, by the fragment text.
    """
    known = drop_missing(df, [structure])
    labelled = binarize_outcome(known, outcome, label=label, positive=positive)
    reduced = labelled.withColumn(fragment, largest_fragment(F.col(structure)))
    reduced = drop_missing(reduced, [fragment])
    return drop_conflicts_keep_replicates(reduced, key=key or fragment, label=label, spread_by=[row_id])
