"""Row and column selection, keys, joins and set operations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.operators.skew import number_rows

# More feature rows than these are not sorted together with the folds their keys stand in.
SORTED_KEYS = 200_000


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into null in float columns, so that one kind of missing is left."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = [c for c in floats if columns is None or c in columns]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in chosen})


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without a null (or NaN) in the given columns, by default in any."""
    return df.na.drop(how="any", subset=list(columns) if columns else None)


def binarize_outcome(
    df: DataFrame, outcome: str, *, label: str = "label", positive: str = "Active"
) -> DataFrame:
    """1 for the positive outcome, 0 for any other text; rows without outcome go."""
    known = drop_missing(df, [outcome])
    return known.withColumn(label, F.when(F.col(outcome) == positive, 1).otherwise(0))


def class_slice(df: DataFrame, label: str, value) -> DataFrame:
    """The rows of one class."""
    return df.filter(F.col(label) == F.lit(value))


def select_features(
    df: DataFrame,
    *,
    names: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    pattern: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Choose columns by list, by exclusion or by a regex on the name.

    ``keep`` columns (keys, target) are always in the result. An empty choice is
    an error, as is a listed name that does not exist.
    """
    if names is not None:
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise ValueError(f"no such columns: {missing}")
    chosen = [
        c
        for c in df.columns
        if c not in keep
        and c not in exclude
        and (names is None or c in names)
        and (pattern is None or re.match(pattern, c))
    ]
    if not chosen:
        raise ValueError("no feature column is selected")
    return df.select(*keep, *chosen)


def row_keys(df: DataFrame, order: Sequence[str | Column], *, name: str = "row_id") -> DataFrame:
    """Consecutive ids from 0 over an explicit order."""
    numbered = number_rows(df, order, name)
    return numbered.withColumn(name, F.col(name) - 1)


# Strict bounds, as a value equal to the limit does not fit in the checked rule.
_INT_STEPS = [(T.ByteType(), 8), (T.ShortType(), 16), (T.IntegerType(), 32)]
# Largest finite single-precision value.
_FLOAT_MAX = 3.4028234663852886e38


def narrow_types(df: DataFrame, *, narrow_floats: bool = False) -> DataFrame:
    """Cast whole-number columns to the smallest type their values fit into.

    All minima and maxima come from one aggregate. Floats are only narrowed on
    request since that loses digits; booleans and strings stay as they are.
    """
    ints = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    ]
    doubles = [f.name for f in df.schema.fields if narrow_floats and isinstance(f.dataType, T.DoubleType)]
    if not ints and not doubles:
        return df
    bounds = []
    for c in ints + doubles:
        bounds += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    seen = df.agg(*bounds).first()
    casts: dict[str, Column] = {}
    for c in ints:
        lo, hi = seen[f"{c}__lo"], seen[f"{c}__hi"]
        if lo is None:
            continue
        for target, bits in _INT_STEPS:
            if lo > -(1 << (bits - 1)) and hi < (1 << (bits - 1)) - 1:
                casts[c] = F.col(c).cast(target)
                break
    for c in doubles:
        lo, hi = seen[f"{c}__lo"], seen[f"{c}__hi"]
        if lo is not None and lo > -_FLOAT_MAX and hi < _FLOAT_MAX:
            casts[c] = F.col(c).cast(T.FloatType())
    return df.withColumns(casts) if casts else df


# --- joins -------------------------------------------------------------------


def assemble_features(base: DataFrame, *blocks: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Put feature blocks next to each other by key. Each block has one row per key."""
    for block in blocks:
        base = base.join(block, key, how)
    return base


def rows_in_split(df: DataFrame, split: DataFrame, *, key: str) -> DataFrame:
    """Rows whose key is in the split."""
    return df.join(split.select(key), key, "left_semi")


def rows_not_picked(df: DataFrame, picked: DataFrame, *, key: str) -> DataFrame:
    """Rows whose key has not been picked."""
    return df.join(picked.select(key), key, "left_anti")


def folds_with_features(folds: DataFrame, features: DataFrame, *, key: str) -> DataFrame:
    """Feature rows of every (repeat, fold, role).

    A key stands in each fold of each repetition; such rows take little room in a shuffle
    but much in a sort. So where keys are many, a task holds the feature rows of its keys
    and the folds stream past them. Tables in buckets of their key are not shuffled for it.
    """
    if features.count() > SORTED_KEYS:
        features = features.hint("shuffle_hash")
    return folds.join(features, key)


def members_of_group(assignment: DataFrame, records: DataFrame, *, key: str) -> DataFrame:
    """The records behind a group assignment."""
    return assignment.join(records, key)


# --- sets --------------------------------------------------------------------


def union_sets(sets: Mapping[str, DataFrame], *, origin: str = "origin") -> DataFrame:
    """Concatenate row sets, keeping where each row came from."""
    if not sets:
        raise ValueError("nothing to concatenate")
    result = None
    for name, df in sets.items():
        tagged = df.withColumn(origin, F.lit(name))
        result = tagged if result is None else result.unionByName(tagged)
    return result


def distinct_keys(df: DataFrame, *, key: str) -> DataFrame:
    """The unique keys of a row set."""
    return df.select(key).distinct()


def split_difference(df: DataFrame, *others: DataFrame, key: str) -> DataFrame:
    """Keys of ``df`` that are in none of the other sets."""
    rest = distinct_keys(df, key=key)
    for other in others:
        rest = rest.join(other.select(key), key, "left_anti")
    return rest
