"""Joins and ranks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.runtime import cut_lineage, written

# At most this many keys are on the broadcast list of heavy keys, so its size is
# fixed. A key that is not on the list holds less than 1/HEAVY_KEYS of all rows;
# both sides of the join are plain shuffles, so adaptive execution splits what is
# still skewed.
HEAVY_KEYS = 1024
# Rows of one key that a single task is trusted with.
ROWS_PER_TASK = 200_000


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size_col: str,
    spread_by: Sequence[str],
    how: str = "inner",
    salted: bool = True,
) -> DataFrame:
    """Join ``df`` with ``stats``, which has one row per key and its row count.

    ``how`` is inner, left, left_semi or left_anti; null keys match each other.
    Heavy keys (the ``HEAVY_KEYS`` largest above ``ROWS_PER_TASK``) are salted:
    their rows go to several tasks by a hash of ``spread_by`` and only their
    rows of ``stats`` are repeated. Everything else joins on its plain key.
    Where no key is that heavy, it is a plain join. ``salted=False`` is for a caller
    that has seen so: ``stats`` is then not written first.
    """
    keys = list(keys)
    if salted:
        # written once; the largest count tells whether any key needs salting
        stats, most = written(stats, "key-counts", F.max(size_col))
        salted = most is not None and most > ROWS_PER_TASK
    if not salted:
        right = stats.select(
            *[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(c) for c in stats.columns if c not in keys]
        )
        joined = df.join(right, _same(df, right, [(k, f"__r_{k}") for k in keys]), how)
        return joined.drop(*[f"__r_{k}" for k in keys])
    heavy = (
        stats.filter(F.col(size_col) > ROWS_PER_TASK)
        .orderBy(F.col(size_col).desc(), *keys)
        .limit(HEAVY_KEYS)
        .select(
            *[F.col(k).alias(f"__h_{k}") for k in keys],
            F.ceil(F.col(size_col) / ROWS_PER_TASK).cast("int").alias("__parts"),
        )
    )
    # bounded by HEAVY_KEYS rows
    heavy = F.broadcast(heavy)
    on_heavy = [(k, f"__h_{k}") for k in keys]
    heavy_names = [f"__h_{k}" for k in keys]

    left = df.join(heavy, _same(df, heavy, on_heavy), "left").drop(*heavy_names)
    left = left.withColumn(
        "__salt",
        F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("__parts")).cast("int"), F.lit(0)),
    ).drop("__parts")

    right = stats.join(heavy, _same(stats, heavy, on_heavy), "left").drop(*heavy_names)
    right = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in stats.columns if c not in keys],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts") - 1, F.lit(0)))).alias("__r_salt"),
    )
    condition = _same(left, right, [(k, f"__r_{k}") for k in keys]) & (left["__salt"] == right["__r_salt"])
    joined = left.join(right, condition, how)
    return joined.drop("__salt", "__r_salt", *[f"__r_{k}" for k in keys])


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add consecutive numbers from 1 in the given order, without a one-task window.

    The rows are range-partitioned and sorted once and written to the checkpoint
    folder; the row counts of the partitions, one number each, give the offsets.
    ``order`` has to tell the rows apart for the numbers to be repeatable.
    """
    shift = 33  # monotonically_increasing_id keeps the partition above bit 33
    ordered = df.orderBy(*order).withColumn("__pos", F.monotonically_increasing_id())
    ordered = ordered.withColumn("__part", F.shiftright("__pos", shift)).withColumn(
        "__pos", F.col("__pos").bitwiseAND(F.lit((1 << shift) - 1))
    )
    ordered = cut_lineage(ordered)
    # one row per partition, so the unpartitioned window is over a short table
    offsets = (
        ordered.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n"))
        .select(F.col("__part").alias("__p"), "__before")
    )
    return (
        ordered.join(F.broadcast(offsets), F.col("__part") == F.col("__p"))
        .withColumn(name, (F.col("__before") + F.col("__pos") + 1).cast("long"))
        .drop("__part", "__p", "__pos", "__before")
    )
