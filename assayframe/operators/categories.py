"""Strings as category codes, and back.

The categories of a column are a table, numbered by one sort over all tasks; no value
reaches the driver. Columns are coded by joins that salt values which many rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.operators.skew import attach, number_rows
from assayframe.runtime import cut_lineage, small


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value, code, n): the distinct values of each column, numbered from 0 in their order.

    Values are ordered by code point; ``n`` is how many rows have one. Nulls are no
    category. Repeated column names count once.
    """
    columns = list(dict.fromkeys(columns))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "name", "value")
    counted = long.filter("value IS NOT NULL").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    numbered = cut_lineage(number_rows(counted, ["name", "value"], "place"))
    # one row per column
    first = small(numbered.groupBy(F.col("name").alias("__name")).agg(F.min("place").alias("__first")))
    placed = numbered.join(first, F.col("name") == F.col("__name"))
    return placed.select("name", "value", (F.col("place") - F.col("__first")).alias("code"), "n")


def encode_categories(df: DataFrame, table: DataFrame, columns: Sequence[str], *, spread_by: Sequence[str]) -> DataFrame:
    """``df`` with the codes of ``table`` in place of the values of the columns.

    A null, and a value that the table does not know, becomes null. ``spread_by`` are
    columns that tell rows apart: by them, rows of a frequent value are spread over tasks.
    Codes are long; :func:`rows.narrow_types` makes them as short as they can be.
    """
    return _exchanged(df, table, columns, "value", "code", spread_by)


def decode_categories(df: DataFrame, table: DataFrame, columns: Sequence[str], *, spread_by: Sequence[str]) -> DataFrame:
    """``df`` with the values of ``table`` in place of the codes of the columns; unknown codes become null."""
    return _exchanged(df, table, columns, "code", "value", spread_by)


def _exchanged(df: DataFrame, table: DataFrame, columns: Sequence[str], given: str, wanted: str, spread_by: Sequence[str]) -> DataFrame:
    order = df.columns
    for c in dict.fromkeys(columns):
        # a code may have been made shorter
        kind = "string" if given == "value" else "long"
        known = table.filter(F.col("name") == c).select(F.col(given).alias("__given"), F.col(wanted).alias("__wanted"), F.col("n").alias("__n"))
        keyed = df.withColumn("__given", F.col(c).cast(kind))
        keys = [s for s in spread_by if s != c]
        met = attach(keyed, known, ["__given"], "__n", keys or ["__given"], "left")
        df = met.withColumn(c, F.col("__wanted")).drop("__given", "__wanted", "__n")
    return df.select(*order)
