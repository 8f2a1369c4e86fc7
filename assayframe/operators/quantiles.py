"""Exact quantiles of many columns at once, without a per-group value map.

The built-in exact percentile keeps every distinct value of a group in one
aggregation buffer. Here a mergeable sketch of each column and group gives brackets
around the wanted ranks in a first scan, together with counts and extents; a second
scan counts what lies below a bracket and ranks the values in it, after equal values
have been counted together. Where a bracket would still be too large, groups are
narrowed down by histograms, which are plain partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.runtime import small

# The sketch is off by one rank in so many at most.
ACCURACY = 20_000
BINS = 4096
# Rows a bracket may hold before its values are ranked.
BRACKET_ROWS = 1_000_000


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., name, value) rows of the known values; repeated column names count once."""
    columns = list(dict.fromkeys(columns))
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(by), columns, "name", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _inside(long: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = brackets
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__b_{k}")
    condition = (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    return long.join(renamed, condition).drop(*[f"__b_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    by: Sequence[str] = (),
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles: one row (by..., name, n, quantiles) per group.

    ``quantiles`` is an array in the order of ``probabilities``. ``by`` is meant to
    be of low cardinality, such as a class label: then no row of the data is
    shuffled before it is counted. With many groups the brackets are too many to
    broadcast and the rows are shuffled by group.
    """
    columns = list(dict.fromkeys(columns))
    brackets = small(_sketched(df, columns, probabilities, by))
    largest = brackets.agg(F.max("n")).first()[0] or 0
    if largest * 8 <= bracket_rows * ACCURACY:
        return _ranked_in_brackets(long_form(df, columns, by), brackets, [*by, "name"], len(probabilities))
    return _narrowed(df, columns, probabilities, by, bracket_rows)


def _sketched(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., name, n, j, position, lo, hi): for each wanted quantile, values its neighbouring ranks lie between.

    All columns in one aggregate, in the wide form. The sketch is asked for ranks that are
    farther off than it can err.
    """
    off = 3 / ACCURACY
    asked = [float(x) for p in probabilities for x in (max(p - off, 0.0), min(p + off, 1.0))]
    known = df.select(*by, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(c).alias(f"__n{i}"), F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}"), F.percentile_approx(c, asked, ACCURACY).alias(f"__q{i}")]
    wide = known.groupBy(*by).agg(*aggs)

    def bracket(i: int, j: int) -> Column:
        p = float(probabilities[j])
        position = F.lit(p) * (F.col(f"__n{i}") - 1)
        # a few ranks apart, rounding to whole ranks would count: small groups are one bracket
        few = F.col(f"__n{i}") * off < 4
        lo = F.when(few | F.lit(p - off <= 0), F.col(f"__lo{i}")).otherwise(F.col(f"__q{i}")[2 * j])
        hi = F.when(few | F.lit(p + off >= 1), F.col(f"__hi{i}")).otherwise(F.col(f"__q{i}")[2 * j + 1])
        return F.struct(
            F.lit(columns[i]).alias("name"), F.col(f"__n{i}").alias("n"), F.lit(j).alias("j"), position.alias("position"), lo.alias("lo"), hi.alias("hi")
        )

    every = F.array(*[bracket(i, j) for i in range(len(columns)) for j in range(len(probabilities))])
    return wide.select(*by, F.explode(every).alias("b")).select(*by, "b.*").filter("n > 0")


def _ranked_in_brackets(long: DataFrame, brackets: DataFrame, keys: Sequence[str], n_quantiles: int) -> DataFrame:
    """The quantiles from one scan of ``long``: how many values are below a bracket, and how often those in it occur."""
    renamed = brackets
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__b_{k}")
    condition = F.col("value") <= F.col("hi")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    # all that is below the bracket is one null value
    met = long.join(renamed, condition).withColumn("value", F.when(F.col("value") >= F.col("lo"), F.col("value")))
    values = met.groupBy(*keys, "n", "j", "position", "value").agg(F.count(F.lit(1)).alias("times"))
    up_to = Window.partitionBy(*keys, "j").orderBy(F.asc_nulls_first("value"))
    start = F.sum("times").over(up_to) - F.col("times")
    low, high = F.floor("position"), F.ceil("position")

    def holds(rank: Column) -> Column:
        return (rank >= F.col("start")) & (rank < F.col("start") + F.col("times"))

    picked = values.withColumn("start", start).filter(F.col("value").isNotNull() & (holds(low) | holds(high)))
    found = picked.groupBy(*keys, "n", "j", "position").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    exact = F.col("low") + (F.col("high") - F.col("low")) * (F.col("position") - F.floor("position"))
    return found.groupBy(*keys, "n").agg(F.sort_array(F.collect_list(F.struct("j", exact.alias("q")))).alias("q")).select(*keys, "n", F.col("q.q").alias("quantiles"))


def _narrowed(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str], bracket_rows: int) -> DataFrame:
    """The quantiles by histograms of ever smaller brackets, for groups too large for one."""
    keys = [*by, "name"]
    long = long_form(df, columns, by)
    lower = F.transform(
        F.array(*[F.lit(float(p)) for p in probabilities]),
        lambda p: F.floor(p * (F.col("n") - 1)).cast("long"),
    )
    upper = F.transform(
        F.array(*[F.lit(float(p)) for p in probabilities]),
        lambda p: F.ceil(p * (F.col("n") - 1)).cast("long"),
    )
    brackets = (
        long.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("before", F.lit(0).cast("long"))
        .withColumn("ranks", F.array_distinct(F.concat(lower, upper)))
    )
    brackets = small(brackets)
    sizes = brackets.select(*keys, "n")

    while True:
        widest = brackets.filter("lo < hi").agg(F.max("n")).first()[0] or 0
        if widest <= bracket_rows:
            break
        inside = _inside(long, brackets.withColumnRenamed("n", "__n"), keys)
        share = (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        bin_no = F.when(F.col("hi") > F.col("lo"), F.least(F.floor(share * BINS), F.lit(BINS - 1))).otherwise(0)
        # A bracket is known by where it starts; its bins are at most BINS rows.
        counted = (
            inside.withColumn("bin", bin_no)
            .groupBy(*keys, "before", "ranks", "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        )
        up_to = Window.partitionBy(*keys, "before").orderBy("bin")
        counted = counted.withColumn("start", F.col("before") + F.sum("n").over(up_to) - F.col("n"))
        held = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
        narrowed = counted.withColumn("ranks", held).filter(F.size("ranks") > 0)
        narrowed = narrowed.select(*keys, "n", "lo", "hi", F.col("start").alias("before"), "ranks")
        brackets = small(narrowed)
        if (brackets.filter("lo < hi").agg(F.max("n")).first()[0] or 0) >= widest:
            break  # values this close cannot be told apart by equal-width bins

    values = (
        _inside(long, brackets.select(*keys, "lo", "hi", "before", "ranks"), keys)
        .groupBy(*keys, "before", "ranks", "value")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    up_to = Window.partitionBy(*keys, "before").orderBy("value")
    values = values.withColumn("start", F.col("before") + F.sum("times").over(up_to) - F.col("times"))
    picked = values.select(
        *keys,
        "value",
        F.explode(
            F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("times")))
        ).alias("rank"),
    )
    found = picked.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    renamed = sizes
    condition = F.lit(True)
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__s_{k}")
        condition = condition & F.col(k).eqNullSafe(F.col(f"__s_{k}"))

    def interpolate(p):
        position = p * (F.col("n") - 1)
        low = F.element_at("at", F.floor(position).cast("long"))
        high = F.element_at("at", F.ceil(position).cast("long"))
        return low + (high - low) * (position - F.floor(position))

    return found.join(renamed, condition).select(
        *keys,
        "n",
        F.transform(F.array(*[F.lit(float(p)) for p in probabilities]), interpolate).alias("quantiles"),
    )
