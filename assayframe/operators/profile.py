"""Profiles by class: the tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.operators.impute import minmax_scale, sample_standardize
from assayframe.operators.quantiles import exact_quantiles, long_form
from assayframe.operators.rows import union_sets
from assayframe.runtime import cut_lineage, one_row, small


def class_counts(df: DataFrame, *, label: str) -> DataFrame:
    """Rows per class, with the active to inactive ratio (3 digits) on every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the few rows of the class table
    active = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(everything)
    inactive = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(everything)
    return counts.withColumn("ratio", F.round(F.try_divide(active, inactive), 3))


def fold_class_ratios(df: DataFrame, *, by: Sequence[str], label: str, role: str = "role") -> DataFrame:
    """Active to inactive ratio of each role per fold, 3 digits."""

    def ratio(name: str) -> Column:
        here = F.col(role) == name
        return F.round(
            F.try_divide(
                F.count_if(here & (F.col(label) == 1)), F.count_if(here & (F.col(label) == 0))
            ),
            3,
        )

    return df.groupBy(*by).agg(*[ratio(r).alias(f"{r}_ratio") for r in ("train", "val", "test")])


def group_sums(
    df: DataFrame, *, label: str, columns: Sequence[str], normalize: bool = False
) -> DataFrame:
    """Sum of every feature per class in long form (label, feature, value).

    Normalised sums are divided by the class size, nulls included in the size.
    """
    size = F.count(F.lit(1))

    def value(c: str) -> Column:
        total = F.sum(F.col(c).cast("double"))
        return (total / size if normalize else total).alias(c)

    return df.groupBy(label).agg(*[value(c) for c in columns]).unpivot([label], list(columns), "feature", "value")


def box_stats(
    df: DataFrame, *, label: str, columns: Sequence[str], scale: bool = False
) -> DataFrame:
    """Quartiles, whiskers at 1.5 times the quartile range and outliers per group."""
    columns = list(dict.fromkeys(columns))
    source = df.select(label, *columns)
    if scale:
        source = minmax_scale(source, columns)
    quartiles = small(
        exact_quantiles(source, columns, [0.25, 0.5, 0.75], by=[label]).select(
            F.col(label).alias("__label"),
            F.col("name").alias("__name"),
            F.col("quantiles")[0].alias("q1"),
            F.col("quantiles")[1].alias("median"),
            F.col("quantiles")[2].alias("q3"),
        )
    )
    values = long_form(source, columns, [label])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    joined = values.join(
        quartiles, values[label].eqNullSafe(quartiles["__label"]) & (values["name"] == quartiles["__name"])
    )
    return (
        joined.groupBy(label, F.col("name").alias("descriptor"), "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


# Empty bins are listed in runs of so many, so no row makes more.
BINS_AT_ONCE = 4096


def value_histogram(
    df: DataFrame, column: str, *, bins: int | None = None, list_empty: bool = True, max_listed: int = 1_000_000
) -> DataFrame:
    """Histogram with a fixed number of bins or an automatic one.

    The automatic width is the smaller of the Sturges and the Freedman-Diaconis
    width. The last bin includes its upper edge. Empty bins are listed with 0,
    unless ``list_empty`` is off; an outlier may ask for more than ``max_listed``
    bins, which is then an error, while occupied bins alone are never too many.
    """
    values = long_form(df, [column]).select("value")
    if bins is None:
        spread = one_row(
            exact_quantiles(df, [column], [0.25, 0.75]).select(
                (F.col("quantiles")[1] - F.col("quantiles")[0]).alias("iqr")
            )
        )["iqr"]
        extent = values.agg(
            F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("n")
        )
        sturges = (F.col("hi") - F.col("lo")) / (F.log2(F.col("n")) + 1)
        robust = 2 * F.col("iqr") / F.pow(F.col("n").cast("double"), F.lit(1.0 / 3))
        width = F.when(F.col("iqr") > 0, F.least(sturges, robust)).otherwise(sturges)
        extent = extent.withColumn("iqr", spread).withColumn("width", width)
        number = F.when(F.col("width") > 0, F.ceil((F.col("hi") - F.col("lo")) / F.col("width"))).otherwise(1)
        extent = extent.withColumn("bins", number.cast("long")).select("lo", "hi", "bins")
    else:
        if bins < 1:
            raise ValueError("bins must be positive")
        extent = values.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).withColumn(
            "bins", F.lit(bins).cast("long")
        )
    extent = cut_lineage(extent)
    shape = one_row(extent)
    width = (shape["hi"] - shape["lo"]) / shape["bins"]
    position = F.when(
        width > 0, F.least(F.floor((F.col("value") - shape["lo"]) / width), shape["bins"] - 1)
    ).otherwise(0)
    counted = values.groupBy(position.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if list_empty:
        bounded = F.when(
            F.col("bins") > max_listed,
            F.raise_error(F.concat(F.lit("too many bins to list empty ones: "), F.col("bins"))).cast("long"),
        ).otherwise(F.col("bins"))
        runs = extent.filter("lo IS NOT NULL").withColumn("bins", bounded).select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1, F.lit(BINS_AT_ONCE).cast("long"))).alias("first"), "bins"
        )
        last = F.least(F.col("first") + BINS_AT_ONCE, F.col("bins")) - 1
        every = runs.select(F.explode(F.sequence(F.col("first"), last)).alias("bin"))
        counted = every.join(counted, "bin", "left")
    step = (shape["hi"] - shape["lo"]) / shape["bins"]
    lo = shape["lo"]
    return counted.select(
        F.col("bin").cast("int").alias("bin") if bins is not None or list_empty else "bin",
        (lo + F.col("bin") * step).alias("bin_low"),
        (lo + (F.col("bin") + 1) * step).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def mean_std_profile(df: DataFrame, columns: Sequence[str], *, standardize: bool = False) -> DataFrame:
    """Mean and mean plus/minus the sample deviation of every descriptor."""
    source = df.select(*columns)
    if standardize:
        source = sample_standardize(source, columns)
    return (
        long_form(source, columns)
        .groupBy(F.col("name").alias("descriptor"))
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        .withColumn("low", F.col("mean") - F.col("std"))
        .withColumn("high", F.col("mean") + F.col("std"))
    )


def rule_of_five_profile(
    df: DataFrame, *, label: str, weight: str, hba: str, hbd: str, logp: str
) -> DataFrame:
    """Per class the scaled rule-of-five properties, mean and population deviation."""
    scaled = df.select(
        label,
        (F.col(weight) / 100).cast("double").alias("weight/100"),
        (F.col(hba) / 2).cast("double").alias("hba/2"),
        F.col(hbd).cast("double").alias("hbd"),
        F.col(logp).cast("double").alias("logp"),
    )
    long = scaled.unpivot([label], [c for c in scaled.columns if c != label], "property", "value")
    return (
        long.groupBy(label, "property")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
        .withColumn("low", F.col("mean") - F.col("std"))
        .withColumn("high", F.col("mean") + F.col("std"))
        .withColumn("threshold", F.lit(5))  # fixed value: all four limits, scaled
    )


def confusion_matrix(df: DataFrame, *, truth: str, predicted: str) -> DataFrame:
    """Counts for every pair of classes, and the share within the true class.

    A missing value is a class of its own.
    """
    cells = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # a struct is collected even if the value in it is null; one per class
    classes = cells.select(F.explode(F.array(F.struct(F.col("truth").alias("c")), F.struct(F.col("predicted").alias("c")))).alias("c")).agg(
        F.collect_set("c").alias("classes")
    )
    every = classes.select("classes", F.explode("classes").alias("t")).select(
        F.col("t")["c"].alias("truth"), F.explode("classes").alias("p")
    ).select("truth", F.col("p")["c"].alias("predicted"))
    known = cells.select(F.col("truth").alias("__t"), F.col("predicted").alias("__p"), "n")
    full = every.join(
        known, F.col("truth").eqNullSafe(F.col("__t")) & F.col("predicted").eqNullSafe(F.col("__p")), "left"
    ).drop("__t", "__p").na.fill(0, ["n"])
    return full.withColumn(
        "share", F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy("truth")))
    )


def group_size_distribution(groups: DataFrame, *, group: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = groups.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("n_groups"))


def top_groups(df: DataFrame, *, group: str, k: int = 10) -> DataFrame:
    """The k most frequent groups with their sizes."""
    return (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("group_size"))
        .orderBy(F.col("group_size").desc(), group)
        .limit(k)
    )


def largest_group_members(df: DataFrame, *, group: str, key: str, k: int = 15) -> DataFrame:
    """The first k members, by key, of the largest group."""
    largest = top_groups(df, group=group, k=1).select(F.col(group).alias("__largest"))
    members = df.join(F.broadcast(largest), df[group].eqNullSafe(F.col("__largest"))).drop("__largest")
    return members.orderBy(key).limit(k)


def project_2d(sets: dict[str, DataFrame], *, key: str, columns: Sequence[str]) -> DataFrame:
    """Two principal components of the rows of several labelled sets together.

    Axes are found from the rows with all features; the others come back with
    null coordinates.
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = union_sets({n: df.select(key, *columns) for n, df in sets.items()})
    complete = rows.na.drop(subset=list(columns))
    assembled = VectorAssembler(inputCols=list(columns), outputCol="__x").transform(complete)
    model = PCA(k=2, inputCol="__x", outputCol="__pc").fit(assembled)
    axes = vector_to_array(F.col("__pc"))
    placed = model.transform(assembled).select("origin", key, axes[0].alias("pc1"), axes[1].alias("pc2"))
    nowhere = F.lit(None).cast("double")
    gaps = rows.filter(~_complete(columns)).select("origin", key, nowhere.alias("pc1"), nowhere.alias("pc2"))
    return placed.unionByName(gaps)


def _complete(columns: Sequence[str]) -> Column:
    """Every column has a value, as ``na.drop`` sees it."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])
