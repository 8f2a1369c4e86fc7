"""Domain of applicability: how far new records are from the training records."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions import vectors as vec
from assayframe.operators.blocks import ROWS_PER_BLOCK, block_count, block_of, tanimoto_matrix, vector_matrix
from assayframe.operators.quantiles import exact_quantiles
from assayframe.operators.neighbours import cell_neighbours
from assayframe.operators.postings import nearest_sets, set_blocks
from assayframe.operators.similarity import as_fraction, token_digest
from assayframe.operators.skew import ROWS_PER_TASK, attach
from assayframe.runtime import cut_lineage, one_row

# Fixed value: share of the test rows that should be inside the domain.
WANTED_SHARE = 0.9


def knn_distances(
    queries: DataFrame,
    train: DataFrame,
    *,
    key: str,
    features: str,
    metric: str = "jaccard",
    k: int = 5,
    strategy: str | None = None,
    cutoff=(1, 2),
    rows_per_block: int = ROWS_PER_BLOCK,
    pivots: int | None = None,
) -> DataFrame:
    """(key, distances, mean_distance) to the k nearest training rows, exactly.

    Every query row comes back; one without features has null distances. ``features``
    holds tokens for ``jaccard`` and vectors of one length for the other metrics; a
    vector with a component that is null or not finite counts as none. A training row
    that is also a query counts itself, at distance 0.

    ``index`` (jaccard only, and the default there) looks queries up by their rarest
    tokens, see :func:`postings.nearest_sets`; ``cutoff`` is the similarity of its
    first round. It suits wide, sparse fingerprints. ``cells`` (the default of the other
    metrics) parts the training rows around ``pivots`` and sends a query only where its
    neighbours can be, see :func:`neighbours.cell_neighbours`; it suits narrow, full
    fingerprints too. ``dense`` compares all blocks of queries with all blocks of
    training rows, and only runs when asked for.
    """
    if metric != "jaccard":
        vec.distance(metric)
    if metric in vec.USER_DISTANCES:
        raise ValueError("the neighbour search needs a metric it knows bounds for")
    if k < 1:
        raise ValueError("k must be positive")
    strategy = strategy or ("index" if metric == "jaccard" else "cells")
    if strategy not in ("dense", "index", "cells"):
        raise ValueError(f"unknown strategy {strategy!r}: use 'index', 'cells' or 'dense'")
    if strategy == "index" and metric != "jaccard":
        raise ValueError("the index needs tokens and the jaccard metric")

    def usable(df: DataFrame, *columns: str) -> DataFrame:
        tokens = F.col(features)
        if metric == "jaccard":
            return df.select(*columns, tokens.alias("tokens"))
        whole = F.forall(tokens, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(*columns, F.when(whole, tokens.cast("array<double>")).alias("tokens"))

    # Equal feature values are compared once: one row per value, named by a digest, with
    # how many queries and training rows have it.
    digest = F.when(F.col("tokens").isNotNull(), token_digest("tokens")).alias("rep")
    asked = usable(queries, key).select(key, "tokens", digest)
    known = usable(train).select("tokens", digest).filter("rep IS NOT NULL")
    both = asked.filter("rep IS NOT NULL").select("rep", "tokens", F.lit(1).alias("asked"), F.lit(0).alias("known")).unionByName(
        known.select("rep", "tokens", F.lit(0).alias("asked"), F.lit(1).alias("known"))
    )
    if strategy == "index":
        # the blocks of the index put equal values together: a row is written there alone
        values = set_blocks(both, queries.count() + train.count(), rows_per_block)
        sums = [F.sum("n_known"), F.max("most"), F.sum("sets_known"), F.sum("sets_asked")]
    else:
        values = cut_lineage(
            both.groupBy("rep").agg(F.any_value("tokens").alias("tokens"), F.sum("asked").alias("asked"), F.sum("known").alias("known"))
        )
        sums = [F.sum("known"), F.max("asked"), F.count_if(F.col("known") > 0), F.count_if(F.col("asked") > 0)]
    n_train, most, *sizes = values.agg(*[F.coalesce(x, F.lit(0)) for x in sums]).first()
    if n_train < k:
        raise ValueError(f"{n_train} training rows are fewer than k = {k}")
    if strategy == "index":
        found = nearest_sets(values, k, float(1 - as_fraction(cutoff)))
    elif strategy == "dense":
        near = _dense_neighbours(values, values, metric, k, rows_per_block)
    else:
        asking = values.filter("asked > 0").select("rep", "tokens", F.lit(None).cast("double").alias("reach"))
        near = cell_neighbours(asking, values.filter("known > 0"), metric, k, rows_per_block, pivots, tuple(sizes))
    if strategy != "index":
        found = values.filter("asked > 0").select("rep", "asked").join(near, "rep")
    found = found.withColumn("mean_distance", F.aggregate("distances", F.lit(0.0), lambda s, x: s + x) / k)
    names = asked.select(key, "rep")
    measured = attach(names.filter("rep IS NOT NULL"), found, ["rep"], "asked", [key], salted=most > ROWS_PER_TASK)
    measured = measured.select(key, "distances", "mean_distance")
    unknown = names.filter("rep IS NULL").select(
        key, F.lit(None).cast("array<double>").alias("distances"), F.lit(None).cast("double").alias("mean_distance")
    )
    return measured.unionByName(unknown)


def _dense_neighbours(asked: DataFrame, values: DataFrame, metric: str, k: int, rows_per_block: int) -> DataFrame:
    """(rep, distances): each task compares one block of queries with one of training rows."""
    asked = asked.filter("asked > 0")
    known = values.filter("known > 0")
    q_blocks = block_count(asked.count(), rows_per_block)
    t_blocks = block_count(known.count(), rows_per_block)
    every_t = F.explode(F.sequence(F.lit(0), F.lit(t_blocks - 1)))
    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    columns = ["rep", "tokens", "known", "is_query", "bq", "bt"]
    q_side = (
        asked.withColumn("is_query", F.lit(True))
        .withColumn("bq", block_of(F.col("rep"), q_blocks))
        .withColumn("bt", every_t)
        .select(*columns)
    )
    t_side = (
        known.withColumn("is_query", F.lit(False))
        .withColumn("bt", block_of(F.col("rep"), t_blocks))
        .withColumn("bq", every_q)
        .select(*columns)
    )

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        asking = pdf["is_query"].to_numpy()
        q, t = pdf[asking], pdf[~asking]
        if q.empty or t.empty:
            return pd.DataFrame({"rep": q["rep"][:0], "near": []})
        if metric == "jaccard":
            d = 1 - tanimoto_matrix(q["tokens"].tolist(), t["tokens"].tolist())
        else:
            a = np.array(q["tokens"].tolist(), dtype=np.float64)
            b = np.array(t["tokens"].tolist(), dtype=np.float64)
            d = vector_matrix(a, b, metric, False)
        # k different values are enough even if each occurs once
        width = min(k, d.shape[1])
        best = np.argpartition(d, width - 1, axis=1)[:, :width]
        times = np.minimum(t["known"].to_numpy(), k)
        near = [np.sort(np.repeat(row[cols], times[cols]))[:k] for row, cols in zip(d, best)]
        return pd.DataFrame({"rep": q["rep"].to_numpy(), "near": near})

    parts = q_side.unionByName(t_side).groupBy("bq", "bt").applyInPandas(nearest, "rep string, near array<double>")
    return parts.groupBy("rep").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("distances")
    )


def domain_profile(train_distances: DataFrame, *, percentile: float = 75, distance: str = "mean_distance") -> DataFrame:
    """One row: least, largest and mean training distance and a percentile, 3 digits."""
    value = one_row(
        exact_quantiles(train_distances, [distance], [percentile / 100]).select(
            F.col("quantiles")[0].alias("v")
        )
    )["v"]
    return train_distances.agg(
        F.round(F.min(distance), 3).alias("min_distance"),
        F.round(F.max(distance), 3).alias("max_distance"),
        F.round(F.avg(distance), 3).alias("avg_distance"),
        F.count(F.lit(1)).alias("n_train"),
    ).withColumn("percentile", F.round(value, 3))


def _steps_up_to(value: Column, start: Column, step: float) -> Column:
    """The smallest whole i from 0 on with ``start + i * step >= value``.

    Division only gives a guess that may be one off at the edge of a step; the
    comparison decides, and it is the very one that judges the records.
    """
    guess = F.greatest(F.floor((value - start) / step), F.lit(1)).cast("long")

    def reaches(i: Column) -> Column:
        return start + i * F.lit(step) >= value

    return (
        F.when(value.isNull(), F.lit(None).cast("long"))
        .when(start >= value, F.lit(0).cast("long"))
        .when(reaches(guess - 1), guess - 1)
        .when(reaches(guess), guess)
        .when(reaches(guess + 1), guess + 1)
        .otherwise(guess + 2)
    )


def domain_threshold(
    train_distances: DataFrame,
    test_distances: DataFrame,
    *,
    metric: str = "jaccard",
    k: int = 5,
    step: float = 0.05,
    percentile: float = 75,
    max_distance: float | None = None,
    distance: str = "mean_distance",
) -> DataFrame:
    """One row (metric, k, threshold, n_train) that describes the domain.

    The threshold starts at the training percentile and grows by ``step`` until
    90% of the test rows are inside or the largest training distance is reached,
    which it may pass by less than a step. All steps are judged in one aggregate:
    each test row first counts at a known step. Test rows without a distance do
    not count.
    """
    if metric == "jaccard" and max_distance is not None and max_distance > 1:
        raise ValueError("a jaccard distance cannot exceed 1")
    if step <= 0:
        raise ValueError("step must be positive")
    profile = cut_lineage(domain_profile(train_distances, percentile=percentile, distance=distance))
    start = one_row(profile)
    largest = F.lit(float(max_distance)) if max_distance is not None else start["max_distance"]
    # the last step is where the threshold is no longer below the largest distance
    last = F.coalesce(_steps_up_to(largest, start["percentile"], step), F.lit(0))
    enters = _steps_up_to(F.col(distance), start["percentile"], step)
    counted = (
        test_distances.filter(F.col(distance).isNotNull())
        .groupBy(F.least(enters, last + 1).alias("i"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # one row per step from here on
    grid = profile.select(F.explode(F.sequence(F.lit(0), last)).alias("i"))
    total = one_row(counted.agg(F.sum("n").alias("n")))["n"]
    shares = (
        grid.join(counted, "i", "left")
        .withColumn("inside", F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("i")))
        .withColumn("share", F.try_divide("inside", total))
    )
    stop = one_row(shares.filter((F.col("share") >= WANTED_SHARE) | (F.col("i") >= last)).agg(F.min("i").alias("i")))
    threshold = F.col("percentile") + stop["i"] * F.lit(step)
    if metric == "jaccard":
        threshold = F.when(
            threshold > 1.0, F.raise_error(F.lit("the threshold passed 1: lower percentile or max_distance"))
        ).otherwise(threshold)
    return profile.select(
        F.lit(metric).alias("metric"), F.lit(k).alias("k"), threshold.alias("threshold"), "n_train"
    )


def within_domain(distances: DataFrame, domain: DataFrame, *, distance: str = "mean_distance") -> DataFrame:
    """Add whether each record's mean distance is within the domain's threshold."""
    return distances.withColumn("within", F.col(distance) <= one_row(domain.select("threshold"))["threshold"])


def domain_coverage(
    train_distances: DataFrame, test_distances: DataFrame, domain: DataFrame, *, distance: str = "mean_distance"
) -> DataFrame:
    """Share of the training and of the test rows within the threshold, 3 digits."""
    both = train_distances.select(F.lit("train").alias("role"), distance).unionByName(
        test_distances.select(F.lit("test").alias("role"), distance)
    )
    inside = within_domain(both, domain, distance=distance)
    return inside.groupBy("role").agg(F.round(F.avg(F.col("within").cast("double")), 3).alias("share"))
