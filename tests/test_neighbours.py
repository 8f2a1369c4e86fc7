"""Nearest neighbours by cells and by rare tokens against full sorts, and what they ship."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.operators import domain, neighbours


def distances(x, rows, metric):
    if metric == "euclidean":
        return np.sqrt(((rows - x) ** 2).sum(1))
    if metric == "manhattan":
        return np.abs(rows - x).sum(1)
    return 1 - rows @ x / (np.linalg.norm(rows, axis=1) * np.linalg.norm(x) + 1e-9)


def vectors(seed, n, spread, size=6, centres=8):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, size)) * 10
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, size)) * spread


def frame(spark, x):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
@pytest.mark.parametrize("k,pivots,rows,spread", [(1, 6, 30, 0.3), (5, None, 16, 3.0), (40, 3, 8, 0.3)])
def test_cells_are_exact(spark, metric, k, pivots, rows, spread):
    x = vectors(1, 240, spread)
    x[20:50] = x[20]  # copies
    x[60] = 0  # a zero vector
    x[61] = -x[62]
    x[63] = x[64] * 1e-6
    df = frame(spark, x)
    train = df.filter("id < 150")
    got = domain.knn_distances(df, train, key="id", features="v", metric=metric, k=k, rows_per_block=rows, pivots=pivots).collect()
    assert sorted(r.id for r in got) == list(range(240))
    for r in got:
        want = np.sort(distances(x[r.id], x[:150], metric))[:k]
        assert np.allclose(r.distances, want, atol=1e-9), (r.id, r.distances, want)
        assert abs(r.mean_distance - want.mean()) < 1e-9


def test_own_distance_is_zero(spark):
    x = vectors(2, 80, 1.0) + 1e6  # products of large numbers cancel badly
    got = domain.knn_distances(frame(spark, x), frame(spark, x), key="id", features="v", metric="euclidean", k=1, rows_per_block=10).collect()
    assert all(r.distances == [0.0] for r in got)


def test_unusable_vectors(spark):
    x = [[1, 2], None, [3, None], [float("nan"), 1], [float("inf"), 1], [4, 5], [1, 2]]
    df = frame(spark, x)
    for strategy in ("cells", "dense"):
        got = {r.id: r.distances for r in domain.knn_distances(df, df, key="id", features="v", metric="manhattan", k=3, strategy=strategy).collect()}
        assert got == {0: [0, 0, 6], 1: None, 2: None, 3: None, 4: None, 5: [0, 6, 6], 6: [0, 0, 6]}
    with pytest.raises(ValueError, match="fewer than k"):
        domain.knn_distances(df, df.filter("id > 4"), key="id", features="v", metric="euclidean", k=3)
    none = domain.knn_distances(df.limit(0), df, key="id", features="v", metric="euclidean", k=2)
    assert none.count() == 0


def test_queries_go_to_few_cells(spark):
    centres, each = 20, 100
    x = vectors(3, centres * each, 0.05, size=8, centres=centres)
    values = frame(spark, x).select(F.md5(F.col("id").cast("string")).alias("rep"), F.col("v").alias("tokens"), F.lit(1).alias("asked"), F.lit(1).alias("known")).cache()
    space = neighbours.Space("euclidean")
    blocks, regions = neighbours.build_regions(values, space, 5, 50, 40)
    assert blocks.count() == len(x)  # every training row once
    shared = spark.sparkContext.broadcast(regions)
    asked = values.select("rep", "tokens", F.lit(0).alias("chunk"))
    first = asked.withColumns({"reach": F.lit(None).cast("double"), "done": F.lit(None).cast("array<int>")})
    sent = neighbours.ship(first, shared, space, 5)
    near = neighbours._compare(sent, blocks, space, 5)
    reach = neighbours.nearest_k(near, 5).select("rep", F.element_at("distances", -1).alias("reach"))
    done = sent.groupBy("rep").agg(F.collect_set("region").alias("done"))
    later = neighbours.ship(asked.join(reach, "rep").join(done, "rep"), shared, space, 5)
    shipped = sent.count() + later.count()
    assert shipped < len(x) * regions.parts.sum() / 8, (shipped, len(x), regions.parts.sum())


def test_plan_has_no_cartesian_product(spark):
    df = frame(spark, vectors(4, 50, 1.0))
    near = domain.knn_distances(df, df, key="id", features="v", metric="euclidean", k=2, rows_per_block=10)
    assert "Cartesian" not in near._jdf.queryExecution().toString() and "NestedLoop" not in near._jdf.queryExecution().toString()


@pytest.mark.parametrize("cutoff", [(1, 2), (9, 10), (1, 20)])
def test_index_finds_far_neighbours(spark, cutoff, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERIES_PER_TASK", 50)
    rng = random.Random(5)
    sets = [sorted(rng.sample(range(400), rng.randint(1, 30))) for _ in range(120)]
    sets += [[5000 + i] for i in range(10)] + [sorted({0, 1, 2, i}) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<int>")
    train = df.filter("id % 3 > 0")
    rows = [set(s) for i, s in enumerate(sets) if i % 3]
    got = domain.knn_distances(df, train, key="id", features="tokens", k=4, cutoff=cutoff, rows_per_block=25).collect()
    values = df.select(F.md5(F.col("id").cast("string")).alias("rep"), "id", "tokens", F.lit(1).alias("asked"), (F.col("id") % 3 > 0).cast("int").alias("known"))
    exact = Fraction(*cutoff)
    by_cells = neighbours.index_neighbours(values.drop("id"), 4, exact, 25, posting_rows=6).join(values.select("rep", "id"), "rep")
    assert {r.id: r.distances for r in by_cells.collect()} == {r.id: r.distances for r in got}
    assert len(got) == len(sets)
    for r in got:
        s = set(sets[r.id])
        want = sorted(1 - len(s & t) / len(s | t) for t in rows)[:4]
        assert np.allclose(r.distances, want), r.id
