"""All pairs and neighbours: rows are shipped once for each large block, whatever is compared at once."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.functions import user
from assayframe.operators import blocks, neighbours, packed, similarity


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>")


def test_blocks_follow_the_cores_not_the_piece(spark, monkeypatch):
    seen, real = [], similarity.over_block_pairs
    monkeypatch.setattr(similarity, "over_block_pairs", lambda df, key, n, *rest: seen.append(n) or real(df, key, n, *rest))
    x = np.random.default_rng(1).normal(size=(3000, 2))
    df = frame(spark, x)
    got = similarity.average_dissimilarity(df, key="id", vector="v", rows_per_block=2).first()
    tokens = df.select("id", F.array((F.col("id") % 50).cast("int"), F.lit(99)).alias("t"))
    rows = similarity.pair_distances(tokens, key="id", tokens="t", rows_per_block=2).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert got["n"] == 3000 and np.isclose(got["average"], d.sum() / (3000 * 2999))
    assert len(rows) == 3000 and all(np.isclose(r["sum_distance"], 2940 * 2 / 3) and r["n_others"] == 2999 for r in rows)
    cores = spark.sparkContext.defaultParallelism
    assert all(n * n <= 4 * blocks.TILES_PER_CORE * cores for n in seen), seen


@pytest.mark.parametrize("normalize", [False, True])
def test_near_vectors_far_from_zero(spark, normalize):
    x = 1e6 + np.random.default_rng(2).normal(size=(400, 3)) * 1e-3
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    if normalize:
        length = np.linalg.norm(x, axis=1)
        d = d / (length[:, None] * length[None])
    half = d[np.triu_indices(400, 1)].sum()
    assert np.isclose(blocks.euclidean_sum(x, x, normalize, True), half, rtol=1e-9)
    assert np.isclose(blocks.euclidean_sum(x[:150], x[150:], normalize, False), d[:150, 150:].sum(), rtol=1e-9)


def test_rows_without_key_are_paired_once(spark):
    x = np.random.default_rng(3).normal(size=(60, 2))
    df = frame(spark, x).withColumn("id", F.when(F.col("id") % 2 > 0, F.col("id")))
    got = similarity.average_dissimilarity(df, key="id", vector="v", rows_per_block=2).first()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert np.isclose(got["average"], d.sum() / (60 * 59))


def test_user_distance_of_matrices(spark):
    x = np.random.default_rng(4).normal(size=(300, 3))
    user.register_distance("widest", lambda a, b: np.abs(a[:, None] - b[None]).max(axis=2), matrices=True)
    got = similarity.average_dissimilarity(frame(spark, x), key="id", vector="v", metric="widest", rows_per_block=20).first()
    d = np.abs(x[:, None] - x[None]).max(axis=2)
    assert np.isclose(got["average"], d.sum() / (300 * 299))


def test_queries_go_to_homes(spark):
    df = frame(spark, np.random.default_rng(5).normal(size=(600, 16)))
    values = df.select(F.md5(F.col("id").cast("string")).alias("rep"), F.col("v").alias("tokens"), F.lit(1).alias("asked"), F.lit(1).alias("known")).cache()
    space = neighbours.Space("euclidean")
    rows, regions = neighbours.build_regions(values, space, 5, 10, 60, 200)
    assert rows.count() == 600 and rows.select("home").distinct().count() <= 6
    asked = values.select("rep", "tokens", F.lit(0).alias("chunk"), F.lit(1e9).alias("reach"), F.array().cast("array<int>").alias("done"))
    sent = neighbours.ship(asked, spark.sparkContext.broadcast(regions), space, 5)
    # no bound helps, so everything is compared: once per home, not once per block
    assert sent.count() <= 600 * 6
    near = neighbours.nearest_k(neighbours._compare(sent, rows, space, 5), 5)
    assert near.count() == 600 and near.filter("found = 5").count() == 600


def test_packed_tiles_have_a_task_each(spark, monkeypatch):
    monkeypatch.setattr(packed, "LEAST_ROWS", 20)
    sets = [[i % 8, 8 + i // 8 % 8, 16 + i // 64] for i in range(400)]
    df = spark.createDataFrame(list(enumerate(sets)), "rep long, tokens array<int>").withColumn("copies", F.lit(1).cast("long"))
    pairs = similarity.similarity_pairs(df, cutoff=(1, 2), strategy="packed", n_bits=64)
    want = sum(len(set(a) & set(b)) * 2 >= len(set(a) | set(b)) for i, a in enumerate(sets) for b in sets[:i])
    assert pairs.count() == want
    assert "REPARTITION_BY_NUM" in pairs._jdf.queryExecution().toString()
