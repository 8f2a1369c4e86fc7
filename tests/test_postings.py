"""Neighbours of token sets: no candidate is written, whatever is near and wherever it lies."""

import random
from pathlib import Path

import numpy as np
import pytest

from assayframe.operators import domain, neighbours, postings
from assayframe.runtime import scratch_path


def frame(spark, sets):
    return spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<long>")


def wanted(sets, train, k):
    near = lambda a, b: 1 - len(a & b) / len(a | b) if a | b else 0.0
    return {i: None if s is None else sorted(near(set(s), set(t)) for t in train if t is not None)[:k] for i, s in enumerate(sets)}


@pytest.mark.parametrize("far", [0, -(1 << 40)])
@pytest.mark.parametrize("small", [False, True])
def test_nearest_sets_are_those_of_a_full_sort(spark, monkeypatch, far, small):
    if small:
        for name, value in (("BLOCK_TOKENS", 150), ("SHARD_TOKENS", 200), ("BUNDLE_TOKENS", 400), ("CELL_PIECE", 64), ("MET_PIECE", 16), ("SMALL_BYTES", 0)):
            monkeypatch.setattr(postings, name, value)
    rng = random.Random(3)
    sets = [[rng.randrange(60) ** 2 // 40 for _ in range(rng.randint(1, 40))] for _ in range(150)]
    sets += [s[:-2] + [200] for s in sets[:30]] + [sets[0]] * 5 + [[], [], None, None] + [[1000 + i] for i in range(5)]
    sets = [None if s is None else sorted({t + far * (t % 3 == 0) for t in s}) for s in sets]
    df = frame(spark, sets)
    got = domain.knn_distances(df, df.filter("id % 3 > 0"), key="id", features="tokens", k=4, rows_per_block=20).collect()
    want = wanted(sets, [s for i, s in enumerate(sets) if i % 3], 4)
    assert len(got) == len(sets)
    for r in got:
        assert r.distances is None and want[r.id] is None or np.allclose(r.distances, want[r.id]), (r, want[r.id])


def test_rows_of_a_set_are_added_up(spark):
    values = spark.createDataFrame([("a", [1, 2], 1, 0), ("a", [1, 2], 0, 2), ("b", [1, 3], 1, 1), ("c", [9], 0, 1)], "rep string, tokens array<int>, asked int, known int")
    got = {r.rep: r.distances for r in neighbours.index_neighbours(values, 3, 1, 4).collect()}
    assert set(got) == {"a", "b"} and np.allclose(got["a"], [0, 0, 2 / 3]) and np.allclose(got["b"], [0, 2 / 3, 2 / 3])


def test_what_is_stored_does_not_grow_with_the_pairs(spark):
    # all sets share tokens with all others, none is near: the number of pairs is no part of what is written
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(400), 60)) for _ in range(1000)]
    df = frame(spark, sets).repartition(4).cache()
    df.count()
    folder = Path(scratch_path(spark, "x")).parent
    written = lambda: sum(p.stat().st_size for p in Path(str(folder).removeprefix("file:")).rglob("part-*"))
    before = written()
    near = domain.knn_distances(df, df, key="id", features="tokens", k=2)
    # a pair in eight bytes would be 8 MB
    assert near.count() == 1000 and written() - before < 2 << 20
    plan = near._jdf.queryExecution().toString()
    assert "array_intersect" not in plan and "posexplode" not in plan
