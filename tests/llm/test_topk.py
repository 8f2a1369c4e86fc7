"""Pivot elimination against all inner products."""

import random

import numpy as np
import pytest

from assayframe.llm import topk


def plain(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 2048])
def test_like_all_products(spark, block):
    rng = random.Random(3)
    vectors = [(i, [rng.randint(-60, 60) for _ in range(6)]) for i in range(150)]
    vectors += [(1000 + i, [50, -60, 7, 8, 9, 10]) for i in range(60)] + [(2000, [0] * 6), (2001, [1, 2]), (2002, [3, 4]), (2003, [])]
    vectors += [(3000, [1 << 40, -(1 << 20), 3, 4, 5, 6])]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<long>").selectExpr("*", "1 as id", "'x' as score")
    asked = df.filter("vec_id % 10 = 0 or vec_id > 1990")
    queries = [(i, v) for i, v in vectors if i % 10 == 0 or i > 1990]
    got = topk.top_k(df, asked.union(asked), 5, block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(vectors, queries, 5)
    assert topk.top_k(df, asked.limit(0), 5).count() == 0
    assert topk.top_k(df.limit(0), asked, 5).count() == 0
    assert topk.top_k(df.limit(1), df.limit(1), 5).count() == 0


def test_bounds_spare_work():
    rng = np.random.default_rng(0)
    centres = rng.integers(-100, 100, (20, 8))
    x = (centres[rng.integers(0, 20, 3000)] + rng.integers(-3, 4, (3000, 8))).astype(np.int64)
    pivots = x[:16].astype(float)
    side = {"id": np.arange(3000), "vectors": x, "to_pivots": topk._distances(x.astype(float), pivots)}
    done = list(topk.search_block({k: v[:20] for k, v in side.items()}, side, 5))
    for i, ids, scores, _ in done:
        full = x @ x[i]
        full[i] = -(1 << 60)
        best = np.lexsort((np.arange(3000), -full))[:5]
        assert list(ids) == list(best) and list(scores) == list(full[best])
    assert sum(n for *_, n in done) < 20 * 3000 / 2


def test_rows_without_id_take_no_part(spark):
    big = (1 << 53) + 1  # a double cannot hold it
    rows = [(big, [3, 4]), (None, [9, 9]), (big + 2, [1, 2]), (7, [2, 2])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    known = [(i, v) for i, v in rows if i is not None]
    assert sorted(map(tuple, topk.top_k(df, df, 2).collect())) == plain(known, known, 2)
    assert topk.top_k(df.filter("vec_id is null"), df, 2).count() == 0


def test_null_vectors_take_no_part(spark):
    rows = [(1, [3, 4]), (2, None), (3, [None, 9]), (4, [1, 2]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    known = [(i, v) for i, v in rows if v is not None and None not in v]
    assert sorted(map(tuple, topk.top_k(df, df, 2).collect())) == plain(known, known, 2)
    assert topk.top_k(df.filter("vec_id in (2, 3)"), df, 2).count() == 0
