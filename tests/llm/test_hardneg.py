"""The inverted multi-index against all scores."""

import random

import numpy as np
import pytest

from assayframe.llm import hardneg

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, anchors, positives=5, negatives=3):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for a, label, v in sorted({(i, k, tuple(v)) for i, k, v in anchors if i is not None and k is not None and v is not None and None not in v}):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, k, w in rows if len(w) == len(v))
        for s, i, _ in [x for x in scored if x[2] == label and x[1] != a][:positives]:
            window = [(t, j) for t, j, k in scored if k != label and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j) in enumerate(window)]
    return sorted(out)


def check(spark, rows, anchors=None, **options):
    anchors = rows if anchors is None else anchors
    schema = "vec_id long, label int, vector array<long>"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as id", "'x' as a", "2 as block")
    got = hardneg.hard_negatives(df, spark.createDataFrame(anchors, schema), **options)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == plain(rows, anchors)


def cloud(seed, n, size=8, labels=3, spread=12):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (6, size))
    return [(i, int(rng.integers(labels)), (centres[rng.integers(6)] + rng.integers(-spread, spread + 1, size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"codes": 3, "block": 16, "chunk": 5, "first": 1}, {"codes": 1, "block": 7, "sample": 3}])
def test_like_all_scores(spark, options):
    rows = cloud(1, 260)
    check(spark, rows, rows[::9], **options)


def test_edge_cases(spark):
    rng = random.Random(2)
    rows = cloud(3, 60, size=4)
    rows += [(100 + i, i % 2, [5, 5, 5, 5]) for i in range(50)]  # ties
    rows += [(200, 0, None), (201, None, [1, 2, 3, 4]), (None, 1, [1, 2, 3, 4]), (202, 0, [1, None, 3, 4])]
    rows += [(210, 0, [0, 0, 0, 0]), (211, 1, [0, 0, 0, 0])]
    rows += [(220 + i, i % 2, [i + 1]) for i in range(8)] + [(230 + i, i % 2, []) for i in range(4)] + [(240, 7, [1, 2, 3])]
    rows += [(300 + i, i % 2, [(1 << 30) + rng.randint(0, 1 << 20), -(1 << 29), i]) for i in range(12)]
    check(spark, rows, codes=4, block=20, chunk=30)


def test_empty_tables(spark):
    rows = cloud(4, 20)
    check(spark, [], rows)
    check(spark, rows, [])
    check(spark, rows[:1])


def test_repeated_rows(spark):
    rows = cloud(5, 40, labels=2)
    df = spark.createDataFrame([*rows, *rows[:3]], "vec_id long, label int, vector array<long>")
    got = hardneg.hard_negatives(df, df.filter("vec_id in (1, 11)"), block=10)
    assert {r.anchor_id for r in got.collect()} <= {1, 11}


def test_cells_come_in_order():
    rng = np.random.default_rng(0)
    for a, b in ((5, 7), (1, 4), (0, 3), (12, 12)):
        first, second = rng.normal(size=a).round(1), rng.normal(size=b).round(1)
        met = list(hardneg.cells_in_order(first, second))
        assert len({(u, v) for _, u, v in met}) == len(met) == a * b
        sums = [s for s, _, _ in met]
        assert sums == sorted(sums, reverse=True)
        assert all(s == first[u] + second[v] for s, u, v in met)


def test_windows_are_certain_early():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100, 100, (8, 16))
    rows = (centres[rng.integers(0, 8, 4000)] + rng.integers(-3, 4, (4000, 16))).astype(float)
    books = tuple(hardneg.fit_books(half, 16) for half in hardneg._halves(rows))
    codes = np.array([hardneg._nearest(half, book) for half, book in zip(hardneg._halves(rows), books)]).T
    far = np.array([np.sqrt(((half - book[c]) ** 2).sum(1)) for half, book, c in zip(hardneg._halves(rows), books, codes.T)]).T
    block = hardneg.Block(np.arange(4000), np.array(["x"] * 4000, object), rows, codes, far, books)
    for q in rows[:20]:
        best = hardneg.Best(5, hardneg.LOWEST)
        block.visit(q, [best], block.has_label("x"), True)
        scores = (block.vectors @ q).astype(int)
        order = np.lexsort((block.ids, -scores))[:5]
        assert list(best.ids) == list(block.ids[order])
    assert block.visited < 20 * 4000 / 2
