"""The mean normalised Manhattan distance, from sorted components and no pairs."""

import numpy as np
import pytest

from assayframe.operators import manhattan, similarity


def frame(spark, x):
    return spark.createDataFrame([(i, [None if c is None else float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>")


def mean(x):
    size = np.abs(x).sum(1)
    d = np.abs(x[:, None] - x[None]).sum(2) / (size[:, None] + size[None])
    return d[np.triu_indices(len(x), 1)].mean()


def no_tiles(*args):
    raise AssertionError("pairs are compared")


@pytest.mark.parametrize("spread", [1, 1e-6, 1e9])
def test_mean_needs_no_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(similarity, "over_block_pairs", no_tiles)
    monkeypatch.setattr(manhattan, "TASK_VALUES", 100)
    monkeypatch.setattr(manhattan, "PIECE", 7)
    x = np.random.default_rng(1).normal(size=(200, 4))
    x[:40, 1] = 0  # a value that many have
    x[50:60] = x[50]
    x[70] = 0
    x[80] *= spread
    x += 0.0
    got = similarity.average_dissimilarity(frame(spark, x), key="id", vector="v", metric="manhattan", normalize=True).first()
    assert got["n"] == 200 and np.isclose(got["average"], mean(x), rtol=1e-12)


@pytest.mark.parametrize("x", [[[1, 2]], [[0, 0], [0, 0], [1, 1]], [[1, None], [1, 2]], [[float("nan"), 1], [1, 2]], [[float("inf"), 1], [1, 2]]])
def test_mean_is_null(spark, x):
    got = similarity.average_dissimilarity(frame(spark, x), key="id", vector="v", metric="manhattan", normalize=True).first()
    assert got["n"] == len(x) and got["average"] is None


def test_sizes_out_of_proportion(spark):
    x = np.array([[1e-200, 0], [1, 2], [1e150, 3]])
    got = similarity.average_dissimilarity(frame(spark, x), key="id", vector="v", metric="manhattan", normalize=True).first()
    assert np.isclose(got["average"], mean(x), rtol=1e-12)


@pytest.mark.parametrize("low,high", [(1, 1), (1, 1.5), (2, 30), (1e-9, 1), (1e-99, 1e-70)])
def test_terms_add_up_to_the_inverse(low, high):
    u, w = manhattan.inverse_terms(low, high)
    r = np.geomspace(low, high, 999)
    assert (w >= 0).all() and np.abs(np.array([(w * np.exp(-x * u)).sum() for x in r]) * r - 1).max() < 1e-13
