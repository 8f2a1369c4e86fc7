"""The user's distance of the query: the largest difference of a component, in a small piece at a time."""

import tracemalloc

import numpy as np
import pytest

from assayframe.plans.similarity_queries import _largest_gap


@pytest.mark.parametrize("missing", [False, True])
def test_largest_gap(missing):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(30, 5)), rng.normal(size=(40, 5))
    if missing:
        a[3, 1] = b[4] = np.nan
    with np.errstate(invalid="ignore"):
        d = np.abs(a[:, None] - b[None])
        want = np.where(np.isnan(d).all(2), np.nan, np.nan_to_num(d, nan=-1).max(2))
    assert np.array_equal(_largest_gap(a, b), want, equal_nan=True)
    assert _largest_gap(a[:0], b).shape == (0, 40) and np.isnan(_largest_gap(a[:, :0], b[:, :0])).all()


def test_no_second_matrix_of_all_pairs():
    a, b = np.random.default_rng(2).normal(size=(512, 4)), np.random.default_rng(3).normal(size=(2048, 4))
    tracemalloc.start()
    _largest_gap(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the result alone is 8 MB
    assert most < 10 << 20
