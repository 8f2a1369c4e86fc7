"""Every query with SQL gives the same rows as DuckDB on the small tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, con, name):
    problem, _ = compare(queries()[name](spark, SF_DIR), con, oracle_sql()[name])
    assert problem is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_projection_axes(spark):
    rows = queries()["project_2d"](spark, SF_DIR).collect()
    n = len(rows)
    mean = [sum(r[c] for r in rows) / n for c in ("pc1", "pc2")]
    var = [sum((r[c] - m) ** 2 for r in rows) / n for c, m in zip(("pc1", "pc2"), mean)]
    cross = sum((r["pc1"] - mean[0]) * (r["pc2"] - mean[1]) for r in rows) / n
    assert var[0] >= var[1] > 0
    assert abs(cross) < 1e-6


def test_importances(spark):
    rows = queries()["importance_selection"](spark, SF_DIR).collect()
    assert abs(sum(r["importance"] for r in rows) - 1) < 1e-6
    assert 2 * sum(r["kept"] for r in rows) >= len(rows)


def test_tuned_trials_are_ranked(spark):
    rows = queries()["tune_cv"](spark, SF_DIR).orderBy("place").collect()
    scores = [r["score"] for r in rows]
    assert scores == sorted(scores, reverse=True)
    assert all(0 <= s <= 1 for s in scores)


def test_final_model_scores_every_row(spark):
    df = queries()["fit_final"](spark, SF_DIR)
    rows = df.collect()
    assert len({r["vec_id"] for r in rows}) == len(rows) == 500
    assert all(r["flag"] == (r["probability"] > 0.5) for r in rows)
