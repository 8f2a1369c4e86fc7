"""Quantiles, imputation, scaling and profiles on awkward inputs."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.operators import features, impute, profile, quantiles, ranking
from assayframe.operators.quantiles import exact_quantiles


# whole groups in a bracket, a coarse sketch with narrow brackets, and histograms
@pytest.mark.parametrize("accuracy,bracket_rows", [(20_000, 1_000_000), (1000, 1_000_000), (100, 1_000_000), (10, 50)])
def test_exact_quantiles(spark, monkeypatch, accuracy, bracket_rows):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = random.Random(3)
    data = [(i % 2, rng.gauss(0, 1) ** 3 if i % 3 else 2.5, None if i % 5 == 0 else float(i % 17)) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, by=["g"], bracket_rows=bracket_rows).collect()
    assert len(got) == 4
    for row in got:
        at = 1 if row["name"] == "x" else 2
        values = [d[at] for d in data if d[0] == row["g"] and d[at] is not None]
        assert row["n"] == len(values)
        assert np.allclose(row["quantiles"], np.quantile(values, probs), atol=1e-12)


def test_quantiles_take_two_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id % 3 as g", "id * 7919 % 5003 as x", "id as y").write.parquet(path)
    got = exact_quantiles(spark.read.parquet(path), ["x", "y"], [0.25, 0.5], by=["g"])
    # the first scan has filled the checkpointed brackets
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and got.count() == 6
    assert exact_quantiles(spark.read.parquet(path).limit(0), ["x"], [0.5]).count() == 0


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None, "b", None), (2, None, math.nan, "a", None), (3, 4.0, 3.0, None, None), (4, 9.0, 5.0, None, None)],
        "id long, x double, y double, s string, empty double",
    )
    got = impute.impute_numeric(df, ["x", "y"], strategy="median").orderBy("id").collect()
    assert [r["x"] for r in got] == [1.0, 4.0, 4.0, 9.0]
    assert [r["y"] for r in got] == [4.0, 4.0, 3.0, 5.0]
    assert [r["s"] for r in impute.impute_mode(df).orderBy("id").collect()] == ["b", "a", "a", "a"]
    with pytest.warns(UserWarning):
        cleaned = impute.clean_features(df)
    assert "empty" not in cleaned.columns and cleaned.count() == 4
    with pytest.raises(ValueError):
        impute.impute_numeric(df, ["x"], strategy="nope")


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, c double")
    assert [tuple(r) for r in impute.standard_scale(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert [tuple(r) for r in impute.minmax_scale(df).collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert [r["c"] for r in impute.sample_standardize(df).collect()] == [None, None]


def test_train_statistics_scale_all_roles(spark):
    df = spark.createDataFrame([(0, "train", 1.0), (0, "train", 3.0), (0, "val", 5.0)], "fold int, role string, x double")
    got = impute.scale_with_train_stats(df, ["x"], by=["fold"]).orderBy("x").collect()
    assert [r["x"] for r in got] == [-1.0, 1.0, 3.0]


def test_histogram_like_numpy(spark):
    rng = random.Random(5)
    values = [rng.gauss(10, 3) for _ in range(500)] + [10.0] * 50
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for bins in (7, None):
        got = profile.value_histogram(df, "x", bins=bins).orderBy("bin").collect()
        if bins is None:
            iqr = np.subtract(*np.percentile(values, [75, 25]))
            span = max(values) - min(values)
            bins = math.ceil(span / min(2 * iqr / len(values) ** (1 / 3), span / (math.log2(len(values)) + 1)))
        counts, edges = np.histogram(values, bins=bins)
        assert [r["n"] for r in got] == counts.tolist()
        assert np.allclose([r["bin_low"] for r in got], edges[:-1])
    same = profile.value_histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x").collect()
    assert [(r["bin"], r["n"]) for r in same] == [(0, 2)]


def test_correlation_of_constant_and_gaps(spark):
    data = [(1.0, 2.0, 7.0, 0), (2.0, None, 7.0, 1), (3.0, 1.0, 7.0, 1), (4.0, 5.0, 7.0, 0), (9.0, 3.5, 7.0, 1)]
    df = spark.createDataFrame(data, "a double, b double, c double, y int")
    got = {r["feature"]: r["abs_corr"] for r in ranking.correlation_ranking(df, ["a", "b", "c", "y"], target="y").collect()}
    assert set(got) == {"a", "b"}
    assert math.isclose(got["a"], abs(statistics.correlation([d[0] for d in data], [d[3] for d in data])), rel_tol=1e-9)
    known = [d for d in data if d[1] is not None]
    assert math.isclose(got["b"], abs(statistics.correlation([d[1] for d in known], [d[3] for d in known])), rel_tol=1e-9)


def test_sums_keep_nulls_in_the_class_size(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (0, 3.0)], "y int, x double")
    got = {r["y"]: r["value"] for r in profile.group_sums(df, label="y", columns=["x"], normalize=True).collect()}
    assert got == {1: 1.0, 0: 3.0}


def test_confusion_matrix_has_every_cell(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "t int, p int")
    got = {(r["truth"], r["predicted"]): (r["n"], r["share"]) for r in profile.confusion_matrix(df, truth="t", predicted="p").collect()}
    assert got == {(1, 1): (2, 2 / 3), (1, 2): (1, 1 / 3), (2, 1): (0, None), (2, 2): (0, None)}


def test_histogram_with_an_outlier(spark):
    values = [(float(i % 11),) for i in range(100)] + [(1e12,)]
    df = spark.createDataFrame(values, "x double")
    rows = profile.value_histogram(df, "x", list_empty=False).collect()
    assert sum(r["n"] for r in rows) == 101 and len(rows) <= 12
    with pytest.raises(Exception, match="too many bins"):
        profile.value_histogram(df, "x").collect()
    few = profile.value_histogram(df, "x", bins=10_000).collect()
    assert len(few) == 10_000 and sum(r["n"] for r in few) == 101


def test_confusion_matrix_keeps_missing_classes(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 0), (0, 0)], "t int, p int")
    rows = {(r["truth"], r["predicted"]): (r["n"], r["share"]) for r in profile.confusion_matrix(df, truth="t", predicted="p").collect()}
    assert len(rows) == 9
    assert rows[(1, None)] == (1, 0.5) and rows[(None, 0)] == (1, 1.0) and rows[(0, 1)] == (0, 0.0)


def test_projection_keeps_rows_with_gaps(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, None), (3, 2.0, 5.0), (4, float("nan"), 1.0), (5, 4.0, 2.0)], "id int, a double, b double")
    rows = {r["id"]: r["pc1"] for r in profile.project_2d({"s": df}, key="id", columns=["a", "b"]).collect()}
    assert {k for k, v in rows.items() if v is None} == {2, 4} and set(rows) == {1, 2, 3, 4, 5}


def test_fingerprints_keep_records_without_text(spark):
    df = spark.createDataFrame([(1, "one two three four"), (2, None), (3, "")], "id int, t string")
    for counts in (False, True):
        rows = {r["id"]: r["tokens"] for r in features.hashed_fingerprint(df, key="id", text="t", counts=counts).collect()}
        assert set(rows) == {1, 2, 3} and rows[2] is None and rows[1]
