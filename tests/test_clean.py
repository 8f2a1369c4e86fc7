"""Cleaning, keys and selection against plain Python on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from assayframe.operators import clean, rows, skew


def table(spark, data, schema="id long, key string, label int, value double"):
    return spark.createDataFrame(data, schema)


DATA = [
    (1, "a", 1, 1.0),
    (2, "a", 1, 2.0),
    (3, "b", 0, 1.0),
    (4, "b", 1, 1.0),
    (5, "c", 0, 5.0),
    (6, None, 1, 1.0),
    (7, None, 0, 1.0),
    (8, "d", None, 1.0),
    (9, "d", 1, 1.0),
    (10, "e", 1, 0.0),
    (11, "e", 1, 50.0),
]


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_conflicts_are_dropped_and_replicates_stay(spark):
    df = table(spark, DATA)
    kept = clean.drop_conflicts_keep_replicates(df, key="key", label="label", spread_by=["id"])
    assert ids(kept) == [1, 2, 5, 6, 7, 10, 11]
    ranged = clean.drop_conflicts_keep_replicates(
        df, key="key", label="label", spread_by=["id"], value="value", max_range=20
    )
    assert ids(ranged) == [1, 2, 5, 6, 7]


def test_keep_first_drops_rows_without_key(spark):
    df = table(spark, DATA)
    assert ids(clean.drop_conflicts_keep_first(df, key="key", label="label", order=["id"])) == [1, 5, 10]
    assert ids(clean.first_per_key(df, key="key", order=["id"])) == [1, 3, 5, 6, 8, 10]


def test_empty_table(spark):
    df = table(spark, [])
    assert ids(clean.drop_conflicts_keep_first(df, key="key", label="label", order=["id"])) == []
    assert ids(clean.list_duplicates(df, key="key", spread_by=["id"])) == []
    assert ids(rows.row_keys(df, ["id"])) == []


def test_conflict_report_counts_values(spark):
    found = {r["key"]: (r["n_values"], r["n_rows"]) for r in clean.conflict_report(table(spark, DATA), key="key", label="label").collect()}
    assert found == {"b": (2, 2), "d": (2, 2)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_heavy_keys_are_salted_with_the_same_result(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 7)
    monkeypatch.setattr(skew, "HEAVY_KEYS", 2)
    data = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}", i % 2, float(i)) for i in range(300)]
    df = table(spark, data)
    stats = df.filter("key IS NULL OR key <> 'k3'").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = skew.attach(df, stats, ["key"], "n", ["id"], how)
    plain = skew.attach(df, stats, ["key"], "n", ["id"], how, salted=False)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    assert got.count() > 0


def test_row_keys_follow_the_order_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x")).repartition(16)
    got = rows.row_keys(df, ["x"]).orderBy("x").collect()
    assert [r["row_id"] for r in got] == list(range(5000))
    assert "Window" not in rows.row_keys(df, ["x"])._jdf.queryExecution().executedPlan().toString().split("Scan ExistingRDD")[0]


def test_nan_is_null(spark):
    df = spark.createDataFrame([(1, math.nan), (2, 1.0), (3, None)], "id long, x double")
    assert [r["x"] for r in rows.nan_to_null(df).orderBy("id").collect()] == [None, 1.0, None]
    assert ids(rows.drop_missing(df, ["x"])) == [2]


def test_narrow_types_uses_strict_bounds(spark):
    df = spark.createDataFrame([(126, 127, 40000, 1.0, True, "a")], "a long, b long, c long, d double, e boolean, f string")
    assert [t for _, t in rows.narrow_types(df).dtypes] == ["tinyint", "smallint", "int", "double", "boolean", "string"]
    assert dict(rows.narrow_types(df, narrow_floats=True).dtypes)["d"] == "float"


def test_select_features(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id long, fr_a int, b int")
    assert rows.select_features(df, pattern="^fr", keep=["id"]).columns == ["id", "fr_a"]
    assert rows.select_features(df, exclude=["b"], keep=["id"]).columns == ["id", "fr_a"]
    with pytest.raises(ValueError):
        rows.select_features(df, names=["nope"])
    with pytest.raises(ValueError):
        rows.select_features(df, pattern="^zz")


def test_joins_do_not_pair_everything(spark):
    df = table(spark, DATA)
    for joined in (
        rows.rows_in_split(df, df, key="id"),
        rows.rows_not_picked(df, df, key="id"),
        rows.folds_with_features(df.select("id"), df, key="id"),
        clean.drop_conflicts_keep_replicates(df, key="key", label="label", spread_by=["id"]),
    ):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_plain_join_where_no_key_is_heavy(spark):
    df = table(spark, [(i, f"k{i % 50}", 0, 1.0) for i in range(400)])
    stats = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    plan = skew.attach(df, stats, ["key"], "n", ["id"])._jdf.queryExecution().toString()
    assert "__salt" not in plan and "Generate" not in plan


def test_more_heavy_keys_than_the_list_holds(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(skew, "HEAVY_KEYS", 3)
    df = table(spark, [(i, f"k{i % 10}", 0, 1.0) for i in range(1000)])
    stats = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = skew.attach(df, stats, ["key"], "n", ["id"])
    assert got.count() == 1000
    # keys beyond the list hold less than a third of the rows each, here a tenth
    tasks = got.withColumn("task", F.spark_partition_id()).groupBy("key", "task").count().groupBy("key").agg(F.max("count").alias("most")).collect()
    assert max(r["most"] for r in tasks) <= 100
