"""Folds joined with many feature rows: what a task holds does not grow with the folds."""

from assayframe.operators import rows


def test_many_folds_are_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(rows, "SORTED_KEYS", 50, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # a null key, a key without features and one with two feature rows
        features = spark.createDataFrame([(i, i * 10) for i in range(100)] + [(7, 71), (None, 1)], "id long, x long")
        folds = spark.createDataFrame([(r, f, i) for r in range(2) for f in range(5) for i in [*range(100), None, 500]], "repeat int, fold int, id long")
        joined = rows.folds_with_features(folds, features, key="id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BuildRight" in plan
        got = sorted((r["repeat"], r["fold"], r["id"], r["x"]) for r in joined.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == sorted((r, f, i, x) for r in range(2) for f in range(5) for i in range(100) for x in ([70, 71] if i == 7 else [i * 10]))
