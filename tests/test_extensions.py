"""Categories, bucketed tables and users' own functions."""

import pytest
from pyspark.sql import functions as F

from assayframe.functions import user
from assayframe.functions.metrics import METRICS
from assayframe.operators import categories, domain, evaluate, features, rows, similarity, skew
from assayframe.sources import tables


@pytest.mark.parametrize("rows_per_task", [200_000, 5])
def test_codes_and_back(spark, monkeypatch, rows_per_task):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", rows_per_task)
    data = [(i, "hot" if i % 3 else f"v{i % 7}", None if i % 5 == 0 else "é" if i % 2 else "E", i % 4) for i in range(90)]
    df = spark.createDataFrame(data, "id long, a string, b string, n int")
    table = categories.category_table(df, ["a", "b", "a"])
    got = {(r.name, r.value): (r.code, r.n) for r in table.collect()}
    for name, at in (("a", 1), ("b", 2)):
        values = sorted({d[at] for d in data if d[at] is not None})
        assert {k: v for k, v in got.items() if k[0] == name} == {(name, v): (i, sum(d[at] == v for d in data)) for i, v in enumerate(values)}
    coded = categories.encode_categories(df, table, ["a", "b"], spread_by=["id"])
    assert coded.columns == df.columns and dict(coded.dtypes)["a"] == "bigint"
    short = rows.narrow_types(coded)
    assert dict(short.dtypes)["a"] == "tinyint"
    assert sorted(map(tuple, categories.decode_categories(short, table, ["a", "b"], spread_by=["id"]).collect())) == data
    new = spark.createDataFrame([(1, "unseen", "E", 0)], df.schema)
    assert categories.encode_categories(new, table, ["a", "b"], spread_by=["id"]).first()["a"] is None
    assert categories.category_table(df.limit(0), ["a"]).count() == 0


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_meet_without_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = spark.range(400).selectExpr("id", "id * 2.5 as x")
        folds = spark.range(400).selectExpr("id", "cast(id % 3 as int) as fold", "if(id % 5 = 0, 'val', 'train') as role")
        kept = {}
        for name, df, part in (("bucketed_test_records", records, []), ("bucketed_test_folds", folds, ["fold"])):
            options = {"key": "id", "buckets": 4, "path": str(tmp_path / name), "partition_by": part}
            tables.save_bucketed(df, name, **options)
            kept[name] = tables.load_bucketed(spark, name, schema=df.schema, **options)
            # a session that does not know the table reads it from its files
            other = tables.load_bucketed(spark, name + "_again", schema=df.schema, **options)
            assert sorted(map(tuple, other.collect())) == sorted(map(tuple, df.collect()))
        joined = rows.folds_with_features(kept["bucketed_test_folds"], kept["bucketed_test_records"], key="id")
        assert "Exchange" not in plan_of(joined) and joined.count() == 400
        group = rows.members_of_group(kept["bucketed_test_folds"], kept["bucketed_test_records"], key="id")
        assert "Exchange" not in plan_of(group)
        split = rows.rows_in_split(kept["bucketed_test_records"], kept["bucketed_test_folds"].filter("fold = 1"), key="id")
        assert "Exchange" not in plan_of(split) and split.count() == 133
        one_side = rows.folds_with_features(kept["bucketed_test_folds"], records, key="id")
        assert plan_of(one_side).count("Exchange hashpartitioning") <= 2 and one_side.count() == 400
    finally:
        for name in ("bucketed_test_records", "bucketed_test_folds"):
            for table in (name, name + "_again"):
                spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_user_metric(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)], "t int, p int")
    user.register_metric("lift", lambda: METRICS["precision"]() / ((F.col("tp") + F.col("fn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))))
    got = evaluate.binary_metrics(df, truth="t", predicted="p", metrics=["lift", "accuracy", "nope"]).first()
    assert got.asDict() == {"lift": 1.333, "accuracy": 0.667}
    assert "lift" not in evaluate.binary_metrics(df, truth="t", predicted="p").columns
    with pytest.raises(ValueError):
        user.register_metric("f1", METRICS["recall"])
    with pytest.raises(ValueError):
        user.register_metric("none", None)


def test_user_distance(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 1.0]), (3, [0.0, 7.0]), (4, None)], "id long, v array<double>")
    user.register_distance("tallest", lambda a, b: F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y))))
    got = similarity.average_dissimilarity(df, key="id", vector="v", metric="tallest").first()
    assert got["n"] == 3 and got["average"] == pytest.approx((3 + 7 + 6) / 3)
    assert similarity.average_dissimilarity(df.filter("id = 1"), key="id", vector="v", metric="tallest").first()["average"] is None
    with pytest.raises(ValueError):
        similarity.average_dissimilarity(df, key="id", vector="v", metric="tallest", normalize=True)
    with pytest.raises(ValueError):
        domain.knn_distances(df, df, key="id", features="v", metric="tallest", k=1)
    for taken in ("cosine", "jaccard"):
        with pytest.raises(ValueError):
            user.register_distance(taken, lambda a, b: a)


def test_one_bad_record_gives_null(spark):
    df = spark.createDataFrame([(1, "4", 2), (2, "x", 2), (3, None, 2), (4, "8", 0), (5, "9", None), (6, "6", 3)], "id long, s string, n int")
    ratio = user.record_function(lambda s, n: int(s) / n, "double")
    got = {r.id: r.q for r in df.select("id", ratio("s", "n").alias("q")).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: None, 5: None, 6: 2.0}
    block = features.property_block(df, key="id", structure="s", features=["q"], extra={"q": ratio("s", "n")})
    assert {r.id: r.q for r in block.collect()} == got
