"""Splits against the sequential loops they stand for."""

import hashlib
import random
from math import floor

import pytest
from pyspark.sql import functions as F

from assayframe.operators import evaluate, model, split
from assayframe.streaming.score import score_stream
from assayframe.sources import tables


def records(spark, sizes):
    data, i = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            data.append((i, f"g{g}"))
            i += 1
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "id long, grp string"), data


def group_table(data):
    groups = {}
    for i, g in data:
        groups.setdefault(g, []).append(i)
    return sorted(((len(m), min(m), g) for g, m in groups.items()), key=lambda x: (-x[0], x[1]))


def fill(groups, train, val, first=False):
    tr = va = 0
    roles = {}
    for pos, (size, _, g) in enumerate(groups):
        if tr + size <= train or (first and pos == 0):
            roles[g], tr = "train", tr + size
        elif val > 0 and va + size <= val:
            roles[g], va = "val", va + size
        else:
            roles[g] = "test"
    return roles


SIZES = [40, 17, 9, 9, 8, 7, 7, 5, 5, 4, 3, 3, 2, 2, 2, 1, 1, 1, 1, 1, 1]


def shuffled(groups, seed):
    return sorted(groups, key=lambda g: hashlib.md5(f"{seed}|{g[1]}".encode()).hexdigest())


@pytest.mark.parametrize("train,val", [(0.7, 0.15), (0.8, 0.0), (0.1, 0.3), (1.0, 0.0)])
def test_group_split(spark, monkeypatch, train, val):
    monkeypatch.setattr(split, "ORDER_BUCKETS", 3)
    df, data = records(spark, SIZES)
    groups, n = group_table(data), sum(SIZES)
    test = 1 - train - val
    rows = split.group_split(df, group="grp", key="id", train=train, val=val, test=test).collect()
    assert {r["grp"]: r["role"] for r in rows} == fill(groups, train * n, val * n)
    assert len(rows) == n
    rows = split.cluster_split(df, cluster="grp", key="id", train=train, val=val, test=test, shuffle_seed=3).collect()
    order = groups[:10] + shuffled(groups[10:], 3)
    assert {r["grp"]: r["role"] for r in rows} == fill(order, int(train * n), int(val * n), first=True)


def test_ratios_are_checked(spark):
    df, _ = records(spark, [1, 2])
    with pytest.raises(ValueError):
        split.group_split(df, group="grp", key="id", train=0.5, val=0.1, test=0.1)


@pytest.mark.parametrize("test_ratio", [0.0, 0.2])
def test_cluster_kfold(spark, test_ratio):
    df, data = records(spark, SIZES)
    n, k = sum(SIZES), 4
    rows = split.cluster_kfold(df, cluster="grp", key="id", n_folds=k, test_ratio=test_ratio, n_repeats=2, seed=5).collect()
    cluster_of = dict(data)
    for repeat in range(2):
        order = shuffled(group_table(data), 5 + repeat)
        test_size = int(test_ratio * n)
        fold_size = floor((n - test_size) / k)
        part, size = {}, 0
        for s, _, g in order:
            if size >= test_size:
                break
            if s <= 5:
                part[g], size = -1, size + s
        for fold in range(k):
            filled = 0
            for s, _, g in order:
                if g not in part and filled + s <= fold_size:
                    part[g], filled = fold, filled + s
        for _, _, g in order:
            part.setdefault(g, k - 1)
        want = {
            (f, i): "test" if part[g] == -1 else "val" if part[g] == f else "train" for i, g in cluster_of.items() for f in range(k)
        }
        assert {(r["fold"], r["id"]): r["role"] for r in rows if r["repeat"] == repeat} == want
    with pytest.raises(ValueError):
        split.cluster_kfold(df, cluster="grp", key="id", n_repeats=2, shuffle=False)


def test_contiguous_kfold(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    rows = sorted((r["k"], r["fold"]) for r in split.contiguous_kfold(df, key="k", n_folds=4).collect())
    assert [f for _, f in rows] == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 8


def dice(a, b):
    return 1 - 2 * len(set(a) & set(b)) / (len(a) + len(b))


def walk(ids, sets, seed, levels):
    """Level by level, each record in order that is far enough from all picked before; then the others."""
    order = sorted(ids, key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())
    picked = []
    for level in levels:
        for i in order:
            if i not in picked and all(round(dice(sets[i], sets[j]), 12) >= level for j in picked):
                picked.append(i)
    return picked + [i for i in order if i not in picked]


@pytest.mark.parametrize("strategy", ["index", "dense"])
def test_maxmin_split_is_the_sequential_one(spark, strategy):
    rng = random.Random(9)
    sets = [sorted(rng.sample(range(25), rng.randint(2, 9))) for _ in range(120)]
    sets += sets[:10] + [None, None]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<int>")
    levels = [0.7, 0.5, 0.25]
    results = []
    for rows in (df, df.repartition(5)):
        found = split.maxmin_split(rows, key="id", tokens="tokens", seed=4, levels=["0.7", "0.5", "0.25"], strategy=strategy).collect()
        results.append(sorted(tuple(r) for r in found))
    assert results[0] == results[1]
    ids = list(range(130))
    train = walk(ids, sets, 4, levels)[:91]
    left = walk([i for i in ids if i not in train], sets, 4, levels)
    want = [(i, "train", n) for n, i in enumerate(train)] + [(i, "val", n) for n, i in enumerate(left[:20])]
    want += [(i, "test", -1) for i in [*left[20:], 130, 131]]
    assert results[0] == sorted(want)


def test_maxmin_split_of_many_records(spark):
    rng = random.Random(3)
    sets = [sorted(rng.sample(range(400), 6)) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<int>")
    rows = split.maxmin_split(df, key="id", tokens="tokens", train=0.2, val=0.0, seed=2, levels=["0.5", "0.2"]).collect()
    near = {}
    for i, s in enumerate(sets):
        for t in s:
            near.setdefault(t, []).append(i)
    order = sorted(range(3000), key=lambda i: hashlib.md5(f"2|{i}".encode()).hexdigest())
    picked = []
    for level in (0.5, 0.2):
        taken = set(picked)
        for i in order:
            around = {j for t in sets[i] for j in near[t] if j in taken}
            if i not in taken and all(round(dice(sets[i], sets[j]), 12) >= level for j in around):
                picked.append(i)
                taken.add(i)
    assert [r["id"] for r in sorted((r for r in rows if r["role"] == "train"), key=lambda r: r["pick"])] == picked[:600]
    assert len(rows) == 3000 and {r["role"] for r in rows} == {"train", "test"}


def test_no_compound_straddles(spark):
    df = spark.createDataFrame([(i, f"c{i % 37}" if i % 10 else None) for i in range(200)], "id long, compound string")
    roles = split.key_disjoint_split(df, compound="compound", key="id")
    assert roles.count() == 200
    audit = split.split_audit(roles, compound="compound").collect()
    assert {r["role"] for r in audit} == {"train", "val", "test"}
    assert all(r["n_straddling"] == 0 for r in audit) and sum(r["n_rows"] for r in audit) == 200


def test_metrics_on_one_sided_predictions(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "t int, p int")
    row = evaluate.binary_metrics(df, truth="t", predicted="p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["mcc"]) == (0.667, 0, 0, 0, 0)
    assert (row["balanced_accuracy"], row["specificity"]) == (0.5, 1)
    assert evaluate.binary_metrics(df, truth="t", predicted="p", metrics=["f1", "nope"]).columns == ["f1"]


def test_search_space():
    space = {"a": [True, False], "b": ["x", "y"], "c": [1, 3], "d": [0.0, 1.0], "e": "False", "f": 7, "g": 0.5}
    trials = model.draw_params(space, 30, seed=1)
    assert {t["a"] for t in trials} == {True, False} and {t["c"] for t in trials} == {1, 2, 3}
    assert all(0 <= t["d"] <= 1 and t["e"] is False and t["f"] == 7 and t["g"] == 0.5 for t in trials)
    assert model.draw_params(space, 30, seed=1) == trials
    with pytest.raises(ValueError):
        model.draw_params({"a": None}, 1, seed=1)


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    arrived, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    schema = "id long, x double"

    def score(df):
        return model.flag_probability(df, F.col("x") / 10)

    for ids in ([1, 2], [8, 9]):
        batch = spark.createDataFrame([(i, float(i)) for i in ids], schema)
        tables.table_sink(batch, arrived, format="csv", mode="append")
        score_stream(tables.csv_stream_source(spark, arrived, schema), score, path=out, checkpoint=ck)
    rows = sorted((r["id"], r["flag"]) for r in spark.read.parquet(out).collect())
    assert rows == [(1, False), (2, False), (8, True), (9, True)]
