"""Pairs, clusters and distances against brute force, with copies and crowded tokens."""

import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.functions import fingerprint as fp
from assayframe.functions import structure as st
from assayframe.operators import cluster, domain, similarity


def random_sets(n, seed, vocabulary=60, hot=0.4):
    """Token sets with near copies, a group of copies and one token in many sets."""
    rng = random.Random(seed)
    sets = []
    for i in range(n):
        if sets and rng.random() < 0.3:
            base = set(rng.choice(sets))
            if base and rng.random() < 0.7:
                base.discard(rng.choice(sorted(base)))
                base.add(rng.randrange(vocabulary))
        else:
            base = set(rng.sample(range(vocabulary), rng.randint(1, 8)))
        if rng.random() < hot:
            base.add(0)
        sets.append(sorted(base))
    for i in range(n // 3):
        sets[i * 3] = [0, 5, 9]
    return sets


def frame(spark, sets):
    return spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "id long, tokens array<int>")


def tanimoto(a, b):
    a, b = set(a), set(b)
    return Fraction(len(a & b), len(a | b)) if a | b else Fraction(1)


@pytest.mark.parametrize("strategy,options", [("index", {}), ("index", {"posting_rows": 4}), ("dense", {"rows_per_block": 20}), ("packed", {"n_bits": 130})])
@pytest.mark.parametrize("cutoff", [(1, 3), (3, 5)])
def test_similarity_pairs(spark, strategy, options, cutoff, monkeypatch):
    monkeypatch.setattr("assayframe.operators.packed.LEAST_ROWS", 7)
    sets = [*random_sets(90, 11, vocabulary=130 if strategy == "packed" else 60), [], list(range(50)), list(range(60)), [0, 63, 64, 127, 128, 129]]
    reps = similarity.collapse_copies(frame(spark, sets), key="id", tokens="tokens")
    got = {
        (r["a"], r["b"]): (r["n_a"], r["n_b"], Fraction(r["common"], r["total"]))
        for r in similarity.similarity_pairs(reps, cutoff=cutoff, strategy=strategy, **options).collect()
    }
    first, copies = {}, {}
    for i, s in enumerate(sets):
        first.setdefault(tuple(s), i)
        copies[tuple(s)] = copies.get(tuple(s), 0) + 1
    want = {}
    for (s, i), (t, j) in itertools.combinations(sorted(first.items(), key=lambda e: e[1]), 2):
        value = tanimoto(s, t)
        if value >= Fraction(*cutoff):
            want[i, j] = (copies[s], copies[t], value)
    assert got == want


def test_packed_blocks_are_bounded_and_near():
    from assayframe.operators.packed import block_table

    sizes = [(n, 7 + n % 5) for n in range(1, 40)] + [(50, 95), (64, 1)]
    for cutoff in (Fraction(1, 3), Fraction(4, 5), Fraction(1)):
        table = block_table(sizes, cutoff, 20)
        rows = dict(sizes)
        held = {}
        for size, first, parts, low, high in table:
            for b in range(first, first + parts):
                held.setdefault(b, set()).add(size)
                if parts == 1:
                    assert sum(rows[s] for s in held[b]) <= 20
            assert parts * 20 >= rows[size]
        met = {(b, o) for size, first, parts, low, high in table for b in range(first, first + parts) for o in range(low, high + 1)}
        assert {(o, b) for b, o in met} == met
        for b, o in itertools.product(held, held):
            near = any(min(x, y) >= cutoff * max(x, y) for x in held[b] for y in held[o])
            assert not near or (b, o) in met
        if cutoff == 1:
            assert len(met) < len(held) ** 2 / 4


def test_packed_runs_in_the_jvm(spark):
    reps = similarity.collapse_copies(frame(spark, [[1, 2, 3], [2, 3, 4], [1, 2, 3, 4]]), key="id", tokens="tokens")
    plan = similarity.similarity_pairs(reps, cutoff=(1, 2), strategy="packed", n_bits=64)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        similarity.similarity_pairs(reps, cutoff=(1, 2), strategy="packed")
    with pytest.raises(Exception, match="no bit"):
        similarity.similarity_pairs(reps, cutoff=(1, 2), strategy="packed", n_bits=3).collect()


def sequential_clusters(sets, cutoff):
    near = {
        i: {j for j in range(len(sets)) if j != i and tanimoto(sets[i], sets[j]) >= cutoff} for i in range(len(sets))
    }
    order = sorted(near, key=lambda i: (-len(near[i]), i))
    leader, free = {}, set(near)
    for i in order:
        if i in free:
            for j in {i} | (near[i] & free):
                leader[j] = i
            free -= near[i] | {i}
    return leader


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_task", [200_000, 5])
def test_leader_clusters_are_the_sequential_ones(spark, monkeypatch, seed, rows_per_task):
    monkeypatch.setattr("assayframe.operators.skew.ROWS_PER_TASK", rows_per_task)
    monkeypatch.setattr("assayframe.operators.cluster.ROWS_PER_TASK", rows_per_task)
    sets = random_sets(80, seed)
    want = sequential_clusters(sets, Fraction(2, 5))
    rows = cluster.leader_clusters(frame(spark, sets), key="id", tokens="tokens", cutoff=(2, 5)).collect()
    assert {r["id"]: r["cluster"] for r in rows} == want
    sizes = {c: list(want.values()).count(c) for c in want.values()}
    assert all(r["cluster_size"] == sizes[r["cluster"]] for r in rows)
    for r in rows:
        assert tanimoto(sets[r["id"]], sets[r["cluster"]]) >= Fraction(2, 5)
    for i, j in itertools.combinations(sizes, 2):
        assert tanimoto(sets[i], sets[j]) < Fraction(2, 5)


def test_cutoff_sweep(spark):
    sets = random_sets(70, 4)
    cutoffs = {"low": (1, 3), "high": (4, 5)}
    got = {r["cutoff"]: r for r in cluster.cutoff_sweep(frame(spark, sets), key="id", tokens="tokens", cutoffs=cutoffs).collect()}
    for name, c in cutoffs.items():
        leaders = list(sequential_clusters(sets, Fraction(*c)).values())
        sizes = [leaders.count(x) for x in set(leaders)]
        assert (got[name]["n_clusters"], got[name]["largest"], got[name]["n_singletons"]) == (
            len(sizes),
            max(sizes),
            sizes.count(1),
        )


def test_clusters_without_any_pair(spark):
    rows = cluster.leader_clusters(frame(spark, [[1], [2], [3]]), key="id", tokens="tokens", cutoff=(1, 2)).collect()
    assert sorted((r["id"], r["cluster"], r["cluster_size"]) for r in rows) == [(0, 0, 1), (1, 1, 1), (2, 2, 1)]


def test_pair_distances_with_copies(spark):
    sets = random_sets(50, 8)
    got = similarity.pair_distances(frame(spark, sets), key="id", tokens="tokens", rows_per_block=12).collect()
    assert len(got) == 50
    for r in got:
        distances = [float(1 - tanimoto(sets[r["id"]], s)) for j, s in enumerate(sets) if j != r["id"]]
        assert r["n_others"] == 49
        assert math.isclose(r["sum_distance"], sum(distances), abs_tol=1e-9)
        assert math.isclose(r["nearest"], min(distances), abs_tol=1e-12)
        assert math.isclose(r["farthest"], max(distances), abs_tol=1e-12)


@pytest.mark.parametrize("metric,normalize", [("euclidean", False), ("euclidean", True), ("manhattan", False), ("manhattan", True), ("cosine", False)])
def test_average_dissimilarity(spark, metric, normalize):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(40, 5)), 1)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>")
    total, pairs = 0.0, 0
    for a, b in itertools.combinations(x, 2):
        if metric == "euclidean":
            d = np.linalg.norm(a - b) / (np.linalg.norm(a) * np.linalg.norm(b) if normalize else 1)
        elif metric == "manhattan":
            d = np.abs(a - b).sum() / (np.abs(a).sum() + np.abs(b).sum() if normalize else 1)
        else:
            d = 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-9)
        total, pairs = total + d, pairs + 1
    row = similarity.average_dissimilarity(df, key="id", vector="v", metric=metric, normalize=normalize, rows_per_block=9).first()
    assert row["n"] == 40 and math.isclose(row["average"], total / pairs, rel_tol=1e-6)


def test_average_of_one_row_is_null(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    for metric in ("euclidean", "manhattan", "cosine"):
        assert similarity.average_dissimilarity(df, key="id", vector="v", metric=metric).first()["average"] is None
    with pytest.raises(ValueError):
        similarity.average_dissimilarity(df, key="id", vector="v", metric="nope")


@pytest.mark.parametrize("k,strategy,rows", [(1, "dense", 11), (3, "dense", 11), (3, "index", 11), (7, "index", 2000), (2, "index", 3), (4, "cells", 6), (30, "cells", 6)])
def test_knn_with_copies(spark, k, strategy, rows):
    sets = [*random_sets(60, 21), [], [99999], [], [0, 77777]]
    df = frame(spark, sets)
    train = df.filter("id < 40 OR id = 60")
    got = domain.knn_distances(df, train, key="id", features="tokens", k=k, strategy=strategy, rows_per_block=rows).collect()
    assert len(got) == 64
    for r in got:
        want = sorted(float(1 - tanimoto(sets[r["id"]], s)) for s in [*sets[:40], sets[60]])[:k]
        assert np.allclose(r["distances"], want) and math.isclose(r["mean_distance"], sum(want) / k, abs_tol=1e-12)
    with pytest.raises(ValueError):
        domain.knn_distances(df, train.limit(2), key="id", features="tokens", k=5)


def sequential_threshold(train, test, step=0.05, percentile=75, largest=None):
    largest = round(max(train), 3) if largest is None else largest
    threshold = round(float(np.percentile(train, percentile)), 3)
    while threshold < largest:
        if sum(t <= threshold for t in test) / len(test) < 0.9:
            threshold += step
        else:
            break
    return threshold


@pytest.mark.parametrize("shift", [0.0, 0.12, 0.6])
def test_domain_threshold_is_the_sequential_one(spark, shift):
    rng = random.Random(2)
    train = [rng.uniform(0.1, 0.8) for _ in range(60)]
    test = [min(0.99, rng.uniform(0.1, 0.5) + shift) for _ in range(40)]
    frames = [spark.createDataFrame([(v,) for v in values], "mean_distance double") for values in (train, test)]
    got = domain.domain_threshold(*frames).first()
    assert math.isclose(got["threshold"], sequential_threshold(train, test), abs_tol=1e-9)
    assert got["n_train"] == 60


def test_similarity_functions(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([1], [])], "a array<int>, b array<int>")
    got = df.select(fp.tanimoto(F.col("a"), F.col("b")), fp.dice_distance(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(0.5, pytest.approx(1 / 3)), (1.0, 0.0), (0.0, 1.0)]
    packed = df.select(fp.tanimoto_packed(fp.packed_words(F.col("a"), 64), fp.packed_words(F.col("b"), 64)).alias("t"))
    assert [r["t"] for r in packed.collect()] == [0.5, 1.0, 0.0]


def test_structure_functions(spark):
    df = spark.createDataFrame([("CCO.CC(=O)O",), ("C.C",), ("[H].Br",), (None,)], "s string")
    got = df.select(st.largest_fragment(F.col("s")), st.halogen_count(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("CC(=O)O", 0), ("C", 0), ("Br", 1), (None, None)]


def test_shingles_of_short_and_missing_text(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(fp.shingles(F.col("s"), size=2)).collect()] == [["a b", "b c"], ["a"], [], None]
    assert [r[0] for r in df.select(fp.shingles(F.col("s"), kind="char", size=4)).collect()] == [["a b ", " b c"], ["a"], [], None]
    with pytest.raises(ValueError):
        fp.shingles(F.col("s"), kind="nope")


@pytest.mark.parametrize("dense_from", [0, 6, 10**9])
def test_shared_tokens(monkeypatch, dense_from):
    from assayframe.operators import blocks

    monkeypatch.setattr(blocks, "DENSE_FROM", dense_from)
    monkeypatch.setattr(blocks, "TOKEN_CHUNK", 3)
    monkeypatch.setattr(blocks, "PAIR_CHUNK", 5)
    a = [np.array(s, dtype=np.int32) for s in random_sets(25, 1, 30) + [[]]]
    b = [np.array(s, dtype=np.int32) for s in random_sets(31, 2, 40)]
    got = blocks.shared_tokens(a, b)
    assert got.tolist() == [[len(set(x) & set(y)) for y in b] for x in a]


@pytest.mark.parametrize("start", [0.6, 0.35, 0.1, 0.215, 0.333])
def test_threshold_at_the_edge_of_a_step(spark, start):
    step = 0.05
    for edge in (1, 2, 3):
        reached = start + edge * step
        train = [start] * 9 + [0.95]
        test = [reached] * 9 + [0.99]
        frames = [spark.createDataFrame([(v,) for v in values], "mean_distance double") for values in (train, test)]
        got = domain.domain_threshold(*frames).first()["threshold"]
        # the first step that reaches, judged by the comparison itself
        i = next(i for i in range(100) if start + i * step >= reached)
        assert got == start + i * step
        inside = domain.within_domain(frames[1], domain.domain_threshold(*frames))
        assert inside.filter("within").count() == 9


def test_rows_without_features_stay(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, None), (3, [1, 2, 4]), (4, [7])], "id int, tokens array<int>")
    known = df.filter("tokens IS NOT NULL")
    for strategy in ("dense", "index"):
        rows = {r["id"]: r["mean_distance"] for r in domain.knn_distances(df, known, key="id", features="tokens", k=1, strategy=strategy).collect()}
        assert rows == {1: 0.0, 2: None, 3: 0.0, 4: 0.0}
    rows = {r["id"]: r["cluster"] for r in cluster.leader_clusters(df, key="id", tokens="tokens", cutoff=(1, 2)).collect()}
    assert rows == {1: 1, 2: None, 3: 1, 4: 4}


def test_one_row_for_each_fingerprint(spark):
    """Repeated rows, one key with two fingerprints, and fingerprints whose records have no key."""
    rows = [(1, [1, 2]), (1, [1, 2]), (1, [3, 4, 5]), (2, [1, 2]), (None, [1, 2]), (None, [7]), (None, [7]), (3, [8, 9]), (3, None)]
    df = spark.createDataFrame(rows, "id long, tokens array<int>")
    got = [(r["rep"], tuple(r["tokens"]), r["copies"]) for r in similarity.collapse_copies(df, key="id", tokens="tokens").collect()]
    assert sorted(got, key=str) == sorted([(1, (1, 2), 4), (1, (3, 4, 5), 1), (None, (7,), 2), (3, (8, 9), 1)], key=str)


@pytest.mark.parametrize("strategy", ["index", "dense"])
def test_repeated_rows_give_each_pair_once(spark, strategy):
    rows = [(1, [1, 2, 3]), (1, [1, 2, 3]), (2, [1, 2, 3, 4]), (2, [1, 2, 3, 4]), (5, [6])]
    reps = similarity.collapse_copies(spark.createDataFrame(rows, "id long, tokens array<int>"), key="id", tokens="tokens")
    got = [tuple(r) for r in similarity.similarity_pairs(reps, cutoff=(3, 5), strategy=strategy).select("a", "b", "n_a", "n_b", "common", "total").collect()]
    assert got == [(1, 2, 2, 2, 3, 4)]


def test_members_are_given_once(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (4, [3, 4, 5]), (2, [1, 2]), (None, [7]), (None, [7]), (None, [8]), ((1 << 53) + 1, [1, 2, 6])]
    df = spark.createDataFrame(rows, "id long, tokens array<int>")
    got = cluster.leader_clusters(df, key="id", tokens="tokens", cutoff=(3, 5)).collect()
    assert sorted(r["id"] or 0 for r in got) == sorted(i or 0 for i, _ in rows)
    assert sorted(r["cluster_size"] for r in got if r["id"] is None) == [1, 2, 2]
    twice = rows + [(4, [5, 6])]
    far = similarity.pair_distances(spark.createDataFrame(twice, df.schema), key="id", tokens="tokens").collect()
    assert sorted(r["id"] or 0 for r in far) == sorted(i or 0 for i, _ in twice)
    for r in far:
        assert r["n_others"] == len(twice) - 1
