"""BagMinHash signatures, overlap and classes against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from assayframe.llm import components, neardup
from assayframe.llm.text import shingles, slices, words, words_of


def bag(text, size=5):
    w = words_of((text or "").encode())
    return Counter(tuple(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)) if w else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    return both, sum(a.values()) + sum(b.values()) - both


def plain_classes(rows):
    """Classes by comparing every pair."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = jaccard(bags[i], bags[j])
            if rows[i][0] == rows[j][0] or either and 5 * both >= 4 * either:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), k), k)
    return {(k, least[root(i)]) for i, (k, _) in enumerate(rows)}


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(1)
    size = 4000
    a = {k: rng.choice([1, 1, 2, 3, 7, 20]) for k in range(60)}
    b = {k: rng.choice([1, 1, 2, 3, 7, 20]) for k in range(20, 90)}
    rows, keys, weights = [], [], []
    for n, bag_ in enumerate((a, b)):
        for k, w in bag_.items():
            rows.append(n)
            keys.append(k)
            weights.append(w)
    got = neardup.signatures(np.array(rows), np.array(keys, np.uint64), np.array(weights), 2, size)
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in range(90)) / sum(max(a.get(k, 0), b.get(k, 0)) for k in range(90))
    assert abs((got[0] == got[1]).mean() - want) < 4 * (want * (1 - want) / size) ** 0.5
    # a row's signature depends on its own bag only
    alone = neardup.signatures(np.zeros(len(b), int), np.array(list(b), np.uint64), np.array(list(b.values())), 1, size)
    assert (alone[0] == got[1]).all()


@pytest.mark.parametrize("seed", range(10))
def test_overlap(seed):
    rng = random.Random(seed)
    texts = [[" ".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 3, 5, 9, 40]))) for _ in range(25)] for _ in range(2)]
    a, b = (next(slices(pa.array(t))) for t in texts)
    shared, n_a, n_b = neardup.overlap(a, b, 5)
    for x, y, s, n, m in zip(*texts, shared, n_a, n_b, strict=True):
        assert (s, n + m - s) == jaccard(bag(x), bag(y))


def test_shingles_of_rows_are_apart():
    texts = ["", "a", "a b c d e", "A-b c d E f", "f", "", "b c d e f"]
    part = next(slices(pa.array(texts)))
    hashes, offsets = shingles(words(part), 5)
    assert list(np.diff(offsets)) == [0, 1, 1, 2, 1, 0, 1]
    assert hashes[1] == hashes[2] and hashes[3] == hashes[5] and len(set(hashes)) == 4


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    df = spark.createDataFrame(random.Random(0).sample(edges, len(edges)), "a long, b long")
    got = {r["node"]: r["label"] for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components.components(df.limit(0)).count() == 0


def test_table(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(3))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 8])):
                text[rng.randrange(len(text))] = word()
            rows.append((n := n + 1, " ".join(text)))
    base = [word() for _ in range(60)]
    rows += [(500 + i, ", ".join(base).upper()) for i in range(200)]
    for i in range(60):  # a chain of near copies, each like the next
        base[i] = word()
        rows.append((800 + i, " ".join(base)))
    rows += [(900, None), (901, None), (902, ""), (903, "!?"), (904, "one"), (905, "One."), (906, "one two"), (907, "x " * 50), (908, "x " * 52), (909, "x " * 300)]
    rows += [(rows[0][0], rows[0][1]), (910, "a b c d e f g h"), (910, "quite another text of a few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as class_id", "1 as node")
    got = neardup.near_duplicates(docs)
    assert got.count() == len(rows)
    assert {(r["doc_id"], r["class_id"]) for r in got.collect()} == plain_classes(rows)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in plain_classes(rows)})
    null = spark.createDataFrame([(None, "a b c"), (None, None), (4, "a b c"), (None, "alone")], "doc_id long, text string")
    assert neardup.near_duplicates(null).count() == 4 and neardup.drop_near_duplicates(null).count() == 3
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.drop_near_duplicates(docs.limit(0)).count() == 0
