"""Mixing against a plain reading of the rules."""

import itertools
import random
import re

import pytest

from assayframe.llm import mixing

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Share by weight, stop at twice the size, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while open_:
        each = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if each * weight[s] > 2 * sizes[s]}
        if not above:
            return target | {s: each * weight[s] for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


@pytest.mark.parametrize("seed", range(30))
def test_fit_is_near(seed):
    rng = random.Random(seed)
    counts = [(n, rng.randint(1, 9)) for n in sorted(rng.sample(range(1, 400), rng.randint(1, 60)))]
    total = sum(n * c for n, c in counts)
    budget = rng.randint(1, total)
    program = rng.choice([50, 1000, 1 << 15])
    took = mixing.fit(counts, budget, program=program)
    assert all(0 <= took[n] <= c for n, c in counts)
    spent = sum(n * t for n, t in took.items())
    assert 0 <= budget - spent < counts[-1][0] * 2
    if len(counts) > 20 and program > 50:
        assert spent == budget


@pytest.mark.parametrize("seed", range(20))
def test_knapsack_like_brute_force(seed):
    rng = random.Random(seed)
    spare = [(n, rng.randint(1, 3)) for n in sorted(rng.sample(range(1, 60), 4))]
    budget = rng.randint(1, 150)
    used = mixing.knapsack(spare, budget)
    assert all(used.get(n, 0) <= c for n, c in spare)
    best = max(s for k in itertools.product(*[range(c + 1) for _, c in spare]) if (s := sum(n * i for (n, _), i in zip(spare, k))) <= budget)
    assert sum(n * k for n, k in used.items()) == best


def test_table(spark):
    rng = random.Random(7)
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40]))), rng.choice(["b", "b", "b", "b", "a", "é", "Z", None])) for i in range(600)]
    rows += [(1000 + i, "same text here", "b") for i in range(300)]
    rows += [(2000, None, "b"), (2001, "", "a"), (2002, "\x1c \t\n", None), (2003, "long " * 3000, "Z"), (2003, "long " * 3000, "Z"), (2004, None, "empty source")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' as target", "1 as s")
    first = mixing.mix(docs).collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(SPACE.findall(t or ""))
    wanted, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    assert len(first) == len(rows) and set(docs.columns) - {"target"} < set(first[0].asDict())
    for r in first:
        assert r["size"] == len(SPACE.findall(r["text"] or ""))
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 0.5 + 1e-6 or s == "Z" and abs(taken[s] - wanted[s]) < 1500
    back = mixing.repeated(docs)
    assert back.columns == docs.columns
    words = back.selectExpr("sum(size(regexp_extract_all(text, '[^ \\\\x09-\\\\x0D]+', 0))) as n").first()["n"]
    assert words == sum(taken.values())
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.repeated(docs.limit(0)).count() == 0
    nothing = docs.filter("doc_id in (2000, 2001)")
    assert [r["taken"] for r in mixing.mix(nothing).collect()] == [0, 0] and mixing.repeated(nothing).count() == 2


def test_many_equal_rows(spark):
    rows = [(7, "the same row", "a")] * 400 + [(i, "one two", "b") for i in range(300)] + [(None, "no id", "a")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(docs).collect()
    sizes = {"a": 400 * 3 + 50 * 2, "b": 600}
    wanted = plain_targets(sizes)
    for s in sizes:
        assert abs(sum(r["taken"] for r in found if r["source"] == s) - wanted[s]) < 3
    assert all(r["taken"] in (r["size"], 2 * r["size"], 0) for r in found)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 5), "ab"[i % 2]) for i in range(200)], "doc_id long, text string, source string")
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and "Cartesian" not in plan
