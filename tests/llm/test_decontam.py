"""Suffix automaton against windows compared one by one."""

import random

import pytest

from assayframe.llm import decontam
from assayframe.llm.text import words_of


def plain(text, items, window):
    """Hit word places and hit items by comparing all windows."""
    w = words_of((text or "").encode())
    hit, names = set(), set()
    for name, item in items:
        v = words_of((item or "").encode())
        n = min(len(v), window)
        for i in range(max(len(v) - window, 0) + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    names.add(str(name))
    return len(w), sorted(hit), sorted(names)


@pytest.mark.parametrize("seed", range(40))
def test_like_plain_windows(seed):
    import pyarrow as pa

    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdefgh"
    window = rng.choice([2, 3, 4])
    items = [(k, " ".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 5, 9])))) for k in range(rng.choice([0, 1, 4, 8]))]
    texts = [None, "", "..", *(" ".join(rng.choice(letters + "xyz") for _ in range(rng.choice([1, 2, 5, 30]))) for _ in range(30))]
    automaton = decontam.ItemAutomaton([(n, t.encode()) for n, t in items], window)
    for text, (n, spans, hit) in zip(texts, decontam.scan_column(automaton, pa.array(texts)), strict=True):
        got = sorted({i for lo, hi in spans for i in range(lo, hi)})
        assert (n, got, sorted(str(automaton.names[k]) for k in hit)) == plain(text, items, window)


def test_table(spark):
    long = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([(1, long), (2, "Just  THREE words"), (10, None), (3, "?!"), (2, "Just  THREE words")], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(2000))
    rows = [
        (1, None), (2, ""), (3, "..."), (4, "so JUST three; Words here"), (5, f"{filler} w3 {' '.join(f'w{i}' for i in range(5, 18))}"),
        (6, " ".join(f"w{i}" for i in range(12))), (6, f"x {long.upper()} y"), (7, filler * 20),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as item_id", "1 as window")
    for shard_words in (1, 500_000):
        got = {(r["doc_id"], r["n_words"], tuple(tuple(s) for s in r["hit_spans"]), tuple(r["hit_items"]), r["bad"]) for r in
               decontam.contaminated_spans(docs, bench, shard_words=shard_words).withColumn("bad", decontam.over_limit()).collect()}
        assert got == {
            (1, 0, (), (), False), (2, 0, (), (), False), (3, 0, (), (), False), (4, 5, ((1, 4),), ("2",), True),
            (5, 2014, ((2001, 2014),), ("1",), False), (6, 12, (), (), False), (6, 42, ((1, 41),), ("1",), True), (7, 39981, (), (), False),
        }
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5, 6, 7]
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, bench, cut=True).filter("doc_id in (1, 4)").collect()}
    assert cut == {1: None, 4: "so  here"}
    assert decontam.contaminated_spans(docs, bench.limit(0)).filter("size(hit_items) > 0").count() == 0
    assert decontam.contaminated_spans(docs.limit(0), bench).count() == 0
    clash = docs.withColumn("n_words", docs["doc_id"])
    assert decontam.contaminated_spans(clash, bench).columns == [*docs.columns, "n_words", "hit_spans", "hit_items"]
    assert decontam.decontaminate(clash, bench).columns == clash.columns
    assert decontam.contaminated_spans(docs, bench, keep=["doc_id"]).columns == ["doc_id", "n_words", "hit_spans", "hit_items"]


def test_items_without_id_or_with_the_same(spark):
    bench = spark.createDataFrame([(None, "one two three"), (7, "four five"), (7, "six seven")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three x four five six seven"), (2, "a one two three")], "doc_id long, text string")
    got = {r["doc_id"]: (r["hit_items"], [tuple(s) for s in r["hit_spans"]]) for r in decontam.contaminated_spans(docs, bench).collect()}
    assert got == {1: (["7"], [(0, 3), (4, 8)]), 2: ([], [(1, 4)])}


def test_driver_builds_no_automaton(spark, monkeypatch):
    items = [(i, " ".join(f"v{i}x{j}" for j in range(20))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(5)
    docs = spark.createDataFrame([(i, f"a {t} b") for i, t in items], "doc_id long, text string")
    shards = decontam.automata(bench, "item_id", "text", shard_words=1000).count()
    assert 1 < shards < 10

    def refuse(*_):
        raise AssertionError("an automaton on the driver")

    monkeypatch.setattr(decontam.ItemAutomaton, "__init__", refuse)
    got = decontam.contaminated_spans(docs, bench, shard_words=1000).collect()
    assert sorted((r["doc_id"], r["hit_items"], [tuple(s) for s in r["hit_spans"]]) for r in got) == [(i, [str(i)], [(1, 21)]) for i, _ in items]
