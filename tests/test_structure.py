"""Fragments tied by ring bonds, and pattern tables, against plain loops."""

import random
import re

from pyspark.sql import functions as F

from assayframe.functions import structure as st
from assayframe.functions.patterns import required_literal
from assayframe.operators import features


def plain_fragments(text):
    parts = text.split(".")
    group, still = list(range(len(parts))), {}
    for at, part in enumerate(parts):
        for t in re.findall(r"%[0-9]{2}|%\([0-9]+\)|[0-9]", re.sub(r"\[[^\]]*\]", "", part)):
            ring = int(t.strip("%()"))
            if ring in still:
                a, b = group[still.pop(ring)], group[at]
                group = [min(a, b) if g == max(a, b) else g for g in group]
            else:
                still[ring] = at
    return [".".join(p for p, g in zip(parts, group) if g == head) for head in dict.fromkeys(group)]


def test_fragments_with_open_rings(spark):
    rng = random.Random(3)
    texts = ["C1.C1", "C1.O.C1", "C1CC1.C1CC1", "C1.C2.C1.C2", "C1.C2.C3.C2.C1C3", "C%12.C%(12)", "C1.[13CH4].C", "C1.C", "", ".", "c1ccccc1.[Na+]", "C%(99999999999999999999)1.C1", "[C@H]1.\nN1", "C0.C%00"]
    texts += ["".join(rng.choice(["C", "N", ".", ".", "1", "2", "%10", "3", "[13C]"]) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    rows = df.select("t", st.fragments(F.col("t")).alias("f"), st.largest_fragment(F.col("t")).alias("big")).collect()
    for t, f, big in rows:
        if t is None:
            assert f is None and big is None
        else:
            assert f == plain_fragments(t), t
            sizes = [len(re.findall(st.ATOM_TOKEN, x)) for x in f]
            assert big == f[sizes.index(max(sizes))]
    assert rows[0].f == ["C1.C1"] and rows[1].f == ["C1.C1", "O"] and rows[2].f == ["C1CC1", "C1CC1"]


def test_required_literals():
    want = {
        "abc": "abc", "ab?c": "a", "abc+d": "abc", "ab*": "a", "a{0,2}bc": "bc", "ab{2}c": "ab", "x(?:yz)+longer": "longer", "a|b": "", "(a|b)cd": "cd",
        r"C\(=O\)O": "C(=O)O", r"[^]a]bc\d+def": "def", "(?i)abc": "", r"\Qa.b\E": "", "^ab$": "ab", "a.bc": "bc", r"\x41bc": "", r"abc\x41|d": "", "": "", "[a[bc]]x": "x", r"\bword\b": "word",
    }
    assert {r: required_literal(r) for r in want} == want


def test_literals_are_in_every_match():
    rng = random.Random(5)
    for _ in range(4000):
        regex = "".join(rng.choice(["a", "b", "c", "ab", "?", "*", "+", "(bc)", "(a|b)", "[ab]", ".", "{2}", "{0,1}", "$", "^", r"\."]) for _ in range(rng.randint(1, 7)))
        try:
            compiled = re.compile(regex)
        except re.error:
            continue
        literal = required_literal(regex)
        for _ in range(20):
            text = "".join(rng.choice("abc.") for _ in range(rng.randint(0, 9)))
            assert not compiled.search(text) or literal in text, (regex, literal, text)


def test_more_patterns_than_a_plan_holds(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("CNO=()1") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    rows = [*enumerate([*texts, texts[0], None, "é€C=O(N)" * 300]), (0, texts[0])]
    names = {f"p{i}": re.escape("".join(rng.choice("CNO=()1") for _ in range(rng.randint(3, 7)))) + rng.choice(["", "C?", "[NO]", "+"]) for i in range(1300)}
    names |= {"any": "C|N", "opt": "x?C", "none": "zzzz", "empty": "", "long": r"€C=O\(N\)é"}
    table = [*names.items(), ("any", "zz"), (None, "C"), ("null", None)]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("name", F.lit("x"))
    patterns = spark.createDataFrame(table, "name string, pattern string")
    got = sorted(map(tuple, features.pattern_matches(df, patterns, key="id", structure="text", spread=3).collect()))
    want = [(i, n, len(re.findall(p, t))) for i, t in rows if t is not None for n, p in names.items()]
    assert got == sorted(w for w in want if w[2] > 0)
    assert features.pattern_matches(df.limit(0), patterns, key="id", structure="text").collect() == []
    assert features.pattern_matches(df, patterns.limit(0), key="id", structure="text").collect() == []
