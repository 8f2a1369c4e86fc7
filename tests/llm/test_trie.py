"""The trie against one that is grown turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from assayframe.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, every=20, most=4):
    """All nodes, from nested dictionaries."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        return (*t[:3], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest())

    own = {c: [t[2:] for t in sorted(turns, key=key)] for c, turns in own.items()}
    members, ends = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        base = c - (c % every if c >= 0 else -(-c % every))
        turns = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def words(node):
        return len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = (len(members[node]) - 1) * words(node) + sum(saved[k] for k in kids)
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "'x' as node", "2 as conv")
    got = trie.prefix_trie(df, **options)
    assert got.columns == COLUMNS
    found = sorted(map(tuple, got.collect()))
    assert found == plain(rows)


def made(seed, n, kinds):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(0, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant"][:kinds]), " ".join(rng.choice("abc"[:kinds]) for _ in range(rng.randint(0, 2)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [trie.WIDTH, 128])
def test_like_a_grown_trie(spark, width):
    # a sketch of 128 counters proves next to nothing: all prefixes are grouped
    check(spark, made(1, 120, 2), width=width)


def test_wide_trie(spark):
    check(spark, made(2, 150, 3), depth=2, width=600)


def test_edge_cases(spark):
    rows = [(0, 0, "user", "hello there"), (0, 1, None, None), (0, None, "user", "before all"), (0, None, "user", None)]
    rows += [(c, 0, "user", "hi") for c in range(1, 60)] + [(c, 0, "user", "hi") for c in range(1, 9)]
    rows += [(None, 0, "user", "nobody"), (-7, 0, "a", "b"), (-7, 1, "a", "b"), (-20, 5, "x", "y z"), (-25, 1, "x", "q")]
    rows += [(1000, i, "u", f"word{i % 3} " * (i % 5)) for i in range(3000)] + [(1001, i, "u", f"word{i % 3} " * (i % 5)) for i in range(2500)]
    rows += [(2000, 0, "user", "tab\tand\u00a0space \x0b\x1f"), (2000, 1, "us", "er"), (2001, 0, "user", "x"), (2001, 1, "use", "rer")]
    check(spark, rows)


def test_one_conversation_and_none(spark):
    check(spark, [(5, 0, "user", "alone")])
    check(spark, [(5, None, None, None)])
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(700) for t in range(5)] + [(c, t, "user", f"turn {t} of {c}") for c in range(700, 1000) for t in range(3)]
    check(spark, rows)


def test_sketch_never_estimates_too_low(spark):
    df = spark.createDataFrame(made(3, 200, 2), SCHEMA)
    rows = trie.prefixes(trie.digest_turns(df, "conv_id", "turn", "role", "text"), 20, 4)
    met = rows.toPandas()
    times = met.node.map(met.node.value_counts())
    flagged = trie.screened(rows, trie.sketch(rows)).toPandas().set_index(["conv", "depth"])
    true = met.assign(n=times).set_index(["conv", "depth"])
    both = flagged.join(true[["n"]])
    assert not (both.alone & (both.n > 1)).any()
    assert both.alone[both.n == 1].mean() > 0.99
