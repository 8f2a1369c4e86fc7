"""Progressive refinement against plain grouping of whole texts."""

import hashlib

import pytest

from assayframe.llm import exactdedup

LONG = "long text " * 400


def plain(rows):
    """(id, keep_id, group_size) of each row, and how many rows of each (id, text) stay."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, top[t or ""], len(groups[t or ""])) for i, t in rows), key=repr), top


ROWS = [
    (1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, None), (7, LONG + "x"), (8, LONG + "y"), (9, LONG + "x"),
    (10, "prefix differs"), (11, "prefiy differs"), (12, "a "), (13, "A"), (14, "\u00e9"), (15, "e\u0301"), (16, "\u00e9"),
    (20, "twice"), (20, "twice"), (21, "same id"), (21, "other text"), (None, "no id"), (None, "no id"), (None, "a"), (30, "\x00"), (31, "\x00"),
]


@pytest.mark.parametrize("prefix, bits", [(256, 26), (1, 26), (4, 15)])
def test_like_plain_grouping(spark, prefix, bits):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as keep_id", "2 as __row", "3 as digest")
    got = exactdedup.exact_duplicates(docs, prefix=prefix, bits=bits, every_digest=True)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "digest"]
    rows = got.collect()
    want, top = plain(ROWS)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in rows), key=repr) == want
    assert sorted(r.digest for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in ROWS)
    kept = [r for r in rows if r.kept]
    assert len({r.digest for r in kept}) == len(kept) == len(top)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_only_open_texts_are_hashed(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = {(r.doc_id, r.group_size): r.digest for r in exactdedup.exact_duplicates(docs).collect()}
    assert rows[10, 1] is None and rows[11, 1] is None  # told apart by the prefix hash
    assert rows[15, 1] is None  # the only text of its length
    assert rows[8, 1] == hashlib.sha256((LONG + "y").encode()).hexdigest()  # only the full hash tells
    assert all(d is not None for (_, n), d in rows.items() if n > 1)


def test_whole_rows_stay(spark):
    docs = spark.createDataFrame([(1, "t", 5, "u"), (2, "t", 6, "v"), (3, "w", 7, None)], "id long, body string, digest int, kept string")
    got = exactdedup.drop_exact_duplicates(docs, id_col="id", text="body")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(2, "t", 6, "v"), (3, "w", 7, None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exactdedup.exact_duplicates(docs).count() == 0
    assert exactdedup.drop_exact_duplicates(docs).count() == 0


def test_ids_of_text(spark):
    docs = spark.createDataFrame([("b", "t"), ("a", "t"), (None, "t")], "doc_id string, text string")
    assert {(r.keep_id, r.group_size) for r in exactdedup.exact_duplicates(docs).collect()} == {("b", 3)}


def test_plan_is_native(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = exactdedup.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "Cartesian" not in plan


def test_one_group_holds_most_rows(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then concat('t', id) else 'copy' end as text")
    rows = exactdedup.exact_duplicates(docs).collect()
    assert len(rows) == 3000
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id % 3} == {(2999, 2000)}
    assert sum(r.kept for r in rows) == 1001
