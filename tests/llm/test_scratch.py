"""Scratch tables that go when their readers are done."""

import os
import re

import pytest

from assayframe.llm import neardup
from assayframe.llm.scratch import consumed, stored


def folder(table):
    return re.sub(r"^file:/*", "/", os.path.dirname(table.inputFiles()[0]))


def test_tables_go_but_for_those_kept(spark):
    with consumed() as outer:
        with consumed() as inner:
            a, b = stored(spark.range(5), "a"), stored(spark.range(7), "b")
            paths = folder(a), folder(b)
            inner.keep(b)
        assert [os.path.exists(p) for p in paths] == [False, True] and b.count() == 7
        c = stored(b, "c")
        outer.keep(c)
    assert not os.path.exists(paths[1]) and c.count() == 7
    with pytest.raises(RuntimeError), consumed():
        d = stored(spark.range(2), "d")
        lost = folder(d)
        raise RuntimeError
    assert not os.path.exists(lost)
    # outside of any block a table stays
    assert os.path.exists(folder(stored(spark.range(2), "e")))


def test_near_duplicates_leave_one_table(spark, monkeypatch):
    made = []
    monkeypatch.setattr(neardup, "stored", lambda df, name: made.append((name, t := stored(df, name))) or t)
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    docs = spark.createDataFrame([(1, words), (2, words), (3, words + " more"), (4, "something else"), (5, None)], "doc_id long, text string")
    left = neardup.drop_near_duplicates(docs)
    paths = [(name, re.sub(r"^file:/*", "/", t._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths().head().toString())) for name, t in made]
    assert [name for name, p in paths if os.path.exists(p)] == ["kept"]
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4, 5]
