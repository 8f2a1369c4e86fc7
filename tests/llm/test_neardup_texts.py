"""Texts that have no near copy are not shuffled, whatever the broadcast limit."""

import random

import pytest

from assayframe.llm import neardup


@pytest.mark.parametrize("twice", [False, True])
def test_texts_alone_are_not_shuffled(spark, monkeypatch, twice):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100 + i, t + " end") for i, t in enumerate(texts[:8])] + [(None, "a b"), (None, "a b"), (200, None)]
    rows += [(300, "one text"), (300, "another text of it")] if twice else []
    held = []
    real = neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, name: held.append((name, df)) or real(df, name))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan_of(next(df for name, df in held if name == "held-texts"))
        # the first of what is put together comes from the scan alone
        plan = plan_of(kept)
        assert "Union" in plan and "Scan" in plan.split("Union")[-1].split("SortMergeJoin")[0]
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = [*range(60), 200, *([300] if twice else [])]
    assert got == sorted([(False, i) for i in want] + [(True, 0)])
