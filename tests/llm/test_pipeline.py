"""The pipeline against its rules read plainly, stage by stage, and its edge cases."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from assayframe.llm import toxicity
from test_decontam import plain as plain_hits
from test_mixing import SPACE, plain_targets
from test_neardup import plain_classes

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_stage_by_stage(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_TOXIC", 2)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]

    def step(name, df):
        out = stages[name](spark, df, SF_DIR)
        if name != "token_ids":
            assert out.columns == docs.columns
        return spark.createDataFrame(out.collect(), out.schema)

    clean = step("toxicity", docs)
    model = toxicity.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {k for k, s in scores.items() if s < 0.3} and clean.count() < docs.count()

    single = step("near_duplicates", clean)
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, c in plain_classes(rows)})

    tested = step("decontamination", single)
    want = []
    for r in single.collect():
        n, hit, _ = plain_hits(r["text"], items, 13)
        if not hit or 20 * len(hit) < n:
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in tested.collect()) == sorted(want) and len(want) < single.count()

    mixed = step("mixing", tested)
    sizes, taken = {}, {}
    for df, to in ((tested, sizes), (mixed, taken)):
        for r in df.collect():
            to[r["source"]] = to.get(r["source"], 0) + len(SPACE.findall(r["text"] or ""))
    for s, t in plain_targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= max(len(SPACE.findall(r["text"] or "")) for r in tested.filter(tested["source"] == s).collect())
    assert len({str(r) for r in mixed.collect()} - {str(r) for r in tested.collect()}) == 0

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = sorted((r["doc_id"], np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in mixed.collect())
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in step("token_ids", mixed).collect())
    assert got == sorted((k, len(x) // 4, zlib.crc32(x)) for k, x in ids)
    whole = queries()["pipeline"](spark, SF_DIR)
    assert whole.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in whole.collect()) == got


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_odd_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "many words " * 20_000, "en", "s", 5), (3, "many words " * 20_000, "en", "s", 5), (None, "no id here", None, "t", None), (4, "?!", "en", None, 2)],
        docs.schema,
    ).selectExpr("*", "'a' as size", "'b' as n_words", "'c' as class_id", "1 as _key", "'d' as score", "2 as target")
    for rows in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_DIR)
            assert name == "token_ids" or out.columns == odd.columns, name
            n = out.count()
            assert n == 0 if rows is not odd else {"toxicity": 6, "near_duplicates": 5, "decontamination": 6, "token_ids": 6}.get(name, n) == n, (name, n)
