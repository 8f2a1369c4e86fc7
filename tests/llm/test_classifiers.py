"""Language and toxicity models on small made-up corpora."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayframe.llm import langid, toxicity
from assayframe.llm.text import slices

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ver", "ein"], "éé": ["ção", "ão", "nh", "lh"]}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        t = text(rng, lang)
        toxic = int(rng.random() < 0.25)
        if toxic:  # a stem of its own in each language, with many endings
            w = t.split(" ")
            for _ in range(2):
                w[rng.randrange(len(w))] = {"aa": "zug", "bb": "moro", "éé": "idê"}[lang] + rng.choice(SYLLABLES[lang]) + rng.choice(SYLLABLES[lang])
            t = " ".join(w)
        rows.append((i, t, lang, toxic))
    return rows


def grams(text, buckets=langid.BUCKETS):
    """The n-grams of one text, made one by one."""
    s = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
    return sorted(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if (s[i + 1].strip() if n == 3 else s[i:i + n].strip()))


def test_ngrams_of_each_row():
    texts = ["", "Ab, é", "x", "  ", "12 !", "Straße ÄÖ", None, "𝒜bc 😀 d"]
    part = next(slices(pa.array(texts)))
    values, offsets = langid.ngrams(*langid.characters(part))
    for i, t in enumerate(texts):
        alone = next(slices(pa.array([t])))
        single, _ = langid.ngrams(*langid.characters(alone))
        assert sorted(values[offsets[i]:offsets[i + 1]]) == sorted(single)
        assert len(single) == len(grams(t or "")), (t, grams(t or ""))


def test_ftrl_makes_weights_sparse():
    rng = np.random.default_rng(0)
    strong, weak = langid.Ftrl(50, 2, l1=3.0), langid.Ftrl(50, 2, l1=0.0)
    for _ in range(400):
        x = rng.random(50)
        for model in (strong, weak):
            model.step(np.arange(50), x, int(x[0] > 0.5))
    assert (strong.weights() == 0).mean() > (weak.weights() == 0).mean()
    w = weak.weights()
    assert abs(w[0, 1] - w[0, 0]) == max(abs(w[:, 1] - w[:, 0]))


def test_language_table(spark):
    rows = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").selectExpr("*", "'q' as score", "1 as n")
    model = langid.train(docs.filter("doc_id % 4 <> 2"))
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "12 !"), (903, "schungver " * 30_000), (904, "Ein"), (904, "Ein")], "doc_id long, text string").selectExpr("doc_id", "text", "null as lang", "0 as toxic", "'q' as score", "1 as n")
    got = langid.identify(docs.filter("doc_id % 4 = 2").unionByName(odd), model).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "toxic", "n", "lang_pred", "score"}
    known = [r for r in got if r["doc_id"] < 900]
    assert all(r["lang_pred"] == r["lang"] for r in known) and all(0 <= r["score"] <= 1 for r in got)
    assert {(r["doc_id"], r["lang_pred"]) for r in got if r["doc_id"] >= 900} == {(900, "und"), (901, "und"), (902, "und"), (903, "bb"), (904, "bb")}
    assert langid.train(docs.limit(0)).languages == []
    assert {r["lang_pred"] for r in langid.identify(docs.limit(3), langid.train(docs.limit(0))).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
    one = langid.train(docs.filter("lang = 'aa'"))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs.limit(5), one).collect()} == {("aa", 1.0)}


def test_temperature_lowers_certainty():
    model = langid.LanguageModel(["a", "b"], np.zeros((4, 2)), np.array([2.0, 0.0]), temperature=4.0)
    assert model.probabilities(np.array([[2.0, 0.0]]))[0, 0] == pytest.approx(1 / (1 + np.exp(-0.5)))


def test_responses_stay_within_rows():
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 1 << 16, (n, 5)).astype(np.uint16) for n in (0, 1, 2, 3, 9, 0, 4)]
    model = toxicity.start([r for r in rows], np.array([0, 1, 0, 1, 0, 0, 1.0]), 0)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    together = model.logits(np.concatenate(rows), offsets)
    alone = [model.logits(r, np.array([0, len(r)]))[0] for r in rows]
    assert np.allclose(together, alone, atol=1e-5)


def test_gradient_goes_down():
    rows = corpus(200, 3)
    y = np.array([r[3] for r in rows], float)
    buckets = [toxicity.word_buckets(next(slices(pa.array([r[1].encode()], pa.binary()))))[0] for r in rows]
    model, squares = toxicity.start(buckets, y, 1), {}
    first = toxicity._loss(toxicity._all(model, buckets), y)
    for _ in range(20):
        toxicity.step(model, buckets, y, squares, 0.05)
    assert toxicity._loss(toxicity._all(model, buckets), y) < first / 2


def test_best_cut():
    z, y = np.array([3.0, 2.0, 1.0, -5.0, -6.0]), np.array([1, 1, 0, 0, 0.0])
    assert toxicity.best_cut(z, y) == pytest.approx(1.5)


def test_toxicity_table(spark):
    rows = corpus(900, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").drop("toxic").selectExpr("*", "'q' as score")
    labels = spark.createDataFrame([(r[0], r[3], 1) for r in rows] + [(1, None, 1), (None, 1, 1), (5000, 1, 1)], "doc_id long, toxic int, text int")
    model = toxicity.train(docs, labels.filter("doc_id % 4 <> 2"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(got[r[0]] >= 0.3, r[3]) for r in rows if r[0] % 4 == 2]
    assert np.mean([a == b for a, b in held]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "kalo " * 50_000), (4, "kalo"), (5, "kalo zugkalo moroung " * 9)], "doc_id long, text string").selectExpr("*", "2 as _c0", "'s' as _score")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and max(scores[k] for k in (1, 2, 3)) < 0.3 <= scores[5]
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 4]
    assert toxicity.score(docs.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.filter("toxic = 0").filter(F.col("doc_id").isNotNull())):
        flat = toxicity.score(docs.limit(4), toxicity.train(docs, few)).collect()
        assert len({r["score"] for r in flat}) == 1
    again = toxicity.score(docs.repartition(5), toxicity.train(docs.repartition(3), labels.filter("doc_id % 4 <> 2")))
    assert {r["doc_id"]: r["score"] for r in again.collect()} == pytest.approx(got, abs=1e-6)
