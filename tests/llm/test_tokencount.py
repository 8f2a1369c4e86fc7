"""Counts with the shortcut against the library on whole texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assayframe.llm import tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CONTENT = open(PATH, encoding="utf-8").read()
COUNTER = tokencount.Counter(CONTENT, tokencount.prove_whole(LIBRARY), tokencount.differing(LIBRARY))

HARD = [
    "", " ", "  \n\n  x", "don't  we'LL ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "é́ß 東京 ١٢٣", "🙂🙂 a", " 　x y", "\x00\x1c\x1d a",
    "a" * 5000, "\n" * 300 + "end", "½²Ⅷ x", "ᲉꟋࢗ new letters", "᠎​﻿",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdtl.,<|>aé1")), max_size=60))
def test_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_whole():
    whole = tokencount.prove_whole(LIBRARY)
    assert len(whole) > 40_000
    assert all(len(LIBRARY.encode(t, add_special_tokens=False).ids) == 1 for t in whole[::97])


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "MEMO_SIZE", len(COUNTER.whole) + 10)
    for i in range(200):
        text = f" zqx{i}yvw" * 3
        assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)
    assert len(COUNTER) < len(COUNTER.whole) + 20


def test_table(spark):
    rows = [(1, None), (2, ""), *((3 + i, t) for i, t in enumerate(HARD)), (3, HARD[3]), (None, "null id"), (90, "word next " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as n_tokens", "2 as other")
    got = sorted(map(str, tokencount.count_tokens(docs, PATH).select("doc_id", "n_bytes", "n_tokens", "other").collect()))
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids), 2) for i, t in rows]
    assert got == sorted(f"Row(doc_id={a}, n_bytes={b}, n_tokens={c}, other={d})" for a, b, c, d in want)
    assert tokencount.count_tokens(docs.limit(0), PATH, keep=["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        tokencount.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
