"""Word bits in numpy are those of the column expression."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayframe.functions import fingerprint as fp
from assayframe.functions import hashing


@pytest.mark.parametrize("size", [1, 2, 3])
@pytest.mark.parametrize("n_bits", [7, 1 << 20, (1 << 31) - 1])
def test_word_bits_are_those_of_the_expression(spark, size, n_bits):
    rng = random.Random(size)
    texts = [None, "", " ", "a", "a b", "  a\tb\n\rc ", "x" * 54 + " ", "x" * 55, "x" * 56 + " y", "x" * 200 + " z " + "w" * 70]
    texts += ["".join(rng.choice("ab é\t\n\r  zß日\x0b ") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    want = F.sort_array(F.array_distinct(fp.bit_positions(F.col("t"), kind="word", size=size, n_bits=n_bits)))
    rows = df.select(fp.bit_tokens(F.col("t"), size=size, n_bits=n_bits).alias("a"), want.alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    part = pa.array([None, *texts, "q r"], pa.string()).slice(1, len(texts))
    assert hashing.word_bits(part, size, n_bits).to_pylist() == [r.b for r in rows]
    assert hashing.word_bits(pa.array([], pa.string()), size, n_bits).to_pylist() == []


def test_texts_are_hashed_once(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "id long, t string").select("id", fp.bit_tokens(F.col("t"), size=2).alias("bits"))
    some = df.filter("bits IS NOT NULL")
    assert some.count() == 1 and some._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
