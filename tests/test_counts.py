"""Count fingerprints of keys in one and in several rows."""

from collections import Counter

from pyspark.sql import functions as F

from assayframe.functions import fingerprint as fp
from assayframe.operators import features


def tokens_of(bits, n_bits):
    return sorted(b + n_bits * i for b, n in Counter(bits).items() for i in range(n))


def test_occurrences_of_one_row(spark):
    rows = [[3], [3, 3, 3], [5, 1, 5, 2, 1, 5], list(range(6)) * 3]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, bits array<int>")
    got = {r["id"]: r["t"] for r in df.select("id", fp.occurrence_tokens(F.col("bits"), 8).alias("t")).collect()}
    assert got == {i: tokens_of(r, 8) for i, r in enumerate(rows)}


def test_single_keys_are_not_grouped_by_bit(spark):
    rows = [(1, "aaaaab"), (2, "abcabc"), (2, "abc"), (None, "aaaa"), (None, "aaa"), (3, None), (4, ""), (4, "xyz"), (2, "abc")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = features.hashed_fingerprint(df, key="id", text="t", kind="char", size=3, n_bits=64, counts=True)
    bits = {(r["id"], r["t"]): r["b"] for r in df.select("*", fp.bit_positions(F.col("t"), kind="char", size=3, n_bits=64).alias("b")).collect()}
    want = [(3, None), (4, [])]
    for key in (1, 2, None, 4):
        want.append((key, tokens_of([b for k, t in rows if k == key and t for b in bits[k, t]], 64)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # without repeated keys, nothing is exploded to a row for each bit
    alone = features.hashed_fingerprint(df.filter("id IN (1, 3)"), key="id", text="t", kind="char", size=3, n_bits=64, counts=True)
    assert "Generate" not in alone._jdf.queryExecution().toString()
