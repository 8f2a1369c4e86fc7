"""Hashed fingerprints of text and similarity of two fingerprints.

A fingerprint is a sorted array of distinct int tokens. For a bit fingerprint
the tokens are the set bits; for counts, every occurrence of a bit is a token of
its own (``bit + n_bits * occurrence``), so that set operations on the tokens
give the min/max sums on the counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions.hashing import word_tokens


def text_hash(text: Column) -> Column:
    """First 32 bits of the md5 of a text, as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` reads it."""
    return F.transform(F.array(value), body)[0]


def shingles(text: Column, *, kind: str = "word", size: int = 3) -> Column:
    """Runs of ``size`` words or characters; a shorter text is one run by itself."""
    if size < 1:
        raise ValueError("size must be positive")

    def starts(length: Column) -> Column:
        return F.sequence(F.lit(1), F.greatest(length - (size - 1), F.lit(1)))

    if kind == "word":
        words = F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != "")
        runs = _once(
            words,
            lambda ws: F.transform(starts(F.size(ws)), lambda i: F.array_join(F.slice(ws, i, size), " ")),
        )
    elif kind == "char":
        runs = F.transform(starts(F.length(text)), lambda i: F.substring(text, i, F.lit(size)))
    else:
        raise ValueError(f"unknown kind {kind!r}: use 'word' or 'char'")
    return F.when(text.isNotNull(), F.filter(runs, lambda r: r != ""))


def bit_positions(text: Column, *, kind: str, size: int, n_bits: int) -> Column:
    """The bit of every shingle, repeats included."""
    if n_bits < 1:
        raise ValueError("n_bits must be positive")
    runs = shingles(text, kind=kind, size=size)
    return F.transform(runs, lambda r: F.pmod(text_hash(r), F.lit(n_bits)).cast("int"))


def bit_tokens(text: Column, *, kind: str = "word", size: int = 3, n_bits: int = 1024) -> Column:
    """Bit fingerprint: the set bits in ascending order; null text gives null.

    Runs of words are hashed for many texts at once, see :mod:`hashing`: an eighth of the
    time of the column expression, which characters still use.
    """
    if kind == "word" and size >= 1 and 1 <= n_bits < 1 << 31:
        return word_tokens(text, size, n_bits)
    return F.sort_array(F.array_distinct(bit_positions(text, kind=kind, size=size, n_bits=n_bits)))


def count_tokens(counts: Column, n_bits: int) -> Column:
    """A ``MAP<INT, INT>`` count fingerprint as occurrence tokens."""
    expanded = F.transform(
        F.filter(F.map_entries(counts), lambda e: e["value"] > 0),
        lambda e: F.transform(
            F.sequence(F.lit(0), e["value"] - 1), lambda i: e["key"] + F.lit(n_bits) * i
        ),
    )
    return F.sort_array(F.flatten(expanded))


def occurrence_tokens(bits: Column, n_bits: int) -> Column:
    """The occurrence tokens of an array of bits with repeats, not empty, in time in proportion to its sorting."""

    def runs(ordered: Column) -> Column:
        first = lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), first)
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(ordered)))
        return F.zip_with(starts, ends, lambda s, e: F.transform(F.sequence(F.lit(0), e - s - 1), lambda i: F.get(ordered, s) + F.lit(n_bits) * i))

    return F.sort_array(F.flatten(_once(F.sort_array(bits), runs)))


def common_tokens(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared over all tokens; two empty fingerprints are the same."""
    shared = common_tokens(a, b)
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 1.0).otherwise(F.try_divide(shared.cast("double"), union.cast("double")))


def dice_distance(a: Column, b: Column) -> Column:
    """1 - 2 * shared / sum of sizes; two empty fingerprints are the same."""
    total = F.size(a) + F.size(b)
    share = F.try_divide(2.0 * common_tokens(a, b), total.cast("double"))
    return F.when(total == 0, 0.0).otherwise(1 - share)


def packed_words(tokens: Column, n_bits: int) -> Column:
    """Set bits as 32-bit words in an ``ARRAY<BIGINT>``, for dense fingerprints."""
    words = F.sequence(F.lit(0), F.lit((n_bits + 31) // 32 - 1))
    return F.transform(
        words,
        lambda w: F.aggregate(
            F.filter(tokens, lambda t: F.floor(t / 32) == w),
            F.lit(0).cast("long"),
            lambda acc, t: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(t, F.lit(32)))),
        ),
    )


def tanimoto_packed(a: Column, b: Column) -> Column:
    """Tanimoto of two packed fingerprints of the same width."""

    def ones(words: Column) -> Column:
        return F.aggregate(words, F.lit(0), lambda acc, w: acc + F.bit_count(w))

    shared = ones(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))
    union = ones(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    return F.when(union == 0, 1.0).otherwise(F.try_divide(shared.cast("double"), union.cast("double")))
