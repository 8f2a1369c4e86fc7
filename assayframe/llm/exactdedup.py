"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Column expressions and aggregates only. Each step counts a cheap key over the rows that
the step before could not tell apart, and marks the keys that occur more than once in a
bitmap of fixed size. The bitmap is broadcast, so the next step decides at the scan, row
by row, whether it has to look further into the text; texts are never shuffled for it.
Two keys may share a bit, which costs a hash and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.llm.scratch import stored
from assayframe.operators.skew import attach

#: Characters of a text that the second step hashes.
PREFIX = 256
#: Bits of a bitmap, as a power of two: 8 MB when full, whatever the number of rows.
BITS = 26
#: Bits that one row of a bitmap holds, as ``bitmap_construct_agg`` makes it.
ROW_BITS = 1 << 15


def repeated(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(row, bitmap): a bit for each value of the long column ``key`` that occurs more than once.

    Values are counted with partial aggregation, so a value that a third of all rows
    have is a few partial counts.
    """
    return present(keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), key, bits)


def present(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(row, bitmap): a bit for each value of the long column ``key``. At most 2^bits / 2^15 rows of 4 KB."""
    slot = F.pmod(F.col(key), F.lit(1 << bits))
    placed = keys.select(F.shiftright(slot, 15).cast("int").alias("row"), F.pmod(slot, F.lit(ROW_BITS)).alias("place")).distinct()
    return placed.groupBy("row").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def marked(df: DataFrame, key: str, bitmap: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with a boolean column ``name``: whether the bit of ``key`` is set; a null key has none.

    The bitmap has a fixed size, so it is broadcast.
    """
    slot = F.pmod(F.col(key), F.lit(1 << bits))
    place = F.pmod(slot, F.lit(ROW_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bitmap"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(place, F.lit(8))).bitwiseAND(F.lit(1))
    rows = F.broadcast(bitmap.select(F.col("row").alias("__row"), F.col("bitmap").alias("__bitmap")))
    met = df.join(rows, F.shiftright(slot, 15).cast("int") == F.col("__row"), "left")
    return met.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("__row", "__bitmap")


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
    every_digest: bool = False,
    prefix: int = PREFIX,
    bits: int = BITS,
) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` (the id unless named), keep_id, group_size, kept, digest.

    Rows are one group when their whole texts are identical, byte by byte; a null text
    counts as empty. The row with the largest id stays (``kept``), ``keep_id`` is its id,
    ``group_size`` the number of rows of the group. A null id is below every other; a
    group with null ids only has a null ``keep_id``. Of rows that repeat both text and
    id one stays. An empty table gives an empty result; other columns of ``docs`` take
    no part, whatever their names.

    ``digest`` is the sha256 of the text. It is only worked out for texts whose length
    and prefix hash others share; for the others it is null, unless ``every_digest``
    asks for it, which then happens where their rows are emitted.

    Three scans: the first reads lengths, the second the first ``prefix`` characters of
    rows with a repeated length, the third whole texts of rows whose length and prefix
    are repeated. Only ids, digests and the columns ``keep`` of those rows are shuffled,
    after a group was summed up where its rows lie; the rows of a hot group are salted.
    """
    names = [id_col] if keep is None else list(keep)
    decided = _decided(docs, id_col, text, names, every_digest, prefix, bits)
    return decided.select(
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(names)],
        F.col("__keep_id").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"),
        F.col("__digest").alias("digest"),
    )


def _decided(docs: DataFrame, id_col: str, text: str, names: Sequence[str], every_digest: bool, prefix: int, bits: int) -> DataFrame:
    """__keep_0, __keep_1, … for the columns ``names``, and __keep_id, __size, __kept, __digest."""
    content = F.coalesce(F.col("__text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).cast("string").alias("__text"), *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(names)])

    rows = rows.withColumn("__length", F.octet_length(content).cast("long"))
    by_length = stored(repeated(rows.select(F.xxhash64("__length").alias("__key")), "__key", bits), "lengths")

    # null, and so left out of what is counted next, where the length alone tells a text apart
    def refined(df: DataFrame) -> DataFrame:
        near = marked(df.withColumn("__key", F.xxhash64("__length")), "__key", by_length, "__near", bits)
        second = F.xxhash64("__length", F.substring(content, 1, prefix))
        return near.withColumn("__key", F.when(F.col("__near"), second)).drop("__near")

    counted = refined(rows.select("__text", "__length")).select("__key").filter("__key IS NOT NULL")
    by_prefix = stored(repeated(counted, "__key", bits), "prefixes")

    full = marked(refined(rows), "__key", by_prefix, "__open", bits)
    sha = F.sha2(content, 256)
    full = full.withColumn("__digest", sha if every_digest else F.when(F.col("__open"), sha))
    full = full.drop("__text", "__length", "__key").withColumn("__row", F.monotonically_increasing_id())
    # written, so that the row numbers stay what they are when a task runs again
    full = stored(full, "digests")

    kept = [f"__keep_{i}" for i in range(len(names))]
    alone = full.filter("NOT __open").select(
        *kept, F.col("__id").alias("__keep_id"), F.lit(1).cast("long").alias("__size"), F.lit(True).alias("__kept"), "__digest"
    )
    # first by text and id, then by text: both sums are made partly where the rows lie
    by_id = full.filter("__open").groupBy("__digest", "__id").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__row"))
    groups = by_id.groupBy("__digest").agg(
        F.max("__id").alias("__keep_id"),
        F.sum("__n").alias("__size"),
        F.coalesce(F.max_by("__row", "__id"), F.min("__row")).alias("__keep_row"),
    )
    met = attach(full.filter("__open"), groups, ["__digest"], "__size", ["__row"])
    shared = met.select(*kept, "__keep_id", "__size", (F.col("__row") == F.col("__keep_row")).alias("__kept"), "__digest")
    return alone.unionByName(shared)


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, see :func:`exact_duplicates`."""
    decided = _decided(docs, id_col, text, docs.columns, False, PREFIX, BITS).filter("__kept")
    return decided.select(*[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(docs.columns)])
