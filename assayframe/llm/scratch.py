"""Tables written to the shared folder, and the split between learning and held-out rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.runtime import scratch_path


#: Rows and bytes that Spark hands to Python at once: texts are long.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after the session was told to hand smaller Arrow batches to Python.

    Batches live outside the heap, for each running task. Lower settings are kept.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        number, unit_ = re.fullmatch(r"(-?\d+)\s*([kmg]?)i?b?", conf.get(key).lower()).groups()
        if not 0 < int(number) << 10 * " kmg".index(unit_ or " ") <= most:
            conf.set(key, str(most))
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts lineage: what reads the result no longer depends on executors that may be
    lost, and each column is read only where it is needed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    if _OPEN:
        _OPEN[-1].tables.append((path, table))
    return table


class _Consumed:
    """Tables written inside a block, and those that outlive it."""

    def __init__(self) -> None:
        self.tables: list[tuple[str, DataFrame]] = []
        self.kept: list[DataFrame] = []

    def keep(self, *tables: DataFrame) -> None:
        """What the block returns still reads these."""
        self.kept += tables


_OPEN: list[_Consumed] = []


@contextmanager
def consumed() -> Iterator[_Consumed]:
    """Tables that ``stored`` writes inside are removed at the end, but for those kept.

    Only for tables whose readers have all been run: what is returned must read kept
    tables alone. A kept table belongs to the block around this one, if there is one.
    """
    block = _Consumed()
    _OPEN.append(block)
    try:
        yield block
    finally:
        _OPEN.pop()
        for path, table in block.tables:
            if not any(table is k for k in block.kept):
                remove(table.sparkSession, path)
            elif _OPEN:
                _OPEN[-1].tables.append((path, table))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote below the shared one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remainder(doc_id: Column, by: int = 4) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: its remainder is 2. A null id is not."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def unit(*columns: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the columns only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / float(1 << 52)


def sample_share(df: DataFrame, by: Column, text: str, rows: int, chars: int) -> dict:
    """For each value of ``by``: the share of rows that keeps to both bounds on average.

    One row per value reaches the driver; meant for labels and languages, of which
    there are few.
    """
    counted = df.groupBy(by.alias("by")).agg(F.count("*").alias("n"), F.sum(F.length(text).cast("double")).alias("size")).collect()
    return {r["by"]: min(1.0, rows / r["n"], chars / max(r["size"] or 0, 1)) for r in counted}
