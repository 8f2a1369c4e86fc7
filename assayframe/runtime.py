"""Session settings and lineage cuts shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "assayframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Nothing here depends on the size of the data: shuffle partition counts are
    left to adaptive execution, which coalesces small and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small shuffles may feed heavy work, such as set intersections: keep the cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64kb")
        # files of checkpoints nothing refers to any more are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship(session)
    return session


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session.

    Their Python workers then find it wherever the driver was started.
    """
    context = spark.sparkContext
    if getattr(context, "_assayframe_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="assayframe-")
    archive = os.path.join(folder, "assayframe.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for place, folders, files in os.walk(root):
            folders[:] = sorted(f for f in folders if f != "__pycache__")
            for name in sorted(files):
                if name.endswith((".py", ".jsonl")):
                    path = os.path.join(place, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._assayframe_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up in local mode, where there is one
    machine; on a cluster without the setting this is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="assayframe-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and continue from there.

    Used where a result is read several times or a loop would otherwise grow its
    plan. The files outlive executors, so a lost one costs no recomputation.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, figure: Column) -> tuple[DataFrame, object]:
    """``df`` as a Parquet table in the shared folder, and an aggregate of it.

    The aggregate is a scan of one column. It is not observed while the table is written:
    once a session has observed something, fitted models of it cannot be sent to tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table, table.agg(figure.alias("figure")).first()["figure"]


# A table of at most this many short rows is broadcast.
SMALL_ROWS = 10_000


def small(df: DataFrame) -> DataFrame:
    """Write a summary table once and mark it for broadcast if it is small.

    The rows are counted, so the size is known and not estimated. A larger table
    comes back without the mark and is joined by a shuffle.
    """
    written = cut_lineage(df)
    return F.broadcast(written) if written.count() <= SMALL_ROWS else written


def one_row(stats: DataFrame) -> Column:
    """The single row of ``stats`` as a struct-valued scalar subquery.

    Lets an expression use global statistics without a join; Spark runs the
    subquery once and fails if it yields more than one row.
    """
    return stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("row")).scalar()


def widen(df: DataFrame) -> DataFrame:
    """Spread a *scan* over the cores when the file layout gives fewer splits.

    Row-heavy work such as fingerprinting on a table stored as one row group
    would otherwise be one task. Large tables have more splits than cores and
    are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
