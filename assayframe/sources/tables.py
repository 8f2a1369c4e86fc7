"""Reading and writing assay, feature and assignment tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from assayframe.operators.rows import nan_to_null


def csv_scan(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A headered CSV file or folder with an explicit schema; empty and NaN are null."""
    df = spark.read.csv(path, schema=schema, header=True, multiLine=False, escape='"')
    return nan_to_null(df)


def table_sink(
    df: DataFrame, path: str, *, format: str = "parquet", mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Write a table as parquet or headered CSV. Booleans come out as text in CSV."""
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if format == "csv":
        writer.csv(path, header=True, escape='"')
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {format!r}: use 'parquet' or 'csv'")


def save_assignment(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Keep an expensive cluster or fold table, partitioned for reading one part back."""
    table_sink(df, path, mode=mode, partition_by=partition_by)


def load_assignment(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read an assignment table back; with its schema, partition columns keep their type."""
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def save_bucketed(
    df: DataFrame, name: str, *, key: str, buckets: int, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Keep a table in buckets of its key, as table ``name`` with its files at ``path``.

    Tables that share key and number of buckets are joined without a shuffle; a table
    that does not is shuffled to the buckets of one that does. Rows are dealt to the
    buckets once, so each has one file for each part it is in.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    writer = df.repartition(buckets, key).write.mode(mode).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def load_bucketed(
    spark: SparkSession, name: str, *, path: str, schema: T.StructType, key: str, buckets: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """The table ``name``; in a session that does not know it, it is declared over the files at ``path`` first."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {parts} CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )
        if partition_by:
            spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*schema.names)


def csv_stream_source(
    spark: SparkSession, path: str, schema: str | T.StructType, *, files_per_trigger: int | None = None
) -> DataFrame:
    """CSV files arriving in a folder, as a stream."""
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"')
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)
