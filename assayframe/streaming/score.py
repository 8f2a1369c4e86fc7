"""Scoring new records as they arrive, with the same code as in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def score_stream(
    source: DataFrame, score: Callable[[DataFrame], DataFrame], *, path: str, checkpoint: str, format: str = "parquet"
) -> None:
    """Run a stateless scoring function over everything that has arrived, and stop.

    The checkpoint remembers which files were done; calling again goes on from
    there, and files are scored exactly once.
    """
    writer = (
        score(source)
        .writeStream.outputMode("append")
        .format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if format == "csv":
        writer = writer.option("header", True)
    writer.start().awaitTermination()
