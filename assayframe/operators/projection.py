"""A map of labelled sets by their distances: landmark scaling.

A few landmarks, far apart, are scaled classically: their squared distances, centred
both ways, give coordinates along the largest eigenvectors. Every other row is placed by
triangulation from its distances to the landmarks alone, so the work is rows times
landmarks and no distance between two rows is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.functions import vectors as vec
from assayframe.operators.neighbours import Space, choose_pivots
from assayframe.operators.rows import union_sets
from assayframe.operators.similarity import token_digest
from assayframe.runtime import cut_lineage

LANDMARKS = 128
# Rows that are measured at once.
ROWS = 512


def scale_landmarks(distances: np.ndarray, axes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinates of the landmarks, the matrix that triangulates, and their mean squared distances.

    Axes ascend by what they leave over; an axis without extent is zero. The sign of an
    axis is that of its landmark farthest out.
    """
    squares = np.asarray(distances, float) ** 2
    mean = squares.mean(0)
    centred = -(squares - mean[None, :] - mean[:, None] + mean.mean()) / 2
    values, vectors = np.linalg.eigh((centred + centred.T) / 2)
    order = np.argsort(-values, kind="stable")[:axes]
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    values[values <= 1e-12 * max(values.max(initial=0), 1e-300)] = 0
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1, 1)
    root = np.sqrt(values)
    back = np.divide(vectors, root, out=np.zeros_like(vectors), where=root > 0).T
    missing = axes - len(values)
    if missing:
        vectors, root, back = np.pad(vectors, ((0, 0), (0, missing))), np.pad(root, (0, missing)), np.pad(back, ((0, missing), (0, 0)))
    return vectors * root, back, mean


def project_by_landmarks(
    sets: dict[str, DataFrame], *, key: str, features: str, metric: str = "jaccard", axes: int = 2, landmarks: int = LANDMARKS
) -> DataFrame:
    """(origin, key, x1, x2, …): a place for each row of several labelled sets together.

    ``features`` holds tokens for ``jaccard`` and vectors of one length for the other
    metrics. Distances along the map are those of the metric as far as ``axes``
    dimensions can show them; where the metric is that of a space with so few
    dimensions, they are kept exactly. The cosine metric is mapped by the angle's chord.

    Landmarks are picked by the max-min walk from a bounded sample of all rows, in an
    order that depends on the features only. Rows without features, or with a component
    that is null or not finite, keep their row with null coordinates; without any usable
    row all are null. Equal rows share a place.
    """
    if metric != "jaccard":
        vec.distance(metric)
    if metric in vec.USER_DISTANCES:
        raise ValueError("the map needs a built-in metric")
    if axes < 1 or landmarks < 1:
        raise ValueError("axes and landmarks must be positive")
    rows = union_sets({name: df.select(key, F.col(features).alias("tokens")) for name, df in sets.items()})
    if metric != "jaccard":
        whole = F.forall("tokens", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = rows.withColumn("tokens", F.when(whole, F.col("tokens").cast("array<double>")))
    rows = cut_lineage(rows.withColumn("rep", F.when(F.col("tokens").isNotNull(), token_digest("tokens"))))
    names = [f"x{i + 1}" for i in range(axes)]
    space = Space(metric)
    usable = rows.filter("rep IS NOT NULL")
    if usable.isEmpty():
        return rows.select("origin", key, *[F.lit(None).cast("double").alias(c) for c in names])
    pivots = choose_pivots(usable.dropDuplicates(["rep"]), space, landmarks)
    places, back, mean = scale_landmarks(space.between(pivots, pivots), axes)
    shared = rows.sparkSession.sparkContext.broadcast((pivots, back, mean))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, back, mean = shared.value
        for whole in batches:
            for start in range(0, len(whole), ROWS):
                batch = whole.slice(start, ROWS)
                tokens = batch.column("tokens")
                known = np.flatnonzero(np.asarray(tokens.is_valid()))
                at = np.full((len(batch), len(back)), np.nan)
                if len(known):
                    points = space.placed(space.features(tokens.take(pa.array(known))))
                    at[known] = -(space.between(points, chosen) ** 2 - mean) @ back.T / 2
                columns = [pa.array(c, pa.float64(), from_pandas=True) for c in at.T]
                yield pa.RecordBatch.from_arrays([batch.column("origin"), batch.column(key), *columns], names=["origin", key, *names])

    kind = rows.schema[key].dataType.simpleString()
    schema = f"origin string, `{key}` {kind}, " + ", ".join(f"{c} double" for c in names)
    return rows.select("origin", key, "tokens").mapInArrow(place, schema)
