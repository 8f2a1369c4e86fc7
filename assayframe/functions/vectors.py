"""Distances between two array columns, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def manhattan_norm(a: Column) -> Column:
    return _total(F.transform(a, lambda x: F.abs(x.cast("double"))))


def euclidean(a: Column, b: Column) -> Column:
    def squared(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_total(F.zip_with(a, b, squared)))


def manhattan(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    # Fixed value: the small term that keeps zero vectors from dividing by zero.
    return 1 - dot(a, b) / (norm(a) * norm(b) + 1e-9)


def normalized_euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance over the product of the norms; null for a zero vector."""
    return F.try_divide(euclidean(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def normalized_manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance over the sum of the norms; null if both are zero."""
    return F.try_divide(manhattan(a, b), manhattan_norm(a) + manhattan_norm(b))


DISTANCES: dict[tuple[str, bool], Callable[[Column, Column], Column]] = {
    ("euclidean", False): euclidean,
    ("euclidean", True): normalized_euclidean,
    ("manhattan", False): manhattan,
    ("manhattan", True): normalized_manhattan,
    ("cosine", False): cosine,
}


#: Distances of users, see :func:`assayframe.functions.user.register_distance`.
USER_DISTANCES: dict[str, Callable] = {}
# Those of them that take numpy matrices.
MATRIX_DISTANCES: set[str] = set()


def distance(metric: str, normalize: bool = False) -> Callable[[Column, Column], Column]:
    """The distance function by name. Users' distances have no normalised form."""
    if metric in USER_DISTANCES and not normalize:
        return USER_DISTANCES[metric]
    if metric == "cosine":
        normalize = False
    if (metric, normalize) not in DISTANCES:
        raise ValueError(f"unknown metric {metric!r}: use 'euclidean', 'manhattan' or 'cosine'")
    return DISTANCES[metric, normalize]
