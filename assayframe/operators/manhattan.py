"""The mean normalised Manhattan distance of all pairs of rows, without the pairs.

The distance of x and y is the sum over components of |x_c - y_c| / (s + t), where s and t
are the sums of the absolute components of both. 1 / (s + t) is the integral of
exp(-(s + t) u) over u, and a quadrature of it with error below the rounding of a double
makes it a sum of products f(s) * f(t). For each such product the sum over all pairs of
|x_c - y_c| f(s) f(t) comes from one pass over the rows in the order of x_c. All terms are
positive, so nothing cancels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.runtime import cut_lineage

# The quadrature is off by less than this share.
ERROR = 1e-15
# Values of a component that are worked on at once, and values of a task.
PIECE, TASK_VALUES = 1 << 12, 1 << 20
# Sizes of rows, and the largest over the smallest, that the quadrature is made for.
SIZES, RANGE = (1e-100, 1e100), 1e30


def inverse_terms(low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """(u, w) so that the sum of w * exp(-r * u) is 1 / r for all r from ``low`` to ``high``.

    Gauss and Laguerre where the range is narrow, else the trapezoidal rule for u = exp(v),
    which takes a number of terms that grows with the logarithm of the range.
    """
    middle = sqrt(low) * sqrt(high)
    wide = sqrt(high / low)
    share = (wide - 1) / (wide + 1)
    n = 2 if share <= 0 else ceil(log(ERROR) / (2 * log(share))) + 2
    if n <= 30:
        u, w = np.polynomial.laguerre.laggauss(n)
        keep = w > 0
        # exp(-r u) = exp(-middle u) * exp(-(r - middle) u)
        return u[keep] / middle, w[keep] * np.exp(u[keep]) / middle
    step = pi**2 / -log(ERROR / 100)
    first, last = log(ERROR / 10) - log(high), log(-log(ERROR) + 4) - log(low)
    v = np.arange(first, last + step, step)
    return np.exp(v), step * np.exp(v)


def run_sums(x: np.ndarray, s: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[float, float, float, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, total, mass, below, above) of ascending ``x`` with sizes ``s``.

    With f the factors of a term: ``total`` is the sum of (y - x) / (s + t) over pairs,
    ``mass`` the sum of f, ``below`` of (last - x) f and ``above`` of (x - first) f.
    """
    pieces = []
    for start in range(0, len(x), PIECE):
        y = x[start:start + PIECE]
        f = np.exp(-np.multiply.outer(u, s[start:start + PIECE]))
        before = np.cumsum(f, axis=1)
        gaps = np.diff(y)
        # the distances to all rows before
        behind = np.cumsum(before[:, :-1] * gaps, axis=1)
        total = float(w @ (f[:, 1:] * behind).sum(axis=1))
        below = behind[:, -1] if len(y) > 1 else np.zeros(len(u))
        pieces.append((y[0], y[-1], total, before[:, -1], below, f @ (y - y[0])))
    return joined_runs(pieces, w)


def joined_runs(runs: list[tuple], w: np.ndarray) -> tuple:
    """:func:`run_sums` of runs that follow each other."""
    first, last, total, mass, below, above = runs[0]
    for begin, end, own, more, under, over in runs[1:]:
        at_begin = below + (begin - last) * mass
        total += own + float(w @ (at_begin * more + mass * over))
        below = at_begin + (end - begin) * mass + under
        above = above + over + (begin - first) * more
        mass, last = mass + more, end
    return first, last, total, mass, below, above


def _summed(u: np.ndarray, w: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Values in the order of component and size of a partition, as one row for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, tuple]] = []
        for batch in batches:
            dim, x, s = (np.asarray(batch.column(c)) for c in ("dim", "x", "s"))
            starts = np.flatnonzero(np.concatenate([[True], dim[1:] != dim[:-1]])[:len(dim)])
            for start, stop in zip(starts, [*starts[1:], len(dim)]):
                sums = run_sums(x[start:stop], s[start:stop], u, w)
                if held and held[-1][0] == dim[start]:
                    sums = joined_runs([held.pop()[1], sums], w)
                elif held:
                    yield _row(*held.pop())
                held.append((dim[start], sums))
        if held:
            yield _row(*held.pop())

    return run


def _row(dim: int, sums: tuple) -> pa.RecordBatch:
    first, last, total, *factors = sums
    return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "first": [first], "last": [last], "total": [total], "factors": pa.array([np.concatenate(factors)], pa.list_(pa.float64()))})


def _joined(w: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("first", "ascending"), ("last", "ascending")])
        runs = [(a, b, t, *np.split(np.asarray(f), 3)) for a, b, t, f in zip(*(rows[c].to_pylist() for c in ("first", "last", "total", "factors")))]
        return pa.table({"total": pa.array([joined_runs(runs, w)[2]], pa.float64())})

    return run


def average_normalized_manhattan(rows: DataFrame) -> DataFrame | None:
    """(n, average) of the vectors ``v``, which have one length; None if their sizes are out of all proportion.

    Two rows of zeros have no distance, nor has a row with a component that is missing or
    not finite; the average is null then.
    """
    sized = rows.select("v", F.aggregate("v", F.lit(0.0), lambda t, x: t + F.abs(x)).alias("s"))
    endless = F.exists("v", lambda x: F.abs(x) == float("inf"))
    s = F.col("s")
    n, bad, zeros, low, high, least, most = sized.agg(
        F.count(F.lit(1)), F.count_if(s.isNull() | F.isnan(s) | endless), F.count_if(s == 0), F.min(F.when(s > 0, s)), F.max("s"), F.min(F.size("v")), F.max(F.size("v"))
    ).first()
    if least != most:
        raise ValueError("vectors differ in length")
    if n < 2 or bad or zeros > 1:
        return rows.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(None).cast("double").alias("average"))
    if not (SIZES[0] <= low <= high <= SIZES[1] and high <= low * RANGE):
        return None
    u, w = inverse_terms(2 * low, 2 * high)
    values = sized.filter("s > 0").select("s", F.posexplode("v").alias("dim", "x"))
    # by the size too: a value that many rows have is not all one task's
    order = ["dim", "x", "s"]
    dealt = values.repartitionByRange(ceil((n - zeros) * most / TASK_VALUES), *order).sortWithinPartitions(*order)
    # a row for each component, and one more for each task
    runs = cut_lineage(dealt.mapInArrow(_summed(u, w), "dim int, first double, last double, total double, factors array<double>"))
    totals = runs.groupBy("dim").applyInArrow(_joined(w), "total double")
    # a row of zeros is at distance 1 of all others
    pairs = n * (n - 1) / 2
    average = (F.coalesce(F.sum("total"), F.lit(0.0)) + F.lit(float(zeros * (n - zeros)))) / F.lit(pairs)
    return totals.agg(average.alias("average")).select(F.lit(n).cast("long").alias("n"), "average")
