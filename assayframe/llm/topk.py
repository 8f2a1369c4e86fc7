"""Exact top-k inner products with a pivot table.

Distances from every vector to a few pivots are computed once. For a query q, a
candidate x and any pivot p, ``|q - x| >= |d(q, p) - d(x, p)|``; the largest of these
lower bounds gives an upper bound of the inner product,
``(|q|^2 + |x|^2 - bound^2) / 2``. Candidates are evaluated in the order of their bounds
until no bound left can reach the k-th score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.scratch import stored, unit

PIVOTS = 16
PIVOT_SAMPLE = 256
BLOCK = 2048


def choose_pivots(vectors: DataFrame, id_col: str, vector: str, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> dict[int, np.ndarray]:
    """By dimension: up to ``n`` vectors far apart, picked from a sample of at most ``sample`` rows.

    Pivots only decide how many candidates are evaluated, never the result.
    """
    rows = vectors.select(vector).orderBy(unit(F.col(id_col), seed=5), id_col).limit(sample).collect()
    by_size: dict[int, list] = {}
    for (v,) in rows:
        by_size.setdefault(len(v), []).append(v)
    pivots = {}
    for size, found in by_size.items():
        found = np.unique(np.array(found, float).reshape(len(found), size), axis=0)
        picked = [int(np.argmax((found**2).sum(1)))]
        near = _distances(found, found[picked])[:, 0]
        while len(picked) < min(n, len(found)):
            picked.append(int(np.argmax(near)))
            near = np.minimum(near, _distances(found, found[picked[-1:]])[:, 0])
        pivots[size] = found[picked]
    return pivots


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0))


def pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray], vector: str) -> DataFrame:
    """``vectors`` with ``to_pivots``: distances to the pivots of its dimension, if it has any."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema), "to_pivots array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(vector))
            far = [None] * len(batch)
            lengths = np.array(rows.value_lengths())
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                if size in pivots:
                    d = _distances(_matrix(rows.take(pa.array(at)), size), pivots[size])
                    for i, row in zip(at, d):
                        far[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far, pa.list_(pa.float64()))], names=[*batch.schema.names, "to_pivots"])

    return vectors.mapInArrow(run, schema)


def _matrix(lists, size: int) -> np.ndarray:
    return np.asarray(lists.flatten(), float).reshape(len(lists), size)


def search_block(queries: dict, rows: dict, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each query: its place, ids and scores of its k best rows, and how many were evaluated.

    Both sides: id, vectors (int64 matrix), to_pivots.
    """
    x = rows["vectors"]
    size = x.shape[1]
    top = max((int(np.abs(m).max(initial=0)) for m in (x, queries["vectors"])), default=0)
    exact = top * top * max(size, 1) < 1 << 52
    x = x.astype(float) if exact else x.astype(object)
    squares = (rows["vectors"].astype(float) ** 2).sum(1)
    for i, q in enumerate(queries["vectors"]):
        square = float((q.astype(float) ** 2).sum())
        near = np.abs(rows["to_pivots"] - queries["to_pivots"][i]).max(1, initial=0)
        bounds = (square + squares - near**2) / 2
        # rounding of the distances above must never hide a candidate
        bounds += 1e-9 * (square + squares + near**2) + 1
        bounds[rows["id"] == queries["id"][i]] = -np.inf
        order = np.argsort(-bounds, kind="stable")
        order = order[:int(np.isfinite(bounds).sum())]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, max(4 * k, 32)
        q = q.astype(float) if exact else q.astype(object)
        while at < len(order) and not (len(ids) == k and bounds[order[at]] < scores[-1]):
            some = order[at:at + step]
            ids = np.concatenate([ids, rows["id"][some]])
            scores = np.concatenate([scores, (x[some] @ q).astype(np.int64)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            at += step
            step *= 2
        yield i, ids, scores, min(at, len(order))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    id_col: str = "vec_id",
    vector: str = "vector",
    block: int = BLOCK,
    pivots: int = PIVOTS,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each query, exactly.

    Both sides: a long id and an array of longs. Rows without an id, without a vector or
    with a null in it take no part, neither as candidates nor as queries. Returns
    query_id, rank (from 1), the id column and score; ties go to the smaller id.

    A query's candidates are the rows with another id and as many components; fewer than
    ``k`` of them give fewer rows, none give none. Equal rows all count as candidates;
    equal query rows give one result. Extra columns are ignored.

    Queries and rows meet in a grid of blocks of about ``block`` rows each, so every task
    holds two blocks, whatever the number of either; each block gives at most k rows per
    query, of which the best are kept.
    """
    spark = vectors.sparkSession
    narrow = [F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector")]
    rows, asked = (df.select(*narrow).filter("id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)") for df in (vectors, queries))
    asked = asked.dropDuplicates()
    found = choose_pivots(rows, "id", "vector", pivots)
    rows = stored(pivot_table(rows, found, "vector"), "pivots")
    asked = stored(pivot_table(asked, found, "vector"), "pivots")
    across, down = (max(1, math.ceil(df.count() / block)) for df in (rows, asked))

    def dealt(df, own, other, mine, theirs):
        """Rows of ``df`` dealt evenly to ``mine`` blocks, each repeated for every block of the other side."""
        place = F.pmod(F.monotonically_increasing_id(), F.lit(mine)).cast("int").alias(own)
        return df.select("*", place).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(theirs - 1))))

    left, right = dealt(asked, "qb", "rb", down, across), dealt(rows, "rb", "qb", across, down)

    def search(asked: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "id": [], "score": []}
        sizes = {}
        for name, t in (("asked", asked), ("rows", rows)):
            t = t.combine_chunks()
            lengths = np.asarray(t["vector"].combine_chunks().value_lengths() if t.num_rows else [], int)
            for size in np.unique(lengths):
                some = t.take(pa.array(np.flatnonzero(lengths == size)))
                far = some["to_pivots"].combine_chunks()
                sizes.setdefault(size, {})[name] = {
                    "id": np.asarray(some["id"]),
                    "vectors": np.asarray(some["vector"].combine_chunks().flatten(), np.int64).reshape(some.num_rows, size),
                    "to_pivots": np.asarray(far.flatten(), float).reshape(some.num_rows, -1) if not far.null_count else np.zeros((some.num_rows, 0)),
                }
        for both in sizes.values():
            if len(both) == 2:
                for i, ids, scores, _ in search_block(both["asked"], both["rows"], k):
                    out["query_id"].append(np.full(len(ids), both["asked"]["id"][i]))
                    out["id"].append(ids)
                    out["score"].append(scores)
        return pa.table({c: pa.array(np.concatenate([np.zeros(0, np.int64), *v])) for c, v in out.items()})

    best = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(search, "query_id bigint, id bigint, score bigint")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
