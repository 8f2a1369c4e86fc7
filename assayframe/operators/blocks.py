"""Work on all pairs of rows in bounded tiles.

Rows are hashed into blocks of about ``rows_per_block``; one task gets one pair
of blocks and returns a reduction over its pairs or the few pairs that qualify.
No table of all pairs is ever built, and since blocks come from a hash of the
unique key, a frequent value cannot make one of them large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.fingerprint import text_hash

ROWS_PER_BLOCK = 1024
# Tokens multiplied together when two blocks are intersected.
TOKEN_CHUNK = 512
# Pairs of rows from which on a token is multiplied and not counted.
DENSE_FROM = 2000
# Pairs of rows counted together.
PAIR_CHUNK = 4_000_000
# Numbers (components or tokens) of one side of a tile. A row is shipped once for every
# block, so blocks are as large as a task can hold and are compared piece by piece there.
TILE_NUMBERS = 1 << 21
# Tiles for each core, most tasks, and rows of the pieces: their matrix stays in the cache.
TILES_PER_CORE = 8
MOST_TASKS = 20_000
PIECE_ROWS, PIECE_COLUMNS = 256, 1024
# Below this share of both squared lengths a squared distance is measured without cancellation.
CANCELLED = 1e-5


def tile_blocks(df: DataFrame, column: str, rows_per_block: int) -> int:
    """Blocks for all pairs of the rows of ``df``: no more than their size and the cores ask for.

    ``column`` holds the arrays that are compared; the longest tells how many rows a task
    can hold. Blocks have at least ``rows_per_block`` rows.
    """
    n, width = df.agg(F.count(F.lit(1)), F.max(F.size(column))).first()
    tiles = TILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    rows = min(TILE_NUMBERS // max(1, width or 1), ceil(n / max(1.0, sqrt(2 * tiles))))
    return block_count(n, max(rows_per_block, rows))


def pieces(n_rows: int, n_columns: int, same: bool) -> Iterator[tuple[slice, slice]]:
    """The matrix of a tile in small parts; of a block with itself those on and above the diagonal."""
    columns = PIECE_ROWS if same else PIECE_COLUMNS
    for i in range(0, n_rows, PIECE_ROWS):
        for j in range(i if same else 0, n_columns, columns):
            yield slice(i, min(i + PIECE_ROWS, n_rows)), slice(j, min(j + columns, n_columns))


def block_count(n_rows: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    return max(1, ceil(n_rows / rows_per_block))


def block_of(key: Column, n_blocks: int) -> Column:
    return F.pmod(text_hash(key.cast("string")), F.lit(n_blocks)).cast("int")


def to_tiles(df: DataFrame, part: Column, n_parts: Column, *extra: str) -> DataFrame:
    """Repeat every row for each unordered pair of parts that its part is in."""
    placed = df.withColumn("__part", part).withColumn("__other", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    return placed.withColumn("__lo", F.least("__part", "__other")).withColumn(
        "__hi", F.greatest("__part", "__other")
    ).drop("__other")


def over_block_pairs(
    df: DataFrame,
    key: str,
    n_blocks: int,
    work: Callable[[pd.DataFrame, pd.DataFrame, bool], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Run ``work(left, right, same_block)`` for every unordered pair of blocks."""
    tiles = to_tiles(df, block_of(F.col(key), n_blocks), F.lit(n_blocks))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = tile_sides(pdf, key)
        return work(left, right, same)

    # by number, so that small tiles are not put together in few tasks
    n_tiles = min(MOST_TASKS, n_blocks * (n_blocks + 1) // 2)
    return tiles.repartition(n_tiles, "__lo", "__hi").groupBy("__lo", "__hi").applyInPandas(run, schema)


def tile_sides(pdf: pd.DataFrame, key: str) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The two parts of a tile; both are the same rows on the diagonal."""
    same = pdf["__lo"].iat[0] == pdf["__hi"].iat[0]
    pdf = pdf.sort_values(key, ignore_index=True)
    if same:
        return pdf, pdf, True
    is_low = (pdf["__part"] == pdf["__lo"]).to_numpy()
    return pdf[is_low].reset_index(drop=True), pdf[~is_low].reset_index(drop=True), False


def shared_tokens(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> np.ndarray:
    """Number of shared tokens for every row of ``a`` with every row of ``b``.

    Only tokens present on both sides matter. Frequent ones are multiplied as
    dense matrices, in chunks; for rare ones the few pairs of rows are counted.
    """
    result = np.zeros((len(a), len(b)), dtype=np.float32)
    if not len(a) or not len(b):
        return result
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    vocabulary = np.intersect1d(flat_a, flat_b)
    if not len(vocabulary):
        return result
    code_a, row_a = _coded(flat_a, a, vocabulary)
    code_b, row_b = _coded(flat_b, b, vocabulary)
    times_a = np.bincount(code_a, minlength=len(vocabulary))
    times_b = np.bincount(code_b, minlength=len(vocabulary))
    frequent = times_a * times_b > DENSE_FROM

    place = np.cumsum(frequent) - 1
    in_a, in_b = frequent[code_a], frequent[code_b]
    cols_a, rows_a = place[code_a[in_a]], row_a[in_a]
    cols_b, rows_b = place[code_b[in_b]], row_b[in_b]
    for start in range(0, int(frequent.sum()), TOKEN_CHUNK):
        result += _dense(cols_a, rows_a, len(a), start) @ _dense(cols_b, rows_b, len(b), start).T

    # each rare token of a row of ``a`` meets the rows of ``b`` that have it
    rare_code, rare_row = code_a[~in_a], row_a[~in_a]
    first_b = np.cumsum(times_b) - times_b
    meets = times_b[rare_code]
    ends = np.cumsum(meets)
    start = 0
    while start < len(rare_code):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIR_CHUNK, side="right")))
        n = meets[start:stop]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        other = row_b[np.repeat(first_b[rare_code[start:stop]], n) + within]
        cell = np.repeat(rare_row[start:stop], n) * len(b) + other
        result += np.bincount(cell, minlength=result.size).reshape(result.shape)
        start = stop
    return result


def _coded(flat: np.ndarray, rows: Sequence[np.ndarray], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary positions and row numbers of the known tokens, by position."""
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    code = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
    known = vocabulary[code] == flat
    code, row = code[known], row[known]
    order = np.argsort(code, kind="stable")
    return code[order], row[order]


def _dense(cols: np.ndarray, rows: np.ndarray, n_rows: int, start: int) -> np.ndarray:
    # ``cols`` ascend
    lo, hi = np.searchsorted(cols, [start, start + TOKEN_CHUNK])
    matrix = np.zeros((n_rows, TOKEN_CHUNK), dtype=np.float32)
    matrix[rows[lo:hi], cols[lo:hi] - start] = 1.0
    return matrix


def token_lists(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, lengths = np.asarray(column.flatten()), np.asarray(column.value_lengths(), np.int64)
    return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []


def tanimoto_matrix(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> np.ndarray:
    shared = shared_tokens(a, b).astype(np.float64)
    sizes_a = np.array([len(x) for x in a], dtype=np.float64)
    sizes_b = np.array([len(x) for x in b], dtype=np.float64)
    union = sizes_a[:, None] + sizes_b[None, :] - shared
    return np.divide(shared, union, out=np.ones_like(shared), where=union > 0)


def vector_matrix(a: np.ndarray, b: np.ndarray, metric: str, normalize: bool) -> np.ndarray:
    """Distances between all rows of two matrices, NaN where undefined."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if metric == "euclidean":
            d = np.empty((len(a), len(b)))
            for i, row in enumerate(a):
                d[i] = np.sqrt(((b - row) ** 2).sum(axis=1))
            if normalize:
                product = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
                d = np.where(product > 0, d / product, np.nan)
        elif metric == "manhattan":
            d = np.empty((len(a), len(b)))
            for i, row in enumerate(a):
                d[i] = np.abs(b - row).sum(axis=1)
            if normalize:
                total = np.abs(a).sum(axis=1)[:, None] + np.abs(b).sum(axis=1)[None, :]
                d = np.where(total > 0, d / total, np.nan)
        else:
            product = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
            d = 1 - (a @ b.T) / (product + 1e-9)
    return d


def euclidean_sum(a: np.ndarray, b: np.ndarray, normalize: bool, same: bool) -> float:
    """The sum of the Euclidean distances of the rows of two matrices, NaN if one is undefined.

    With ``same``, of the unordered pairs of one matrix. Squares come from a product of
    matrices; where it cancels too much, the few distances are measured one by one.
    """
    square_a, square_b = (a**2).sum(axis=1), (b**2).sum(axis=1)
    if not (np.isfinite(square_a).all() and np.isfinite(square_b).all()):
        total = 0.0
        for i, j in pieces(len(a), len(b), same):
            d = vector_matrix(a[i], b[j], "euclidean", normalize)
            total += float(d[np.triu_indices(len(d), k=1)].sum() if same and i == j else d.sum())
        return total
    with np.errstate(divide="ignore", invalid="ignore"):
        weight_a, weight_b = ((np.where(x > 0, 1 / np.sqrt(x), np.nan) if normalize else np.ones(len(x))) for x in (square_a, square_b))
    total = 0.0
    for i, j in pieces(len(a), len(b), same):
        sizes = square_a[i][:, None] + square_b[j][None, :]
        d = a[i] @ b[j].T
        d *= -2
        d += sizes
        sizes *= CANCELLED
        x, y = np.nonzero(d < sizes)
        np.sqrt(np.maximum(d, 0, out=d), out=d)
        for s in range(0, len(x), PIECE_ROWS * PIECE_COLUMNS // 8):
            u, v = x[s:s + PIECE_ROWS * PIECE_COLUMNS // 8], y[s:s + PIECE_ROWS * PIECE_COLUMNS // 8]
            d[u, v] = np.sqrt(((a[i][u] - b[j][v]) ** 2).sum(axis=1))
        if same and i == j:
            if len(d) < 2:
                continue
            d = np.triu(d, k=1)
        total += float(weight_a[i] @ d @ weight_b[j])
    return total


def distance_sum(a: np.ndarray, b: np.ndarray, metric: str | Callable, normalize: bool, same: bool) -> float:
    """The sum of :func:`vector_matrix`, or of a function of two matrices, of unordered pairs with ``same``, in small pieces."""
    if metric == "euclidean":
        return euclidean_sum(a, b, normalize, same)
    total = 0.0
    for i, j in pieces(len(a), len(b), same):
        d = metric(a[i], b[j]) if callable(metric) else vector_matrix(a[i], b[j], metric, normalize)
        total += float(d[np.triu_indices(len(d), k=1)].sum() if same and i == j else d.sum())
    return total


def shared_pieces(a: Sequence[np.ndarray], b: Sequence[np.ndarray], same: bool) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """:func:`shared_tokens` of two blocks in small pieces; few different tokens are coded once."""
    tokens = [np.unique(np.concatenate(x)) if len(x) else np.zeros(0, np.int64) for x in (a, b)]
    vocabulary = np.intersect1d(*tokens)
    if len(vocabulary) > TOKEN_CHUNK:
        for i, j in pieces(len(a), len(b), same):
            yield i, j, shared_tokens(a[i], b[j])
        return

    left = coded_tokens(a, vocabulary)
    right = left if same else coded_tokens(b, vocabulary)
    for i, j in pieces(len(a), len(b), same):
        yield i, j, left[i] @ right[j].T


def coded_tokens(rows: Sequence[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """Rows as a matrix of zeros and ones, a column for each token of ``vocabulary``."""
    matrix = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    if len(vocabulary) and len(rows):
        code, row = _coded(np.concatenate(rows), rows, vocabulary)
        matrix[row, code] = 1.0
    return matrix
