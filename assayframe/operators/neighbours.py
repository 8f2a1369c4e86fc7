"""Nearest neighbours without comparing everything with everything.

Two exact ways, both over distinct feature values with how many queries (``asked``) and
training rows (``known``) have them:

``cell_neighbours`` parts the training values around pivots. A value's distance to its
pivot and the triangle inequality bound its distance to a query from below, so a query
is only sent to regions that can still hold one of its k nearest.

``index_neighbours`` is for sets of tokens. Sets that are similar share rare tokens; how
many of a query's rarest tokens have to be looked up follows from the similarity of its
own k-th neighbour, which is better known from round to round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions.fingerprint import common_tokens
from assayframe.operators.blocks import TOKEN_CHUNK, coded_tokens, tanimoto_matrix
from assayframe.operators.postings import SHARD_ROWS, nearest_sets, set_blocks
from assayframe.operators.similarity import rarest_first
from assayframe.runtime import cut_lineage

# Most pivots, and training values they are picked from for each of them: both come to
# the driver, so their number is fixed.
PIVOTS, SAMPLE_PER_PIVOT = 4096, 4
# Most rings of equal width that the values of a pivot are parted into.
RINGS = 16
# Queries that a task holds at most, and numbers of the features of queries and of training
# rows. A query is shipped once for each of the homes that blocks are put together in, a
# row once for each chunk of queries.
QUERIES_PER_TASK, TASK_NUMBERS = 1 << 15, 1 << 21
# Tasks for each core, and most of them.
TASKS_PER_CORE, MOST_TASKS = 8, 20_000
# Queries compared with a block at once.
QUERY_PIECE = 1024
# Numbers of a matrix that is worked on at once.
MATRIX = 1 << 22


def nearest_k(reached: DataFrame, k: int) -> DataFrame:
    """(rep, found, distances): the k least of (rep, distance, n), where n rows are that far.

    A row is repeated k times at most; what cannot be among the k is dropped before the
    shuffle. ``found`` is less than k where rows are missing.
    """
    single = reached.select("rep", F.explode(F.array_repeat("distance", F.least("n", F.lit(k)).cast("int"))).alias("distance"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("distance"))
    taken = single.withColumn("place", place).filter(F.col("place") <= k)
    return taken.groupBy("rep").agg(F.count(F.lit(1)).cast("int").alias("found"), F.sort_array(F.collect_list("distance")).alias("distances"))


# --- metric cells -----------------------------------------------------------------------


class Space:
    """Distances of a metric space: vectors as matrices, token sets as lists of arrays.

    The cosine distance is no metric. Its bounds come from the Euclidean distance c of
    unit vectors: the distance is at least the smaller of c * c / 2 and 1, whatever the
    small term in the denominator does, and for zero vectors too.
    """

    def __init__(self, metric: str):
        self.metric = metric

    def features(self, column: pa.Array):
        """The rows of a list column."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        flat, lengths = np.asarray(column.flatten()), np.asarray(column.value_lengths(), np.int64)
        if self.metric == "jaccard":
            return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []
        if len(set(lengths.tolist())) > 1:
            raise ValueError("vectors differ in length")
        return flat.astype(np.float64).reshape(len(lengths), -1)

    def placed(self, rows):
        """Rows as points of the space that bounds are taken in."""
        if self.metric != "cosine":
            return rows
        length = np.linalg.norm(rows, axis=1)[:, None]
        return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)

    def between(self, a, b) -> np.ndarray:
        """Distances in that space, up to :meth:`slack`."""
        if self.metric == "jaccard":
            return 1 - tanimoto_matrix(a, b)
        if self.metric == "manhattan":
            return _manhattan(a, b)
        return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T), 0))

    def size(self, rows) -> np.ndarray:
        """How large numbers are that are rounded."""
        if self.metric == "jaccard":
            return np.ones(len(rows))
        return np.abs(rows).sum(1) if self.metric == "manhattan" else np.linalg.norm(rows, axis=1)

    def slack(self, size: np.ndarray | float) -> np.ndarray | float:
        """Bounds are lowered by this, so that rounding hides no neighbour."""
        return 1e-6 * size if self.metric in ("euclidean", "cosine") else 1e-9 * size

    def least(self, bound: np.ndarray) -> np.ndarray:
        """The least distance of points that are ``bound`` apart in the space."""
        return np.minimum(bound**2 / 2, 1.0) if self.metric == "cosine" else bound

    def measure(self, asked, rows) -> tuple[Callable, Callable]:
        """(about, exact): distances of some queries and rows, the first with room for rounding.

        ``about(i, j)`` gives a matrix, and what its numbers may be off by; ``exact(i, j)``
        the distances of pairs, or None where those of the matrix are exact.
        """
        if self.metric == "jaccard":
            both = _narrow(asked, rows)
            sizes = [np.array([len(x) for x in side], dtype=np.float64) for side in (asked, rows)]

            def jaccard(i, j):
                if both is None:
                    return 1 - tanimoto_matrix([asked[x] for x in i], [rows[x] for x in j]), 0.0
                shared = (both[0][i] @ both[1][j].T).astype(np.float64)
                union = sizes[0][i][:, None] + sizes[1][j][None, :]
                union -= shared
                near = np.divide(shared, union, out=np.ones_like(shared), where=union > 0)
                return np.subtract(1, near, out=near), 0.0

            return jaccard, None
        if self.metric == "manhattan":
            return (lambda i, j: (_manhattan(asked[i], rows[j]), 0.0)), None
        lengths = [np.linalg.norm(side, axis=1) for side in (asked, rows)]
        if self.metric == "cosine":

            def cosine(i, j):
                product = lengths[0][i][:, None] * lengths[1][j][None, :]
                return 1 - (asked[i] @ rows[j].T) / (product + 1e-9), 0.0  # fixed value: the small term of the metric

            return cosine, None
        squares = [(side**2).sum(1) for side in (asked, rows)]

        def euclidean(i, j):
            near = asked[i] @ rows[j].T
            near *= -2
            near += squares[0][i][:, None]
            near += squares[1][j][None, :]
            np.sqrt(np.maximum(near, 0, out=near), out=near)
            return near, 2 * self.slack(lengths[0][i][:, None] + lengths[1][j].max())

        def pairs(i, j):
            # the few that are left are measured without cancellation
            return np.concatenate([np.sqrt(((asked[i[s]] - rows[j[s]]) ** 2).sum(1)) for s in _slices(len(i), asked.shape[1])] or [np.zeros(0)])

        return euclidean, pairs

    def nearest(self, asked, rows, known: np.ndarray, reach: np.ndarray, sent: np.ndarray, block: np.ndarray, k: int) -> np.ndarray:
        """The k least distances of each query, copies counted, in the blocks it was ``sent`` to.

        ``reach`` is a distance within which a query's k-th is known to be. What is as far
        as the k-th so far is left out; missing places are infinite.
        """
        best = np.full((len(reach), k), np.inf)
        about, exact = self.measure(asked, rows)
        for b in np.unique(block):
            to, j = np.flatnonzero(sent[:, b]), np.flatnonzero(block == b)
            times = np.minimum(known[j], k)
            for start in range(0, len(to), QUERY_PIECE):
                i = to[start:start + QUERY_PIECE]
                near, room = about(i, j)
                limit = np.minimum(best[i, -1], reach[i])[:, None]
                if np.isinf(limit).any():
                    # k different values are enough even if each occurs once
                    width = min(k, len(j))
                    limit = np.minimum(limit, np.partition(near, width - 1, axis=1)[:, width - 1:width] + room) if width == k else limit
                u, v = np.nonzero(near <= limit + room)
                if not len(u):
                    continue
                d = exact(i[u], j[v]) if exact else near[u, v]
                best[i] = _merged(best[i], u, d, times[v], k)
        return best


def _merged(best: np.ndarray, row: np.ndarray, d: np.ndarray, times: np.ndarray, k: int) -> np.ndarray:
    """``best`` (k ascending distances of each row) with more distances, each so many times."""
    row, d = np.repeat(row, times), np.repeat(d, times)
    order = np.lexsort((d, row))
    row, d = row[order], d[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < k
    more = np.full(best.shape, np.inf)
    more[row[kept], place[kept]] = d[kept]
    changed = np.isfinite(more[:, 0])
    best[changed] = np.sort(np.concatenate([best[changed], more[changed]], axis=1), axis=1)[:, :k]
    return best


def _narrow(asked, rows) -> tuple[np.ndarray, np.ndarray] | None:
    """Both sides as matrices of the tokens they share, if these are few."""
    vocabulary = np.intersect1d(*[np.unique(np.concatenate(side)) if len(side) else np.zeros(0, np.int64) for side in (asked, rows)])
    return None if len(vocabulary) > TOKEN_CHUNK else (coded_tokens(asked, vocabulary), coded_tokens(rows, vocabulary))


def _slices(n: int, width: int) -> Iterator[slice]:
    step = max(1, MATRIX // max(1, width))
    return (slice(s, s + step) for s in range(0, n, step))


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        total += np.abs(x[:, None] - y[None, :])
    return total


def choose_pivots(known: DataFrame, space: Space, n: int):
    """``n`` training values far apart, each the farthest from those before, from a bounded sample.

    They decide how much is compared, never the result. ``rep`` is a digest, so its
    order is as good as random and the same in every run.
    """
    sample = known.select("rep", "tokens").orderBy("rep").limit(n * SAMPLE_PER_PIVOT).toArrow()
    points = space.placed(space.features(sample["tokens"]))
    pick = (lambda at: [points[i] for i in at]) if space.metric == "jaccard" else (lambda at: points[at])
    picked = [0]
    near = space.between(points, pick([0]))[:, 0]
    while len(picked) < n and near.max(initial=0) > 0:
        picked.append(int(np.argmax(near)))
        near = np.minimum(near, space.between(points, pick(picked[-1:]))[:, 0])
    return pick(picked)


@dataclass
class Regions:
    """Rings around pivots: their pivot, least and largest distance to it, rows, and blocks.

    ``per_home`` blocks that follow each other are a home.
    """

    pivots: object
    pivot: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    size: float
    per_home: int


def build_regions(known: DataFrame, space: Space, k: int, rows_per_block: int, n_pivots: int, rows_per_home: int | None = None) -> tuple[DataFrame, Regions]:
    """The training values with their home and block in it, and the regions, at most PIVOTS * RINGS of them.

    A region of more than ``rows_per_block`` values is dealt to several blocks by a hash.
    Blocks are put together in homes of about ``rows_per_home`` values; without it, each is one.
    """
    spark = known.sparkSession
    pivots = choose_pivots(known, space, n_pivots)
    shared = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = space.placed(space.features(batch.column("tokens")))
            cell, d = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for s in _slices(len(batch), len(shared.value)):
                far = space.between(points[s], shared.value)
                cell[s] = far.argmin(1) if len(far) else 0
                d[s] = far.min(1, initial=np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(d), pa.array(space.size(points))], names=[*batch.schema.names, "cell", "d", "size"])

    kind = known.schema["tokens"].dataType.simpleString()
    placed = cut_lineage(known.select("rep", "tokens", F.col("known").cast("long").alias("known")).mapInArrow(place, f"rep string, tokens {kind}, known long, cell int, d double, size double"))
    # one row per pivot
    extent = placed.groupBy("cell").agg(F.least(F.ceil(F.count(F.lit(1)) / rows_per_block), F.lit(RINGS)).alias("rings"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    width = F.col("hi") - F.col("lo")
    ring = F.when(width > 0, F.least(F.floor((F.col("d") - F.col("lo")) / width * F.col("rings")), F.col("rings") - 1)).otherwise(0).cast("int")
    ringed = placed.join(F.broadcast(extent), "cell").withColumn("ring", ring).drop("rings", "lo", "hi")
    found = ringed.groupBy("cell", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.least("known", F.lit(k))).alias("rows"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.max("size").alias("size")
    ).orderBy("cell", "ring").collect()
    parts = np.array([ceil(r.n / rows_per_block) for r in found])
    first = np.cumsum(parts) - parts
    numbers = lambda name: np.array([r[name] for r in found])
    per_home = max(1, int((rows_per_home or 0) * parts.sum() // max(1, numbers("n").sum())))
    regions = Regions(pivots, numbers("cell"), numbers("lo"), numbers("hi"), numbers("rows"), first, parts, max((r["size"] for r in found), default=0.0), per_home)
    table = [(r.cell, r.ring, int(f), int(p)) for r, f, p in zip(found, first, parts)]
    blocks = F.broadcast(spark.createDataFrame(table, "cell int, ring int, first int, parts int"))
    dealt = ringed.join(blocks, ["cell", "ring"]).withColumn("block", (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("parts"))).cast("int"))
    home = F.floor(F.col("block") / per_home).cast("int")
    return dealt.select(home.alias("home"), (F.col("block") % per_home).alias("block"), "tokens", "known"), regions


def ship(asked: DataFrame, regions, space: Space, k: int) -> DataFrame:
    """(rep, tokens, chunk, reach, region, regions, home, blocks): every query once for each home it is compared in.

    ``asked`` has ``reach``, the distance of a query's k-th neighbour as far as it is
    known, and ``done``, the regions it was sent to. A query goes to the regions that may
    hold a row as near as that: at first (``done`` is null) only to the nearest that hold
    k rows, then to all others. ``blocks`` has a bit for each block of the home, ``region``
    is that of the first of them; ``regions`` names all of the first time, with one home.
    """
    kind = asked.schema["tokens"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = regions.value
        for batch in batches:
            points = space.placed(space.features(batch.column("tokens")))
            reach = np.asarray(batch.column("reach").fill_null(np.inf), float)
            done = batch.column("done").to_pylist()
            region_of = np.repeat(np.arange(len(at.parts), dtype=np.int32), at.parts)
            for s in _slices(len(batch), len(at.pivot)):
                far = space.between(points[s], at.pivots)[:, at.pivot]
                bound = np.maximum(np.maximum(far - at.hi, at.lo - far), 0)
                bound = space.least(np.maximum(bound - 2 * space.slack(space.size(points[s])[:, None] + at.size), 0))
                order = np.lexsort((far, bound), axis=1)
                filled = np.cumsum(at.rows[order], axis=1) - at.rows[order]
                nearest = np.zeros(bound.shape, bool)
                np.put_along_axis(nearest, order, filled < k, axis=1)
                sent = bound <= reach[s][:, None]
                for i, before in enumerate(done[s]):
                    if before is None:
                        sent[i] &= nearest[i]
                    else:
                        sent[i, before] = False
                named = [np.flatnonzero(row).astype(np.int32) if before is None else None for row, before in zip(sent, done[s])]
                blocks = np.repeat(sent, at.parts, axis=1)
                told = np.zeros(len(sent), bool)
                for home in range(ceil(blocks.shape[1] / at.per_home)):
                    bits = blocks[:, home * at.per_home:(home + 1) * at.per_home]
                    i = np.flatnonzero(bits.any(axis=1))
                    if not len(i):
                        continue
                    rows = batch.select(["rep", "tokens", "chunk", "reach"]).take(pa.array(i + s.start))
                    first = pa.array([None if told[x] else named[x] for x in i], pa.list_(pa.int32()))
                    told[i] = True
                    masks = pa.array([m.tobytes() for m in np.packbits(bits[i], axis=1)], pa.binary())
                    region = pa.array(region_of[home * at.per_home + bits[i].argmax(axis=1)])
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, region, first, pa.array(np.full(len(i), home, np.int32)), masks],
                        names=["rep", "tokens", "chunk", "reach", "region", "regions", "home", "blocks"],
                    )

    schema = f"rep string, tokens {kind}, chunk int, reach double, region int, regions array<int>, home int, blocks binary"
    return asked.select("rep", "tokens", "chunk", "reach", "done").mapInArrow(run, schema)


def _compare(sent: DataFrame, blocks: DataFrame, space: Space, k: int, chunks: int = 1, tasks: int = 1) -> DataFrame:
    """(rep, distance, n): the nearest rows of each home a query was sent to."""
    if chunks == 1:
        rows = blocks.withColumn("to", F.lit(0))
    else:
        # a home goes where queries go, once for each chunk of queries
        sent = cut_lineage(sent)
        needed = sent.select(F.col("home").alias("at"), F.col("chunk").alias("to")).distinct()
        rows = blocks.join(needed, blocks["home"] == needed["at"]).drop("at")

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if asked.num_rows and rows.num_rows:
            queries, others = space.features(asked["tokens"]), space.features(rows["tokens"])
            masks = asked["blocks"].to_pylist()
            to = np.unpackbits(np.frombuffer(b"".join(masks), np.uint8).reshape(len(masks), -1), axis=1).astype(bool)
            reach = np.asarray(asked["reach"].combine_chunks().fill_null(np.inf), float)
            best = space.nearest(queries, others, np.asarray(rows["known"], np.int64), reach, to, np.asarray(rows["block"]), k)
            i, place = np.nonzero(np.isfinite(best))
            d = best[i, place]
        else:
            i, d = np.zeros(0, np.int64), np.zeros(0)
        n = np.ones(len(i), np.int64)
        return pa.table({"rep": asked["rep"].combine_chunks().take(pa.array(i)), "distance": pa.array(d), "n": pa.array(n)})

    # by number, so that small tasks are not put together
    grouped = sent.repartition(tasks, "home", "chunk").groupBy("home", "chunk").cogroup(rows.repartition(tasks, "home", "to").groupBy("home", "to"))
    return grouped.applyInArrow(run, "rep string, distance double, n long")


def cell_neighbours(
    asked: DataFrame, known: DataFrame, metric: str, k: int, rows_per_block: int, pivots: int | None = None, sizes: tuple[int, int] | None = None
) -> DataFrame:
    """(rep, distances) of the k nearest rows of ``known`` for every row of ``asked``, by metric cells.

    ``asked``: rep (a digest), tokens and reach, a distance within which k rows are known
    to be, or null. ``known``: rep, tokens, known. ``sizes``: the rows of ``known`` and
    ``asked``, if they were counted before. Two rounds: the nearest regions that
    hold k rows give a k-th distance, and that tells which other regions a query has to
    be sent to. Each task holds one block of values and one chunk of queries. Where the
    data have no structure all regions have to be visited, and the work is that of
    comparing everything, with a query sent once per home and a row once per chunk.
    """
    space = Space(metric)
    n_known, n_asked = sizes or (known.count(), asked.count())
    widths = [side.agg(F.max(F.size("tokens"))).first()[0] or 1 for side in (known, asked)]
    parallel = TASKS_PER_CORE * known.sparkSession.sparkContext.defaultParallelism
    # no smaller than for a task for each core, no larger than a task can hold
    rows_per_home, queries = (max(rows_per_block, min(TASK_NUMBERS // max(1, width), ceil(n / sqrt(parallel)))) for n, width in zip((n_known, n_asked), widths))
    queries = min(queries, QUERIES_PER_TASK)
    blocks, found = build_regions(known, space, k, rows_per_block, pivots or min(PIVOTS, ceil(n_known / rows_per_block)), rows_per_home)
    regions = known.sparkSession.sparkContext.broadcast(found)
    chunks = max(1, ceil(n_asked / queries))
    tasks = max(1, min(MOST_TASKS, ceil(int(found.parts.sum()) / found.per_home) * chunks))
    asked = asked.select("rep", "tokens", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"), "reach")

    sent = cut_lineage(ship(asked.withColumn("done", F.lit(None).cast("array<int>")), regions, space, k))
    near = cut_lineage(_compare(sent, blocks, space, k, chunks, tasks))
    # at most k regions for each query
    done = sent.filter("regions IS NOT NULL").select("rep", F.col("regions").alias("done"))
    kth = nearest_k(near, k).filter(F.col("found") == k).select("rep", F.element_at("distances", -1).alias("kth"))
    known_so_far = asked.join(done, "rep", "left").join(kth, "rep", "left").withColumns(
        {"done": F.coalesce("done", F.array().cast("array<int>")), "reach": F.least("reach", "kth")}
    )
    later = ship(known_so_far, regions, space, k)
    every = near.unionByName(_compare(later, blocks, space, k, chunks, tasks))
    return nearest_k(every, k).select("rep", "distances")


# --- rare tokens ------------------------------------------------------------------------

def index_neighbours(values: DataFrame, k: int, cutoff, rows_per_block: int, posting_rows: int = SHARD_ROWS) -> DataFrame:
    """(rep, distances) of the k nearest training rows of every asked set, by shared rare tokens.

    ``values``: rep (a digest), tokens, asked, known. Two sets of similarity c or more share
    so many tokens that they still share some if a query's most frequent ones are left out;
    how many can be follows from c and both sizes. Each query has a c of its own: ``cutoff``
    (a Fraction) at first, then, if fewer than k rows are as near, the similarity of its
    k-th row so far. See :func:`postings.nearest_sets`: no candidate is written or shipped.
    ``posting_rows`` bounds the training sets, and so the list of a token, that are held at once.
    """
    blocks = set_blocks(values, values.count(), rows_per_block)
    return nearest_sets(blocks, k, float(1 - cutoff), posting_rows).select("rep", "distances")


def _prefix(n, p, q):
    """Rarest tokens that have to be looked up: ceil in whole numbers."""
    return F.least(n, n - F.floor((n * p + (q - 1)) / q).cast("int") + 1)


def _sharing(q_side: DataFrame, ranked: DataFrame, train: DataFrame, p: int, q: int) -> DataFrame:
    """(rep, n, common, total): training sets that share a token in the prefixes of each query's cutoff.

    ``q_side``: the prefixes of the queries (x, nx, p, q, px, t). No cutoff is below p/q.
    """
    t_side = train.select(
        F.col("rep").alias("y"), F.col("size").alias("ny"), F.posexplode(F.slice("ranked", F.lit(1), _prefix(F.col("size"), F.lit(p), F.lit(q)))).alias("py", "u")
    )
    nx, ny = F.col("nx"), F.col("ny")
    near = (nx * F.col("p") <= ny * F.col("q")) & (ny * F.col("p") <= nx * F.col("q"))
    # if this is the first token shared in the order, those from here on must be enough
    enough = F.least(nx - F.col("px"), ny - F.col("py")) * (F.col("p") + F.col("q")) >= (nx + ny) * F.col("p")
    # Of the prefix that ends earlier in the order of tokens, what is not shared within both
    # prefixes is behind it: so most pairs that share a token by chance are told apart by a count.
    rest = F.greatest(nx - _prefix(nx, F.col("p"), F.col("q")), ny - _prefix(ny, F.lit(p), F.lit(q)))
    # least tokens that both must have, less the rest
    needed = F.ceil((nx + ny) * F.col("p") / (F.col("p") + F.col("q")) - 1e-6) - rest
    met = q_side.join(t_side, (F.col("t") == F.col("u")) & (F.col("x") != F.col("y")) & near).select("x", "y", needed.alias("needed"), enough.alias("enough"))
    pairs = met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"), F.max("needed").alias("needed"), F.bool_or("enough").alias("enough"))
    pairs = pairs.filter("enough AND shared >= needed").select("x", "y")
    # Candidates meet the token arrays only now, once per pair.
    side_x = ranked.select(F.col("rep").alias("x"), F.col("tokens").alias("a"))
    side_y = train.select(F.col("rep").alias("y"), F.col("tokens").alias("b"), F.col("known").alias("n"))
    met = pairs.join(side_x, "x").join(side_y, "y").select(
        F.col("x").alias("rep"), "n", common_tokens(F.col("a"), F.col("b")).cast("long").alias("common"), (F.size("a") + F.size("b")).cast("long").alias("sizes")
    )
    return met.select("rep", "n", "common", (F.col("sizes") - F.col("common")).alias("total"))
