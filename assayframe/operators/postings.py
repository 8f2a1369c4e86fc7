"""Nearest token sets, found tile by tile without a table of candidates.

Distinct sets lie in blocks, which are written once. The training sets of some blocks are a
bundle: shards of sets of about one size, as lists of the sets that have a token. A task
holds a block of queries and reads one bundle, shard by shard. A row near enough to be
among a query's k nearest shares so many tokens with it that some of the query's most
frequent ones need not be looked up; what else has enough of the others is counted in full.
What leaves a task are k distances for each query of its block, as one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.operators.prefixes import _WIDE, DIRECT, _listed, _pieces, _ranges
from assayframe.runtime import cut_lineage

# Rows and tokens of a block, tokens of a shard and of a bundle. A set of a shard has a
# number of 16 bits.
LEAST_ROWS, MOST_ROWS, BLOCK_TOKENS = 1 << 8, 1 << 13, 1 << 21
SHARD_ROWS, SHARD_TOKENS, BUNDLE_TOKENS = (1 << 16) - 1, 1 << 22, 1 << 23
# Tiles for each core, and most tasks that they are dealt to.
TILES_PER_CORE, MOST_TASKS = 4, 20_000
# Tokens met and cells of queries by rows that are counted at once.
MET_PIECE, CELL_PIECE = 1 << 18, 1 << 18
# How frequent tokens are is told from so many training sets of a partition, in a table of
# this size. It decides which tokens are looked up, and so how much is compared, never the result.
RANKED_ROWS, RANK_SLOTS = 1 << 10, 1 << 17
# Of the tokens that a near row must share, so many are left out of the lookup.
LEFT_OUT = 0.4
# Bytes of bounds that every task may hold.
SMALL_BYTES = 1 << 26
# Similarities are lowered by this share before they bound anything.
ROUNDING = 1e-9

BLOCK = "part int, n_asked long, n_known long, most long, sets_asked long, sets_known long, known_tokens long, empty_known long, rep array<string>, size binary, asked binary, known binary, wide boolean, words binary, code binary"
SHARD = "size binary, known binary, wide boolean, words binary, times binary, owner binary"


def _array(row: pa.RecordBatch, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(row.column(column)[0].as_buffer(), kind)


def _sets(row: pa.RecordBatch, mine: np.ndarray) -> np.ndarray:
    """The tokens of the chosen sets of a block."""
    words, code = _words(row), _array(row, "code", "<u4")[np.repeat(mine, _array(row, "size", "<i4"))]
    return words[code] if len(words) else code.astype(np.int64)


def _words(row: pa.RecordBatch, prefix: str = "") -> np.ndarray:
    """The different tokens in ascending order, as they were stored."""
    return _array(row, f"{prefix}words", _WIDE[row.column(f"{prefix}wide")[0].as_py()]).astype(np.int64)


def _stored(tokens: np.ndarray) -> tuple[bool, bytes]:
    wide = bool(len(tokens)) and bool(tokens.min() < 0 or tokens.max() >= 1 << 32)
    return wide, tokens.astype(_WIDE[wide]).tobytes()


def _row(values: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = [v if isinstance(v, pa.Array) else pa.array([v], kinds[kind]) for v, (_, kind) in zip(values, fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def token_ranks(known: DataFrame) -> np.ndarray:
    """How frequent the tokens of each slot are, from the first sets of every partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(RANK_SLOTS, np.int64), 0
        for batch in batches:
            part = batch.column("tokens")[:RANKED_ROWS - rows]
            total += np.bincount(np.asarray(part.flatten()).astype(np.int64) % RANK_SLOTS, minlength=RANK_SLOTS)
            rows += len(part)
            if rows >= RANKED_ROWS:
                break
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "n"])

    # at most a row for each slot
    found = known.select("tokens").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    ranks = np.zeros(RANK_SLOTS, np.int64)
    ranks[np.asarray(found["slot"], np.int64)] = np.asarray(found["n"], np.int64)
    return ranks


def _block(batches: list[pa.RecordBatch], ranks: np.ndarray) -> pa.RecordBatch:
    """Rows in the order of ``rep`` as one row: each set once, the smallest sets first, tokens rarest first."""
    rows = pa.Table.from_batches(batches)
    rep = rows["rep"].combine_chunks()
    names = rep.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    asked, known = (np.add.reduceat(np.asarray(rows[c].combine_chunks()).astype(np.int64), first) for c in ("asked", "known"))
    column = rows["tokens"].combine_chunks().take(pa.array(first))
    flat, size = np.asarray(column.flatten()).astype(np.int64), np.asarray(column.value_lengths(), np.int64)
    order = np.argsort(size, kind="stable")
    flat = flat[_ranges((np.cumsum(size) - size)[order], size[order])]
    size = size[order]
    flat = flat[np.lexsort((ranks[flat % RANK_SLOTS], np.repeat(np.arange(len(size)), size)))]
    rep, asked, known = rep.take(pa.array(first[order])), asked[order], known[order]
    if not len(flat) or flat.min() >= 0 and flat.max() < DIRECT:
        words, code = np.zeros(0, np.int64), flat
    else:
        words, code = np.unique(flat, return_inverse=True)
    counts = [asked.sum(), known.sum(), asked.max(), (asked > 0).sum(), (known > 0).sum(), size[known > 0].sum(), known[size == 0].sum()]
    part = rows["__part"][0].as_py()
    arrays = (size.astype("<i4"), asked.astype("<i8"), known.astype("<i8"))
    return _row([part, *map(int, counts), _listed(rep), *(x.tobytes() for x in arrays), *_stored(words), code.astype("<u4").tobytes()], BLOCK)


def _packed(ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in the order of part and ``rep``, packed in blocks; rows of one ``rep`` stay together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, now = [], 0, None
        for batch in batches:
            part, rep = np.asarray(batch.column("__part")), batch.column("rep").to_numpy(zero_copy_only=False)
            size = np.asarray(batch.column("tokens").value_lengths(), np.int64)
            start = 0
            for i in range(len(batch)):
                here = part[i], rep[i]
                if now is not None and (here[0] != now[0] or (held >= BLOCK_TOKENS and here[1] != now[1])):
                    if i > start:
                        waiting.append(batch.slice(start, i - start))
                    yield _block(waiting, ranks.value)
                    waiting, held, start = [], 0, i
                now, held = here, held + size[i]
            if len(batch) > start:
                waiting.append(batch.slice(start))
        if waiting:
            yield _block(waiting, ranks.value)

    return run


def set_blocks(rows: DataFrame, n_rows: int, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The distinct sets of ``rows`` (rep, tokens, asked, known) in blocks, written once.

    ``rep`` names a set; ``asked`` and ``known`` are summed up over the rows it stands in.
    A row goes to its block alone. ``n_rows`` is about how many there are, ``least_rows`` how many a block has at least.
    """
    context = rows.sparkSession.sparkContext
    ranks = context.broadcast(token_ranks(rows.filter("known > 0")))
    per_part = min(MOST_ROWS, max(least_rows, ceil(n_rows / (TILES_PER_CORE * int(context.defaultParallelism)))))
    n_parts = max(1, min(MOST_TASKS, ceil(n_rows / per_part)))
    placed = rows.select("rep", "tokens", "asked", "known", F.pmod(F.xxhash64("rep"), F.lit(n_parts)).cast("int").alias("__part"))
    dealt = placed.repartitionById(n_parts, F.col("__part")).sortWithinPartitions("__part", "rep")
    return cut_lineage(dealt.mapInArrow(_packed(ranks), BLOCK))


def _shards(held: list[tuple], most_rows: int) -> Iterator[pa.RecordBatch]:
    """Training sets as shards of sets of about one size."""
    size, known, flat = (np.concatenate(x) for x in zip(*held))
    start, order = np.cumsum(size) - size, np.argsort(size, kind="stable")
    for piece in _pieces(np.maximum(size[order], ceil(SHARD_TOKENS / most_rows)), SHARD_TOKENS):
        rows = order[piece]
        tokens = flat[_ranges(start[rows], size[rows])]
        by_token = np.argsort(tokens, kind="stable")
        owner = np.repeat(np.arange(len(rows)), size[rows])[by_token].astype("<u2")
        words, times = np.unique(tokens, return_counts=True)
        yield _row([size[rows].astype("<i4").tobytes(), known[rows].astype("<i8").tobytes(), *_stored(words), times.astype("<u2").tobytes(), owner.tobytes()], SHARD)


def _bundle(most_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                size, known = _array(row, "size", "<i4").astype(np.int64), _array(row, "known", "<i8")
                # an empty set shares nothing: what is near it is known without a lookup
                mine = (known > 0) & (size > 0)
                if mine.any():
                    held.append((size[mine], known[mine], _sets(row, mine)))
                    n += int(size[mine].sum())
                if n >= BUNDLE_TOKENS:
                    yield from _shards(held, most_rows)
                    held, n = [], 0
        if held:
            yield from _shards(held, most_rows)

    return run


def _places(words: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where the tokens that codes stand for are in ``words``, -1 if they are not; both ascend.

    Without ``asked`` codes are the tokens themselves, below DIRECT.
    """
    if not len(asked):
        table = np.full(DIRECT, -1, np.int64)
        direct = words[np.searchsorted(words, 0):np.searchsorted(words, DIRECT)]
        table[direct] = np.arange(len(direct)) + np.searchsorted(words, 0)
        return table
    at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
    return np.where(words[at] == asked, at, -1)


class Queries:
    """The queries of a block that are still open, with the least distances found for them here.

    ``limit``: a distance within which the k-th of each is known to be; only what is nearer
    is looked for.
    """

    def __init__(self, size: np.ndarray, words: np.ndarray, code: np.ndarray, limit: np.ndarray, k: int):
        self.size, self.words, self.code, self.limit = size, words, code, limit
        self.start = np.cumsum(size) - size
        self.best = np.full((len(size), k), np.inf)

    def visit(self, size: np.ndarray, known: np.ndarray, words: np.ndarray, times: np.ndarray, owner: np.ndarray) -> None:
        """Look all queries up in a shard."""
        k = self.best.shape[1]
        low, high = int(size[0]), int(size[-1])
        reach = np.minimum(self.limit, self.best[:, -1])
        near = np.where(np.isfinite(reach), (1 - np.minimum(reach, 1.0)) * (1 - ROUNDING), 0.0)
        # the most similar that a row of these sizes can be
        most = np.minimum(self.size / low, 1.0) * np.minimum(high / self.size, 1.0)
        open_ = np.flatnonzero((most >= near) & (self.size > 0) & (reach > 0))
        if not len(open_):
            return
        # rows near enough share so many tokens: the fewest for the smallest of them
        smallest = np.maximum(low, near * self.size)
        needed = near * (self.size + smallest) / (1 + near)
        out = np.minimum(np.floor(LEFT_OUT * needed * (1 - ROUNDING)).astype(np.int64), self.size - 1)
        enough = np.maximum(np.ceil(needed - out - 1e-6), 1)
        at = _places(words, self.words)
        before = np.cumsum(times) - times
        keys = None
        prefix = self.size[open_] - out[open_]
        tokens = _ranges(self.start[open_], prefix)
        place = at[self.code[tokens]]
        met = np.where(place >= 0, times[place], 0)
        ends = np.cumsum(prefix)
        total = np.concatenate([[0], np.cumsum(met)])
        per_query = total[ends] - total[ends - prefix]
        for piece in _pieces(np.maximum(per_query, len(size)), CELL_PIECE):
            rows = open_[piece]
            here = slice(ends[piece.start] - prefix[piece.start], ends[piece.stop - 1])
            some = met[here] > 0
            cell = np.repeat(np.arange(len(rows)) * len(size), per_query[piece])
            cell += owner[_ranges(before[place[here][some]], met[here][some])]
            counts = np.bincount(cell, minlength=len(rows) * len(size)).reshape(len(rows), len(size))
            free = near[rows] <= 0
            if free.any():
                # nothing is known of these: first tell what the k-th can be
                full = counts[free] / (self.size[rows][free][:, None] + size[None, :] - counts[free])
                kth = np.partition(full, -k, axis=1)[:, -k] if k <= len(size) else np.zeros(len(full))
                asks = np.ones(counts.shape, bool)
                asks[~free] = counts[~free] >= enough[rows][~free][:, None]
                asks[free] = (full >= kth[:, None]) & (counts[free] > 0)
            else:
                asks = counts >= enough[rows][:, None]
            cells = np.flatnonzero(asks)
            if not len(cells):
                continue
            i, j = np.divmod(cells, len(size))
            common, q = counts.ravel()[cells], rows[i]
            if out[rows].any() and keys is None:
                # lists follow each other, and each is in the order of its rows
                keys = np.repeat(np.arange(len(words)) * len(size), times) + owner
            # those that share most come first and tell how near the others have to be
            order = np.lexsort((-common, i))
            j, q, common = j[order], q[order], common[order]
            leading = np.arange(len(q)) - np.searchsorted(q, q) < k
            for part in (leading, ~leading):
                x, y, shared = q[part], j[part], common[part]
                reach = np.minimum(self.limit[x], self.best[x, -1])
                least = np.where(np.isfinite(reach), (1 - reach) * (1 - ROUNDING), 0.0)
                both = self.size[x] + size[y]
                keep = shared + np.minimum(out[x], size[y]) >= least * both / (1 + least) - 1e-6
                x, y, shared, reach, both = x[keep], y[keep], shared[keep], reach[keep], both[keep]
                if out[x].any():
                    shared = shared + self._left_out(x, y, out[x], at, keys, len(size))
                d = 1 - shared / (both - shared)
                keep = d < reach
                if keep.any():
                    self._take(x[keep], d[keep], np.minimum(known[y[keep]], k))

    def _left_out(self, q: np.ndarray, j: np.ndarray, out: np.ndarray, at: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
        """How many of the tokens that were not looked up the rows have."""
        found = np.zeros(len(q), np.int64)
        for piece in _pieces(out, MET_PIECE):
            m = out[piece]
            place = at[self.code[_ranges(self.start[q[piece]] + self.size[q[piece]] - m, m)]]
            key = place * n + np.repeat(j[piece], m)
            # in order, so that the search goes through the lists once
            order = np.argsort(key)
            key, owner = key[order], np.repeat(np.arange(len(m)), m)[order]
            has = (keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key) & (place[order] >= 0)
            found[piece] = np.bincount(owner[has], minlength=len(m))
        return found

    def _take(self, q: np.ndarray, d: np.ndarray, times: np.ndarray) -> None:
        k = self.best.shape[1]
        q, d = np.repeat(q, times), np.repeat(d, times)
        order = np.lexsort((d, q))
        q, d = q[order], d[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < k
        rows, at = np.unique(q[kept], return_inverse=True)
        more = np.full((len(rows), k), np.inf)
        more[at, place[kept]] = d[kept]
        self.best[rows] = np.sort(np.concatenate([self.best[rows], more], axis=1), axis=1)[:, :k]


def _visits(k: int, start: float | None, finished: float | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of queries against shards; ``best`` of a block, as from an earlier visit, tells its bounds.

    ``start``: the distance within which neighbours are looked for without such bounds.
    ``finished``: queries with all neighbours within that distance are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, queries, chosen, shape = None, None, None, 0

        def told() -> pa.RecordBatch:
            best = np.full((shape, k), np.inf)
            best[chosen] = queries.best
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.string()), pa.array([best.tobytes()], pa.binary())], names=["part", "name", "best"])

        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                block = row.column("part")[0].as_py(), row.column("name")[0].as_py()
                if block != now:
                    if queries is not None:
                        yield told()
                    now = block
                    size, asked = _array(row, "a_size", "<i4").astype(np.int64), _array(row, "a_asked", "<i8")
                    shape = len(size)
                    limit = np.full(shape, np.inf if start is None else start)
                    mine = asked > 0
                    for column, done in (("done", finished), ("bound", None)):
                        if row.column(column)[0].is_valid:
                            kth = _array(row, column, "<f8").reshape(shape, k)[:, -1]
                            if done is not None:
                                mine &= ~(kth <= done)
                            else:
                                limit = np.minimum(limit, kth)
                    chosen = np.flatnonzero(mine)
                    code = _array(row, "a_code", "<u4")[np.repeat(mine, size)]
                    queries = Queries(size[mine], _words(row, "a_"), code, limit[mine], k)
                queries.visit(_array(row, "size", "<i4").astype(np.int64), _array(row, "known", "<i8"), _words(row), _array(row, "times", "<u2").astype(np.int64), _array(row, "owner", "<u2"))
        if queries is not None:
            yield told()

    return run


def _least(k: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        best = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), "<f8").reshape(-1, k) for b in rows["best"]], axis=1), axis=1)[:, :k]
        return pa.table({"part": rows["part"][:1], "name": rows["name"][:1], "best": pa.array([np.ascontiguousarray(best).tobytes()], pa.binary())})

    return run


def nearest_sets(blocks: DataFrame, k: int, near: float, most_rows: int = SHARD_ROWS) -> DataFrame:
    """(rep, asked, distances) of the k nearest training rows of each asked set of ``blocks``, at least k are known.

    First all rows within the distance ``near`` are looked for, by the rare tokens that
    they must share. Queries with fewer than k of them go on without a bound in one bundle,
    and with what they found there as their bound in the others.
    """
    spark = blocks.sparkSession
    tokens, sets, empty, parts = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("known_tokens", "sets_asked", "empty_known")], F.count(F.lit(1))).first()
    named = blocks.withColumn("name", F.col("rep")[0])
    n_bundles = max(1, min(int(parts), ceil(tokens / BUNDLE_TOKENS)))
    shards = cut_lineage(blocks.select("size", "known", "wide", "words", "code").coalesce(n_bundles).mapInArrow(_bundle(most_rows), SHARD).withColumn("bundle", F.spark_partition_id()))
    queries = named.filter("sets_asked > 0").select("part", "name", *[F.col(c).alias(f"a_{c}") for c in ("size", "asked", "wide", "words", "code")])
    none = F.lit(None).cast("binary")

    def visited(asked: DataFrame, others: DataFrame, start: float | None = None, finished: float | None = None) -> DataFrame:
        # a task reads the block and the shards that it pairs from where they were written
        met = asked.hint("shuffle_replicate_nl").join(others.drop("bundle"))
        best = met.mapInArrow(_visits(k, start, finished), "part int, name string, best binary")
        return cut_lineage(best.groupBy("part", "name").applyInArrow(_least(k), "part int, name string, best binary"))

    def joined(asked: DataFrame, best: DataFrame, column: str) -> DataFrame:
        best = best.select("part", "name", F.col("best").alias(column))
        return asked.join(F.broadcast(best) if sets * k * 8 <= SMALL_BYTES else best, ["part", "name"], "left")

    found = visited(queries.withColumns({"done": none, "bound": none}), shards, start=near)
    asked = joined(queries, found, "done")
    first = visited(asked.withColumn("bound", none), shards.filter("bundle = 0"), finished=near)
    if n_bundles > 1:
        later = visited(joined(asked, first, "bound"), shards.filter("bundle > 0"), finished=near)
        first = cut_lineage(first.unionByName(later).groupBy("part", "name").applyInArrow(_least(k), "part int, name string, best binary"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                asked, size = _array(row, "asked", "<i8"), _array(row, "size", "<i4")
                done, best = (_array(row, c, "<f8").reshape(-1, k) for c in ("done", "bound"))
                best = np.where(done[:, -1:] <= near, done, best)
                best[size == 0, :empty] = 0.0
                # a row that shares nothing is as far as can be
                best = np.where(np.isfinite(best), best, 1.0)[asked > 0]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1) * k, pa.int32()), pa.array(best.ravel()))
                rep = row.column("rep").flatten().filter(pa.array(asked > 0))
                yield pa.RecordBatch.from_arrays([rep, pa.array(asked[asked > 0]), lists], names=["rep", "asked", "distances"])

    asked = named.filter("sets_asked > 0").select("part", "name", "rep", "size", "asked")
    return joined(joined(asked, found, "done"), first, "bound").mapInArrow(told, "rep string, asked long, distances array<double>")
