"""Hard negatives with an inverted multi-index.

A vector is cut in two halves, each with a codebook; a pair of codewords is a cell. The
score of a row against an anchor is at most the sum of two half scores: that of the
codeword plus the length of the anchor's half times the largest distance (radius) of a
row's half from its codeword. Cells are visited in the order of these sums, which a heap
over the two sorted lists of half scores gives without sorting all cells, until the
window asked for is certain: no cell left can hold a better score.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.scratch import stored, unit

#: Codewords of a half, and rows that the codebooks are fitted on, at most.
CODES, SAMPLE = 16, 4096
#: Rows of the index, and anchors, that a task holds, about.
BLOCK, CHUNK = 4096, 4096
#: Blocks that an anchor is sent to before all others.
FIRST = 2
#: Rows of anchors that are sent to blocks together.
SLICE = 256
#: Anchor rows in a batch that leaves a task.
OUT_ROWS = 2000


@dataclass
class Cells:
    """The cells of one length of vectors: codebooks, codes, radii, and the blocks that hold them.

    Cells of one group share blocks: small cells one block, a large cell several.
    """

    books: tuple[np.ndarray, np.ndarray]
    codes: np.ndarray  # (cells, 2)
    radii: np.ndarray  # (cells, 2)
    group: np.ndarray  # start of each group among the cells
    first_block: np.ndarray  # of each group
    parts: np.ndarray  # blocks of each group

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible score of each anchor in each group of cells."""
        cut = self.books[0].shape[1]
        middle, spread, size = 0.0, 0.0, 0.0
        for half, (q, book) in enumerate(zip((anchors[:, :cut], anchors[:, cut:]), self.books)):
            length = np.sqrt((q**2).sum(1))[:, None]
            middle = middle + (q @ book.T)[:, self.codes[:, half]]
            spread = spread + length * self.radii[:, half]
            size = size + length * (np.sqrt((book**2).sum(1))[self.codes[:, half]] + self.radii[:, half])
        # rounding must never hide a row
        spread = spread + 1e-9 * size + 1
        return np.minimum.reduceat(middle - spread, self.group, axis=1), np.maximum.reduceat(middle + spread, self.group, axis=1)


def fit_books(vectors: list[np.ndarray], codes: int, rounds: int = 8) -> np.ndarray:
    """Up to ``codes`` centres of the rows, by k-means from rows far apart."""
    rows = np.asarray(vectors, float)
    if not rows.shape[1]:
        return rows[:1]
    rows = np.unique(rows, axis=0)
    picked = [int(np.argmax((rows**2).sum(1)))]
    near = ((rows - rows[picked[0]]) ** 2).sum(1)
    while len(picked) < min(codes, len(rows)):
        picked.append(int(np.argmax(near)))
        near = np.minimum(near, ((rows - rows[picked[-1]]) ** 2).sum(1))
    centres = rows[picked]
    for _ in range(rounds):
        nearest = _nearest(rows, centres)
        centres = np.array([rows[nearest == i].mean(0) if (nearest == i).any() else c for i, c in enumerate(centres)])
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None, :] - 2 * rows @ centres.T, axis=1)


def codebooks(vectors: DataFrame, codes: int = CODES, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of vectors: the codebooks of both halves, fitted on at most ``sample`` rows.

    They decide how many cells are visited, never the result. A length that the sample
    lacks gets a single cell around zero.
    """
    by_size: dict[int, list] = {}
    for (v,) in vectors.select("vector").orderBy(unit(F.col("id"), seed=12), "id").limit(sample).collect():
        by_size.setdefault(len(v), []).append(v)
    return {n: tuple(fit_books(half, codes) for half in _halves(np.array(rows, float).reshape(len(rows), n))) for n, rows in by_size.items()}


def _halves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = rows.shape[1] // 2
    return rows[:, :cut], rows[:, cut:]


def _books(books: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    return books.get(size) or (np.zeros((1, size // 2)), np.zeros((1, size - size // 2)))


def _by_length(vectors) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and float matrix of the lists of each length."""
    lengths = np.asarray(vectors.value_lengths() if len(vectors) else [], int)
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        yield int(size), at, np.asarray(vectors.take(pa.array(at)).flatten(), float).reshape(len(at), size)


def coded(vectors: DataFrame, books: dict) -> DataFrame:
    """``vectors`` with size, i and j (codewords of the halves) and the distances d1 and d2 to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((4, len(batch)))
            sizes = np.zeros(len(batch), np.int32)
            for size, at, rows in _by_length(batch.column("vector")):
                sizes[at] = size
                for half, (part, book) in enumerate(zip(_halves(rows), _books(books, size))):
                    code = _nearest(part, book)
                    out[half, at] = code
                    out[2 + half, at] = np.sqrt(((part - book[code]) ** 2).sum(1))
            columns = [pa.array(sizes), *(pa.array(c.astype(np.int32)) for c in out[:2]), *(pa.array(c) for c in out[2:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "size", "i", "j", "d1", "d2"])

    return vectors.mapInArrow(run, "id bigint, label string, vector array<bigint>, size int, i int, j int, d1 double, d2 double")


def build_index(vectors: DataFrame, codes: int, sample: int, block: int) -> tuple[DataFrame, dict[int, Cells]]:
    """The rows with their block, and the cells of each length.

    The cells, at most ``codes`` squared for each length of vectors, are counted and
    come to the driver. Small cells that follow each other share a block; a cell of more
    than ``block`` rows is dealt to several, so a hot cell is many tasks.
    """
    spark = vectors.sparkSession
    books = codebooks(vectors, codes, sample)
    rows = stored(coded(vectors, books).withColumn("tag", F.monotonically_increasing_id()), "cells")
    found = rows.groupBy("size", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("r1"), F.max("d2").alias("r2"))
    cells: dict[int, list] = {}
    for r in found.collect():
        cells.setdefault(r["size"], []).append((r.i, r.j, r.n, r.r1, r.r2))
    index, placed, at = {}, [], 0
    for size in sorted(cells):
        group, first, parts, room = [], [], [], 0
        for c, (i, j, n, *_) in enumerate(sorted(cells[size])):
            if n > room or n > block:
                group.append(c)
                first.append(at)
                parts.append(math.ceil(n / block))
                at += parts[-1]
                room = block if n <= block else 0
            room -= min(n, room)
            placed.append((size, i, j, first[-1], parts[-1]))
        table = np.array(sorted(cells[size]), float)
        index[size] = Cells(_books(books, size), table[:, :2].astype(int), table[:, 3:], *(np.array(x) for x in (group, first, parts)))
    schema = "size int, i int, j int, first int, parts int"
    # one row per cell
    place = F.broadcast(spark.createDataFrame(placed, schema))
    dealt = rows.join(place, ["size", "i", "j"]).withColumn("block", (F.col("first") + F.pmod("tag", "parts")).cast("int"))
    return stored(dealt.select("block", "id", "label", "vector", "i", "j", "d1", "d2"), "index"), index


def cells_in_order(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, place, place) of all pairs of two lists, by falling sum, without building all pairs.

    Multi-sequence: both lists are sorted, and a pair enters the heap after a pair that
    is at least as large on one side and equal on the other.
    """
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    if not len(a) or not len(b):
        return
    heap, met = [(-(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        s, u, v = heapq.heappop(heap)
        yield -s, int(a[u]), int(b[v])
        for x, y in ((u + 1, v), (u, v + 1)):
            if x < len(a) and y < len(b) and (x, y) not in met:
                met.add((x, y))
                heapq.heappush(heap, (-(first[a[x]] + second[b[y]]), x, y))


class Best:
    """The ``k`` highest scores not above ``high``, ties to the smaller id."""

    def __init__(self, k: int, least: float, high: float = math.inf):
        self.k, self.least, self.high = k, least, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = (scores <= self.high) & (scores >= self.needed())
        if fit.any():
            ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores, scores[fit]])
            best = np.lexsort((ids, -scores))[:self.k]
            self.ids, self.scores = ids[best], scores[best]

    def needed(self) -> float:
        """A row with a lower score changes nothing."""
        return max(self.least, int(self.scores[-1])) if len(self.ids) == self.k else self.least


class Block:
    """The rows of one length in a block, sorted by cell."""

    def __init__(self, ids, labels, vectors, codes, distances, books):
        order = np.lexsort((codes[:, 1], codes[:, 0]))
        self.ids, self.vectors = ids[order], vectors[order]
        names, self.labels = np.unique(labels[order], return_inverse=True)
        self.label_code = {name: code for code, name in enumerate(names.tolist())}
        codes, distances = codes[order], distances[order]
        self.present = [np.unique(codes[:, half]) for half in (0, 1)]
        self.books = [book[seen] for book, seen in zip(books, self.present)]
        place = np.array([np.searchsorted(seen, codes[:, half]) for half, seen in enumerate(self.present)])
        self.radii = [np.zeros(len(seen)) for seen in self.present]
        for half in (0, 1):
            np.maximum.at(self.radii[half], place[half], distances[:, half])
        starts = np.flatnonzero(np.any(np.diff(place, axis=1, prepend=-1) != 0, axis=0))
        ends = [*starts[1:], len(order)]
        self.cells = {(place[0, s], place[1, s]): slice(s, e) for s, e in zip(starts, ends)}
        self.visited = 0

    def has_label(self, label: str) -> np.ndarray:
        return self.labels == self.label_code.get(label, -1)

    def visit(self, anchor: np.ndarray, wanted: Sequence[Best], allowed: np.ndarray, exact: bool) -> None:
        """Show the allowed rows to all that is ``wanted``, until it is certain."""
        halves = _halves(anchor[None, :].astype(float))
        middle = [book @ q[0] for q, book in zip(halves, self.books)]
        spread = [math.sqrt(float((q[0] ** 2).sum())) * (r * (1 + 1e-9) + 1e-9 * np.sqrt((book**2).sum(1))) + 0.5 for q, r, book in zip(halves, self.radii, self.books)]
        top = max(w.high for w in wanted)
        q = anchor.astype(float) if exact else anchor.astype(object)
        for bound, u, v in cells_in_order(middle[0] + spread[0], middle[1] + spread[1]):
            if all(bound < w.needed() for w in wanted):
                return
            at = self.cells.get((u, v))
            if at is None or middle[0][u] - spread[0][u] + middle[1][v] - spread[1][v] > top:
                continue
            fit = allowed[at]
            self.visited += at.stop - at.start
            if fit.any():
                x = self.vectors[at][fit]
                scores = ((x if exact else x.astype(object)) @ q).astype(np.int64)
                for w in wanted:
                    w.add(self.ids[at][fit], scores)


def _search(index: DataFrame, shipped: DataFrame, books, schema: str, work) -> DataFrame:
    """``work(block, anchor row, exact)`` for each block and the anchors sent to it.

    A task holds one block and at most about CHUNK anchors. Rows go where anchors go:
    a block that no anchor of a chunk needs is not sent to it.
    """
    needed = shipped.select(F.col("block").alias("at"), F.col("chunk").alias("to")).distinct()
    sides = index.join(needed, index["block"] == needed["at"]).drop("at")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and rows.num_rows:
            asked, rows = asked.combine_chunks(), rows.combine_chunks()
            blocks = {}
            top = max(int(np.abs(np.asarray(t["vector"].combine_chunks().flatten(), float)).max(initial=0)) for t in (asked, rows))
            for size, at, vectors in _by_length(rows["vector"].combine_chunks()):
                some = rows.take(pa.array(at))
                exact = top * top * max(size, 1) < 1 << 52
                if not exact:
                    vectors = np.asarray(some["vector"].combine_chunks().flatten(), np.int64).reshape(len(at), size)
                codes, distances = (np.array([np.asarray(some[c]) for c in pair]).T for pair in (("i", "j"), ("d1", "d2")))
                blocks[size] = Block(np.asarray(some["id"]), np.asarray(some["label"].to_pylist(), object), vectors, codes, distances, _books(books.value, size)), exact
            for row in asked.to_pylist():
                if len(row["vector"]) in blocks:
                    out += work(*blocks[len(row["vector"])], row)
        columns = zip(*out) if out else [[]] * len(names)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return shipped.groupBy("block", "chunk").cogroup(sides.groupBy("block", "to")).applyInArrow(run, schema)


def _ship(anchors: DataFrame, cells, first: int | None = None) -> DataFrame:
    """Each anchor once for every block it is sent to.

    ``anchors`` has lists high and need, one entry for each thing that is looked for,
    and ``done``, blocks it was sent to before. A block matters if its scores can reach
    the least ``need`` and do not all pass the largest ``high``. With ``first``, that
    many blocks with the highest bounds are sent; without, all that matter and are not done.
    """
    schema = "a bigint, id bigint, label string, vector array<bigint>, chunk int, high array<bigint>, need array<bigint>, block int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            highs, needs, dones = (batch.column(c).to_pylist() for c in ("high", "need", "done"))
            kept = batch.select(["a", "id", "label", "vector", "chunk", "high", "need"])
            for size, at, vectors in _by_length(batch.column("vector")):
                index = cells.value.get(size)
                if index is None:
                    continue
                for start in range(0, len(at), SLICE):
                    least, most = index.bounds(vectors[start:start + SLICE])
                    taken, blocks = [], []
                    for n, lo, hi in zip(at[start:start + SLICE].tolist(), least, most):
                        matter = np.flatnonzero((hi >= min(needs[n])) & (lo <= max(highs[n])))
                        if first:
                            matter = matter[np.argsort(-hi[matter], kind="stable")][:first]
                        every = [b for g in matter for b in range(index.first_block[g], index.first_block[g] + index.parts[g])]
                        every = every[:first] if first else [b for b in every if b not in dones[n]]
                        taken += [n] * len(every)
                        blocks += every
                        if len(taken) >= OUT_ROWS:
                            yield _sent(kept, taken, blocks)
                            taken, blocks = [], []
                    if taken:
                        yield _sent(kept, taken, blocks)

    return anchors.mapInArrow(run, schema)


def _sent(batch: pa.RecordBatch, taken: list, blocks: list) -> pa.RecordBatch:
    some = batch.take(pa.array(taken, pa.int64()))
    return pa.RecordBatch.from_arrays([*some.columns, pa.array(blocks, pa.int32())], names=[*some.schema.names, "block"])


#: Below every score: the exact range of a long, so that comparisons stay exact.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    *,
    id_col: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    codes: int = CODES,
    sample: int = SAMPLE,
    block: int = BLOCK,
    chunk: int = CHUNK,
    first: int = FIRST,
) -> DataFrame:
    """The hardest negatives of each anchor and positive, exactly.

    Both tables: a long id, a label and an array of longs. A score is the inner product
    with the anchor, higher first, ties by smaller id. An anchor's positives are its
    first ``positives`` rows of the same label with another id; the negatives of a
    positive are the first ``negatives`` rows of another label whose score is at least
    ``low`` and at most ``high`` (fractions) of the positive's. Returns anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null id or label, a null vector or a null component take no part. Only
    rows with as many components as the anchor count. Fewer rows than asked for give
    fewer results, none give none; a positive with a negative score has no window.
    Repeated rows all count; anchors that are equal in all columns are one anchor. A
    score that a long cannot hold is an error. Other columns are ignored.

    Two searches, each in two rounds. In the first round an anchor goes to the blocks
    with the highest bounds; the scores found there tell which other blocks matter, and
    only to these it is sent in the second. Every task holds a block of rows and a chunk
    of anchors. The first search finds the positives, the second the windows below them.
    """
    spark = vectors.sparkSession
    narrow = [F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<bigint>").alias("vector")]

    def whole(df: DataFrame) -> DataFrame:
        return df.select(*narrow).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")

    index, cells = build_index(whole(vectors), codes, sample, block)
    asked = stored(whole(anchors).distinct().withColumn("a", F.monotonically_increasing_id()), "anchors")
    chunks = max(1, math.ceil(asked.count() / chunk))
    asked = asked.select("a", "id", "label", "vector", F.pmod("a", F.lit(chunks)).cast("int").alias("chunk"))
    shared = spark.sparkContext.broadcast(cells)
    books = spark.sparkContext.broadcast({size: c.books for size, c in cells.items()})

    def same(rows: Block, exact: bool, row: dict) -> list[tuple]:
        best = Best(positives, row["need"][0])
        rows.visit(_vector(row, exact), [best], rows.has_label(row["label"]) & (rows.ids != row["id"]), exact)
        return [(row["a"], i, s) for i, s in zip(best.ids.tolist(), best.scores.tolist())]

    def other(rows: Block, exact: bool, row: dict) -> list[tuple]:
        wanted = [Best(negatives, need, hi) for hi, need in zip(row["high"], row["need"])]
        rows.visit(_vector(row, exact), wanted, ~rows.has_label(row["label"]), exact)
        return [(row["a"], hi, i, s) for hi, w in zip(row["high"], wanted) for i, s in zip(w.ids.tolist(), w.scores.tolist())]

    def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
        place = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
        return found.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k)

    def sent_before(sent: DataFrame) -> DataFrame:
        """``asked`` with the blocks each anchor was sent to: at most ``first``."""
        done = sent.groupBy("a").agg(F.collect_list("block").alias("done"))
        return asked.join(done, "a", "left").withColumn("done", F.coalesce("done", F.array().cast("array<int>")))

    # positives: one list, of the whole range
    none, highest = F.array().cast("array<int>"), F.array(F.lit(HIGHEST).cast("long"))
    lowest = F.lit(LOWEST).cast("long")
    sent = stored(_ship(asked.withColumns({"high": highest, "need": F.array(lowest), "done": none}), shared, first), "sent")
    near = stored(ranked(_search(index, sent, books, "a bigint, found_id bigint, score bigint", same), ["a"], positives), "near")
    kth = near.filter(F.col("place") == positives).select("a", F.array("score").alias("need"))
    known = sent_before(sent).join(kth, "a", "left").withColumns({"high": highest, "need": F.coalesce("need", F.array(lowest))})
    sent = stored(_ship(known.select(*asked.columns, "high", "need", "done"), shared), "sent")
    more = _search(index, sent, books, "a bigint, found_id bigint, score bigint", same)
    paired = stored(ranked(near.drop("place").unionByName(more), ["a"], positives), "positives")

    # windows: one for each positive that has any; positives of one score share it
    wide = F.col("score").cast("decimal(38,0)")
    (p, q), (r, s) = low, high
    from_, to = F.ceil(wide * p / q).cast("long"), F.floor(wide * r / s).cast("long")
    paired = paired.select("a", F.col("found_id").alias("positive_id"), F.col("place").alias("nth"), F.col("score").alias("positive_score"), from_.alias("low"), to.alias("high"))
    windows = paired.filter("low <= high").groupBy("a", "high").agg(F.min("low").alias("low"))

    def listed(df: DataFrame) -> DataFrame:
        """At most ``positives`` windows for each anchor, in lists."""
        return df.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("high", "need"))).alias("w")).select("a", "w.high", "w.need")

    opened = asked.join(listed(windows.withColumn("need", F.col("low"))), "a").withColumn("done", none)
    sent = stored(_ship(opened, shared, first), "sent")
    schema = "a bigint, high bigint, found_id bigint, score bigint"
    near = stored(ranked(_search(index, sent, books, schema, other), ["a", "high"], negatives), "near")
    kth = near.filter(F.col("place") == negatives).select("a", "high", F.col("score").alias("need"))
    certain = listed(windows.join(kth, ["a", "high"], "left").withColumn("need", F.coalesce("need", "low")))
    known = sent_before(sent).join(certain, "a").select(*asked.columns, "high", "need", "done")
    sent = stored(_ship(known, shared), "sent")
    more = _search(index, sent, books, schema, other)
    found = ranked(near.drop("place").unionByName(more), ["a", "high"], negatives)
    result = paired.join(found, ["a", "high"]).filter(F.col("score") >= F.col("low")).join(asked.select("a", F.col("id").alias("anchor_id")), "a")
    return result.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _vector(row: dict, exact: bool) -> np.ndarray:
    return np.array(row["vector"], float if exact else np.int64)
