"""The prefix trie of conversations, with count-min screening of prefix digests.

A node is a distinct sequence of first turns; a prefix digest stands for it. A
count-min sketch of all prefix digests never estimates too low, so an estimate of one
proves that one conversation alone has the prefix: such nodes, the tails of nearly all
conversations, are emitted where their rows lie. Only prefixes that may be shared are
shuffled and grouped exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.mixing import word_count
from assayframe.llm.scratch import small_batches, stored
from assayframe.operators.skew import attach

#: Rows and width of the sketch. A counter is a byte that stops at 2, as only "one" and
#: "more" are told apart: 16 MB in all, whatever the number of prefixes.
DEPTH, WIDTH = 4, 1 << 22
#: Counters that travel together.
CHUNK = 1 << 16
#: The prefix without turns.
ROOT = hashlib.sha256(b"").digest()[:16]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def digest_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, digest, words): what the trie needs of a turn, without its text.

    Null role and text become empty. The length of the role parts it from the text.
    """
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    rows = conversations.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"), digest.alias("digest"), word_count(F.col(text)).alias("words"))
    return rows.filter("conv IS NOT NULL")


def borrowed(conv: Column, every: int, most: int) -> tuple[Column, Column]:
    """Whose first turns a conversation starts with, and how many of them."""
    return conv - conv % every, (F.crc32(conv.cast("string").cast("binary")) % most).cast("int")


def prefixes(turns: DataFrame, every: int, most: int) -> DataFrame:
    """(conv, depth, node, parent, words, last): each prefix of each rebuilt conversation.

    ``turns`` comes from :func:`digest_turns`. Conversation c starts with the first h
    turns of conversation c - c % ``every``, h from 0 to ``most`` - 1, and goes on with
    its own turns after its first h. Turns stand in the order of turn (null first); turns
    with the same number in the order of role and digest. ``words`` are those of the
    prefix's last turn; ``last`` marks the whole conversation.

    Conversations are read in their order, a turn at a time, so a task holds one batch
    of turns and the digest so far, however long a conversation is.
    """
    base, h = borrowed(F.col("conv"), every, most)
    order = [F.asc_nulls_first("turn"), "role", "digest"]
    first = turns.filter(F.col("conv") % every == 0).withColumn("at", F.row_number().over(Window.partitionBy("conv").orderBy(*order)))
    # at most ``most`` - 1 turns of a conversation are left
    heads = (
        first.filter(F.col("at") < most)
        .groupBy(F.col("conv").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("head"))
    )
    ids = turns.select("conv").distinct().withColumns({"base": base, "h": h})
    opening = ids.join(heads, "base", "left").select("conv", "h", F.col("head.digest").alias("head"), F.col("head.words").alias("head_words"))
    none, no_words = F.lit(None).cast("array<binary>"), F.lit(None).cast("array<bigint>")
    rows = turns.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "words", F.lit(None).cast("int").alias("h"), none.alias("head"), no_words.alias("head_words"))
    rows = rows.unionByName(opening.select("conv", F.lit(0).alias("kind"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("bigint").alias("words"), "h", "head", "head_words"))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "kind", *order).drop("role", "turn")

    names = ("conv", "depth", "node", "parent", "words", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = node = above = None
        depth = skip = said = 0
        out: list[tuple] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "kind", "digest", "words", "h", "head", "head_words"))
            for c, kind, digest, words, h, head, head_words in zip(*columns):
                if kind == 0:
                    if conv is not None:
                        out.append((conv, depth, node, above, said, True))
                    conv, node, above, depth, said, skip = c, ROOT, None, 0, 0, h
                    more = list(zip((head or [])[:h], (head_words or [])[:h]))
                elif skip:
                    skip -= 1
                    continue
                else:
                    more = [(digest, words)]
                for d, w in more:
                    out.append((conv, depth, node, above, said, False))
                    above, node = node, hashlib.sha256(node + d).digest()[:16]
                    depth, said = depth + 1, w
            yield _batch(out, names)
            out = []
        if conv is not None:
            yield _batch([(conv, depth, node, above, said, True)], names)

    return small_batches(dealt).mapInArrow(run, "conv bigint, depth bigint, node binary, parent binary, words bigint, last boolean")


_TYPES = {"conv": pa.int64(), "depth": pa.int64(), "node": pa.binary(), "parent": pa.binary(), "words": pa.int64(), "last": pa.bool_()}


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[n]) for c, n in zip(columns, names)], names=list(names))


def _slots(nodes: pa.Array, depth: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a digest, and the counters of those digests: one line per row of the sketch."""
    known = np.flatnonzero(~np.asarray(nodes.is_null()))
    flat = np.frombuffer(b"".join(nodes.take(pa.array(known)).to_pylist()), np.uint64).reshape(-1, 2)
    step = flat[:, 1] | np.uint64(1)
    return known, np.array([((flat[:, 0] + np.uint64(i) * step) >> np.uint64(7)) % np.uint64(width) for i in range(depth)], np.int64)


def sketch(nodes: DataFrame, column: str = "node", depth: int = DEPTH, width: int = WIDTH) -> np.ndarray:
    """The count-min sketch of a column of 16-byte digests, ``depth`` by ``width`` bytes that stop at 2.

    Tasks sketch their own rows and send the chunks they have touched; these are added
    up in tasks, one after another, and the sum, of fixed size, comes to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((depth, width), np.uint8)
        for batch in batches:
            _, slots = _slots(batch.column(0), depth, width)
            for line, at in zip(table, slots):
                # a slot met twice in a batch counts twice: once for all, once for the repeats
                seen, times = np.unique(at, return_counts=True)
                line[seen] = np.minimum(line[seen] + np.minimum(times, 2), 2)
        yield from _chunks(table)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((depth, width), np.uint8)
        flat = table.reshape(-1)
        for batch in batches:
            for row in batch.to_pylist():
                part = flat[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK]
                np.minimum(part + _counters(row["ones"], row["twos"], len(part)), 2, out=part)
        yield from _chunks(table)

    schema = "chunk int, ones binary, twos binary"
    parts = small_batches(nodes.select(column)).mapInArrow(count, schema)
    summed = parts.repartition("chunk").mapInArrow(add, schema)
    table = np.zeros(depth * width, np.uint8)
    for row in summed.toLocalIterator():
        part = table[row.chunk * CHUNK:(row.chunk + 1) * CHUNK]
        part[:] = _counters(row.ones, row.twos, len(part))
    return table.reshape(depth, width)


def _chunks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chunks of a sketch that are not all zero, a few in a batch.

    The counters that are one and those that are two are two lists of places, or sets of
    bits where a chunk is well filled.
    """
    flat = table.reshape(-1)
    rows = []
    for at in range(-(-len(flat) // CHUNK)):
        part = flat[at * CHUNK:(at + 1) * CHUNK]
        if part.any():
            rows.append((at, *(_packed(part == n) for n in (1, 2))))
        if len(rows) == 16:
            yield _chunk_batch(rows)
            rows = []
    if rows:
        yield _chunk_batch(rows)


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    at, ones, twos = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ones, pa.binary()), pa.array(twos, pa.binary())], names=["chunk", "ones", "twos"])


def _packed(mask: np.ndarray) -> bytes:
    """Places in two bytes each after a 0, or a bit for each counter after a 1: what is shorter."""
    places = np.flatnonzero(mask)
    if 2 * len(places) < len(mask) // 8:
        return b"\0" + places.astype(np.uint16).tobytes()
    return b"\1" + np.packbits(mask).tobytes()


def _counters(ones: bytes, twos: bytes, size: int) -> np.ndarray:
    """The counters of a chunk, from what :func:`_packed` made."""
    part = np.zeros(size, np.uint8)
    for n, packed in ((1, ones), (2, twos)):
        if packed[0]:
            part[np.unpackbits(np.frombuffer(packed, np.uint8, offset=1))[:size] > 0] = n
        else:
            part[np.frombuffer(packed[1:], np.uint16)] = n
    return part


def screened(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """``rows`` with ``alone`` and ``parent_alone``: whether the sketch proves that one row only has the digest.

    The sketch has a fixed size and is broadcast. The textless root's parent is none, so not alone.
    """
    depth, width = table.shape
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for name in ("node", "parent"):
                known, slots = _slots(batch.column(name), depth, width)
                single = np.zeros(len(batch), bool)
                single[known] = np.min([shared.value[i][at] for i, at in enumerate(slots)], axis=0) == 1
                flags.append(pa.array(single))
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], names=[*batch.schema.names, "alone", "parent_alone"])

    return rows.mapInArrow(run, "conv bigint, depth bigint, node binary, parent binary, words bigint, last boolean, alone boolean, parent_alone boolean")


def digest_lists(members: DataFrame) -> DataFrame:
    """(node, ends): sha256 of each node's ``conv`` ids in ascending order, joined by commas.

    Ids are sorted over all tasks and joined to long pieces there, which spreads the ids
    of a hot node. The pieces, one for thousands of ids, then go through sha256 in their
    order, which only allows that, without being held.
    """
    ordered = members.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv").to_pylist()
            starts = [i for i in range(len(ids)) if i == 0 or nodes[i] != nodes[i - 1]]
            pieces = [",".join(map(str, ids[a:b])) for a, b in zip(starts, [*starts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[a] for a in starts], pa.binary()), pa.array([ids[a] for a in starts], pa.int64()), pa.array(pieces, pa.string())], names=["node", "first", "piece"]
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for node, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
                if node == current:
                    state.update(b"," + piece.encode())
                else:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = node, hashlib.sha256(piece.encode())
            yield _ends(done)
        if state is not None:
            yield _ends([(current, state.hexdigest())])

    def _ends(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["node", "ends"])

    pieces = ordered.mapInArrow(join, "node binary, first bigint, piece string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends string")


def prefix_trie(
    conversations: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    every: int = 20,
    most: int = 4,
    depth: int = DEPTH,
    width: int = WIDTH,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, see :func:`prefixes` for how they are built.

    Returns conv_id (the smallest member: conversations that start with the node's
    turns), depth, parent_conv_id (the parent's; null for the root), n_convs (members),
    n_children, n_leaves (childless nodes in the subtree, its top included),
    saved_tokens (over the subtree: a node's members beyond the first, times the words
    of its last turn) and ends_sha256 (sha256 of the members that end here, ascending,
    joined by commas; of nothing if none do). conv_id and depth name a node, and a
    node's turns are the first ``depth`` ones of that conversation.

    Rows without a conversation id take no part. Null roles and texts are empty;
    repeated rows are repeated turns. A conversation without turns of its own left is
    what it starts with, perhaps nothing. An empty table has no nodes. Other columns
    take no part.

    Sums over a subtree need no walk: each node belongs to its smallest member, which is
    a member of all nodes above, so a node's sum is that of its members' own parts from
    its depth on, a running sum along each conversation and one more grouping.
    """
    turns = stored(digest_turns(conversations, conv, turn, role, text), "turns")
    rows = stored(prefixes(turns, every, most), "prefixes")
    rows = stored(screened(rows, sketch(rows, "node", depth, width)), "screened")

    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    own_end = F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(NO_ENDS))
    onward = F.when(F.col("last"), zero).otherwise(one)

    def node(parent: Column) -> list[Column]:
        """A node with one member."""
        return [
            F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, parent).alias("parent_conv_id"), one.alias("n_convs"),
            onward.alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), own_end.alias("ends_sha256"),
        ]

    tails = rows.filter("alone AND parent_alone").select(*node(F.col("conv")))

    # nodes that may be shared, and the first node after them, whose parent they hold
    open_rows = rows.filter("NOT alone").select("conv", "depth", "node", "words", "last")
    heads = rows.filter("alone AND NOT parent_alone").select("conv", "depth", "node", "words", "last")
    groups = open_rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("owner"), F.sum(F.col("last").cast("long")).alias("n_ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("an_end")
    )
    groups = stored(groups, "groups")
    placed = attach(open_rows, groups, ["node"], "n", ["conv"]).select(*open_rows.columns, "n", "owner", "n_ends", F.lit(True).alias("open"))
    placed = placed.unionByName(heads.withColumns({"n": one, "owner": F.col("conv"), "n_ends": F.col("last").cast("long"), "open": F.lit(False)}))

    along = Window.partitionBy("conv").orderBy("depth")
    below = Window.partitionBy("conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv")
    owned = F.col("owner") == F.col("conv")
    follows = F.lead("depth").over(along) == F.col("depth") + 1
    placed = placed.withColumns(
        {
            "up": F.when(F.lag("depth").over(along) == F.col("depth") - 1, F.lag("owner").over(along)).otherwise(F.col("conv")),
            # a next node that is not here is alone, so this conversation's own
            "child": F.when(F.col("last"), zero).when(F.coalesce(follows, F.lit(False)), (F.lead("owner").over(along) == F.col("conv")).cast("long")).otherwise(one),
            "saved": F.sum(F.when(owned, (F.col("n") - 1) * F.col("words")).otherwise(zero)).over(below),
            # an end that is not here is alone, so a leaf of its own
            "leaf": F.coalesce(F.max(F.when(F.col("last"), (owned & (F.col("n") == F.col("n_ends"))).cast("long"))).over(whole), one),
        }
    )
    placed = stored(placed, "placed")
    single = placed.filter("NOT open").select(*node(F.col("up")))
    sums = placed.filter("open").groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("up").alias("up"), F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    # one id needs no list
    listed = digest_lists(attach(open_rows.filter("last"), groups.filter("n_ends > 1"), ["node"], "n_ends", ["conv"]))
    shared = (
        sums.join(groups, "node")
        .join(listed, "node", "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > 0, F.col("up")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends", F.when(F.col("n_ends") == 1, F.sha2(F.col("an_end").cast("string"), 256)), F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    return tails.unionByName(single).unionByName(shared)
