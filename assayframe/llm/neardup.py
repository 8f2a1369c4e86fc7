"""Near-duplicates by BagMinHash signatures of word shingles.

A text is the bag of its shingles. Each shingle carries a Poisson process for each band
of weight, (0, 1], (1, 2], (2, 4], (4, 8], ...; a band's rate is its width. A point has a
time, a place in the band and a component of the signature, all from hashes of the
shingle, the band and the point's number. A point counts if its place lies below the
shingle's weight, so texts share exactly the points below the smaller of their weights.
A component's value is its earliest point; two texts agree on it with a probability equal
to their weighted Jaccard similarity. Points are made in the order of time and stop when
none can be the earliest any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.components import components
from assayframe.llm.exactdedup import marked, present
from assayframe.llm.scratch import consumed, small_batches, stored
from assayframe.llm.text import Slice, mix, shingles, slices, trimmed, words

SHINGLE = 5
SIMILARITY = (4, 5)
BANDS = 25
ROWS = 5
SEED = 0x5EED
#: Hubs that the members of a bucket meet before the rest is paired by shingles.
HUBS = 2

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROW_BITS = np.uint64(44)


def _shift(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) % (1 << 64))


def bags(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle (44 bits of its hash) and how often the row has it."""
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    keys = np.sort((rows << _ROW_BITS) | (hashes >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    keys = keys[first]
    return (keys >> _ROW_BITS).astype(np.int64), keys & np.uint64((1 << 44) - 1), counts


def signatures(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n_rows: int, size: int, seed: int = SEED) -> np.ndarray:
    """BagMinHash signatures: ``size`` numbers for each row. Rows without elements keep zeros."""
    state = [(rows, mix(keys + np.uint64(seed)), np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64), weights)]
    low = 1
    while (more := np.flatnonzero(weights > low)).size:
        state.append((rows[more], mix(keys[more] + np.uint64(seed + low * 0x632BE5)), np.full(len(more), low), np.full(len(more), low), weights[more]))
        low *= 2
    row, source, low_end, width, weight = (np.concatenate(x) for x in zip(*state))
    time = np.zeros(len(row))
    best = np.full(n_rows * size, np.inf)
    values = np.zeros(n_rows * size, np.uint64)
    turn = 0
    while len(row):
        draw = mix(source + _shift(2 * turn + 1))
        time = time - np.log((draw >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / width
        point = mix(source + _shift(2 * turn + 2))
        place = row * size + ((point >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        active = np.flatnonzero((time < best[place]) & (low_end + ((point & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64) >> np.uint64(32)).astype(np.int64) < weight))
        at, when = place[active], time[active]
        np.minimum.at(best, at, when)
        won = best[at] == when
        values[at[won]] = point[active[won]]
        turn += 1
        # checked less often once few points are left; late checks only cost points
        if turn < 4 or turn % 8 == 0:
            last = best.reshape(n_rows, size).max(axis=1)
            left = np.flatnonzero(time < last[row])
            row, source, low_end, width, weight, time = (x[left] for x in (row, source, low_end, width, weight, time))
    return values.reshape(n_rows, size)


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of a signature; a key is never shared by two bands but by chance."""
    values = values.reshape(len(values), bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), values.shape[:2]).copy()
    for i in range(rows):
        keys = mix(keys * np.uint64(3) + values[:, :, i])
    return keys.view(np.int64)


def digests(found) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each row's sequence of words."""
    counts = np.diff(found.offsets)
    place = np.arange(len(found.hashes), dtype=np.uint64) - np.repeat(found.offsets[:-1], counts).astype(np.uint64)
    out = []
    for salt in (1, 2):
        spread = mix(mix(found.hashes + np.uint64(salt)) + place * _STEP)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
        out.append(mix(total[found.offsets[1:]] - total[found.offsets[:-1]] + counts.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def sketch(docs: DataFrame, key: str, text: str, shingle: int, bands: int, rows: int, seed: int = SEED) -> DataFrame:
    """key, own, n (shingles), d1 and d2 (digest of the words), bands (none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            parts = []
            for part in slices(column):
                found = words(part)
                hashes, offsets = shingles(found, shingle)
                n = np.diff(offsets)
                some = np.flatnonzero(n)
                keys = np.zeros((len(n), bands), np.int64)
                if len(some):
                    row, element, count = bags(hashes, np.concatenate([[0], np.cumsum(n[some])]))
                    keys[some] = band_keys(signatures(row, element, count, len(some), bands * rows, seed), bands, rows)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(n, bands, 0))]), pa.int32()), pa.array(keys[some].ravel())
                )
                parts.append((n, *digests(found), listed))
            if parts:
                n, d1, d2 = (np.concatenate([p[i] for p in parts]) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n), pa.array(d1), pa.array(d2), pa.concat_arrays([p[3] for p in parts])],
                    names=["key", "own", "n", "d1", "d2", "bands"],
                )

    return small_batches(docs).select(F.col(key).alias("key"), text, "_own").mapInArrow(trimmed(run), "key bigint, own boolean, n bigint, d1 bigint, d2 bigint, bands array<bigint>")


def overlap(a: Slice, b: Slice, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared shingles, counted as often as both have them, and the shingles of either, row by row."""
    sides = []
    for part in (a, b):
        hashes, offsets = shingles(words(part), shingle)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])])[:len(hashes)])
        sides.append((row[first], hashes[first], np.diff(np.concatenate([first, [len(hashes)]])), np.diff(offsets)))
    row, hashes, counts = (np.concatenate([s[i] for s in sides]) for i in range(3))
    order = np.lexsort((hashes, row))
    row, hashes, counts = row[order], hashes[order], counts[order]
    twice = np.flatnonzero((row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])) if len(row) else np.zeros(0, int)
    shared = np.bincount(row[twice], np.minimum(counts[twice], counts[twice + 1]), len(a.rows)).astype(np.int64)
    return shared, sides[0][3], sides[1][3]


def similar(pairs: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b, text_a, text_b) whose bags of shingles are as similar as asked, as a, b."""
    up, down = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                if not len(part.rows):
                    continue
                rows = batch.slice(part.rows.start, len(part.rows))
                # the other side's texts are cut the same way, whatever their length
                other = next(slices(rows.column(3), 1 << 62))
                shared, n_a, n_b = overlap(part, other, shingle)
                yield rows.select([0, 1]).filter(pa.array(shared * down >= (n_a + n_b - shared) * up))

    return small_batches(pairs).select("a", "b", "text_a", "text_b").mapInArrow(trimmed(run), "a bigint, b bigint")


def _fits(similarity: tuple[int, int]) -> F.Column:
    """Bags as different in size as n and hub_n may be similar enough."""
    up, down = similarity
    return (F.col("n") * down >= F.col("hub_n") * up) & (F.col("hub_n") * down >= F.col("n") * up)


def _open(placed: DataFrame, hubs: DataFrame) -> DataFrame:
    """Members that were no hubs, of the buckets in which these are of several classes."""
    rest = placed.join(hubs.select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti")
    several = rest.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    return rest.join(stored(several.select("bucket"), "several"), "bucket", "left_semi")


def prefix_pairs(texts: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of ``texts`` (node, label, text) of different labels that may be similar: all that are, and few others.

    A bag of n shingles shares at least t * n of them with one that is t-similar. So in
    any common order the first n - ceil(t * n) + 1 shingles of two such bags meet, and the
    order is from the rarest on. A shingle that only one text has needs no row; a shingle
    all of whose texts have one label has no pairs. Of the others, texts of any but the
    shingle's most frequent label meet the rest. What two bags share from their first
    common shingle on is at most what either has from there on, which leaves out most
    pairs. A shingle that stands k times in a text counts as k different ones.
    """
    up, down = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2), 1 << 20):
                hashes, offsets = shingles(words(part), shingle)
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                order = np.lexsort((hashes, row))
                hashes, row = hashes[order], row[order]
                first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])])[:len(hashes)]
                begin = np.maximum.accumulate(np.where(first, np.arange(len(hashes)), 0))
                tokens = mix(hashes + (np.arange(len(hashes)) - begin).astype(np.uint64) * _STEP)
                at = pa.array(row + part.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.diff(offsets)[row]), pa.array(tokens.view(np.int64))],
                    names=["node", "label", "n", "token"],
                )

    tokens = stored(small_batches(texts).select("node", "label", "text").mapInArrow(trimmed(run), "node bigint, label bigint, n bigint, token bigint"), "tokens")
    shared = stored(tokens.groupBy("token").agg(F.count("*").alias("texts")).filter("texts > 1"), "shared")
    common = tokens.join(shared, "token")
    # tokens of one text alone come first of all and only take up places
    alone = F.col("n") - F.count("*").over(Window.partitionBy("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("texts", "token"))
    reach = F.col("n") - F.expr(f"(n * {up} + {down - 1}) div {down}") + 1
    prefix = common.withColumn("place", place + alone).filter(F.col("place") <= reach).select("node", "label", "n", "token", (F.col("n") - F.col("place")).alias("rest"))
    prefix = stored(prefix, "prefix")
    by_label = prefix.groupBy("token", "label").agg(F.count("*").alias("k"))
    most = by_label.groupBy("token").agg(F.max(F.struct("k", "label")).alias("m"), F.count("*").alias("labels")).filter("labels > 1")
    mixed = stored(prefix.join(stored(most.select("token", F.col("m")["label"].alias("main")), "mixed"), "token"), "prefix")
    few = mixed.filter("label <> main").select("token", F.col("node").alias("hub"), F.col("label").alias("hub_label"), F.col("n").alias("hub_n"), F.col("rest").alias("hub_rest"))
    enough = (F.least("rest", "hub_rest") + 1) * (up + down) >= (F.col("n") + F.col("hub_n")) * up
    met = mixed.join(few, "token").filter((F.col("label") != F.col("hub_label")) & _fits(similarity) & enough)
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _bits(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashes of ``key``, of fixed size."""
    return present(keys.select(F.xxhash64(key).alias("hash")), "hash")


def _among(rows: DataFrame, bits: DataFrame, there: bool = True) -> DataFrame:
    """The rows whose ``_key`` has its bit set, or has not; those of other keys may have it too."""
    found = marked(rows.withColumn("_hash", F.xxhash64("_key")), "_hash", bits, "_there")
    return found.filter("_there" if there else "NOT _there").select(rows.columns)


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: tuple[int, int] = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of its class) and ``n_shingles`` of each row.

    Two texts are linked if their bags of word shingles have a weighted Jaccard
    similarity of at least ``similarity``; classes are connected components. A text of
    fewer words than a shingle is one shingle of all its words. Texts with the same words
    are copies. Null texts and texts without words are alone in their class. Rows with the
    same id are one document: they are in one class. A null id stands for a number made
    from the text; its class_id is that number where no other id is in the class. Extra
    columns are ignored. An empty table gives an empty table.

    Copies are joined first, so only different texts are compared. Candidates share one of
    ``bands`` keys of ``rows`` components each: at a similarity of 0.8, 25 bands of 5 miss
    1 pair in 20,000. A bucket's members first meet its hubs, one at a time, and never each
    other. Texts of buckets that are still of several classes are then paired exactly by
    their rarest shingles (see ``prefix_pairs``), where only texts of different classes
    meet. No bucket is cut off.
    """
    with consumed() as block:
        key = F.coalesce(F.col(doc_id).cast("long"), -F.abs(F.xxhash64(text)))
        keyed = docs.select(key.alias("_key"), F.col(doc_id).isNotNull().alias("_own"), F.col(text).alias("_text"))
        sketches = stored(sketch(keyed, "_key", "_text", shingle, bands, rows), "sketches")
        texts = stored(sketches.filter("n > 0").groupBy("d1", "d2").agg(F.min("key").alias("node")), "texts")
        keys = sketches.filter("n > 0").join(texts.select("node").distinct(), F.col("key") == F.col("node"), "left_semi")
        posted = stored(keys.select(F.col("key").alias("node"), "n", F.explode("bands").alias("bucket")).groupBy("bucket", "node").agg(F.max("n").alias("n")), "posted")
        buckets = stored(posted.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
        members = stored(posted.join(buckets, "bucket"), "members")
        # the text that others vary shares more buckets with them than they do with each other
        scores = stored(members.groupBy("node").agg(F.sum("members").alias("score")), "scores")
        members = stored(members.join(scores, "node").select("bucket", "node", "n", "score"), "members")
        # told at the scan, so that the other texts are not shuffled; a few more by chance do no harm
        in_play = _among(keyed, _bits(scores, "node")).select(F.col("_key").alias("node"), F.col("_text").alias("text"))
        held = stored(in_play, "held-texts")

        def linked(pairs: DataFrame) -> DataFrame:
            first = pairs.join(held.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            return stored(similar(first.join(held.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"), shingle, similarity), "links")

        # rows of one id with different words are one document
        double = sketches.filter("n > 0").join(texts, ["d1", "d2"]).filter("key <> node").select(F.col("key").alias("a"), F.col("node").alias("b"))
        links = stored(double.join(texts.select(F.col("node").alias("a")).distinct(), "a", "left_semi").distinct(), "double")
        nothing = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
        labels, hubs = nothing if links.isEmpty() else components(links), None
        for _ in range(HUBS):
            placed = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            if hubs is not None:
                placed = stored(_open(placed, hubs), "open")
            chosen = placed.groupBy("bucket").agg(F.max(F.struct("score", -F.col("node"), "n", "label")).alias("h"))
            chosen = stored(chosen.select("bucket", (-F.col("h")["col2"]).alias("hub"), F.col("h")["n"].alias("hub_n"), F.col("h")["label"].alias("hub_label")), "hubs")
            met = placed.join(chosen, "bucket").filter((F.col("label") != F.col("hub_label")) & _fits(similarity))
            more = linked(stored(met.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "tried"))
            hubs = chosen if hubs is None else hubs.union(chosen)
            if not more.isEmpty():
                links = links.union(more)
                labels = components(links)
        placed = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        left = stored(_open(placed, hubs).select("node", "label").distinct(), "left")
        if not left.isEmpty():
            more = linked(stored(prefix_pairs(held.join(left, "node"), shingle, similarity), "tried"))
            if not more.isEmpty():
                labels = components(links.union(more))

        classes = stored(texts.join(labels, "node", "left").select("d1", "d2", F.coalesce("label", "node").alias("class_id")), "classes")
        block.keep(sketches, classes)
    found = sketches.join(classes, ["d1", "d2"], "left").select("key", "own", "n", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("key")).alias("class_id"))
    return found.select(F.when(F.col("own"), F.col("key")).alias(doc_id), "class_id", F.col("n").alias("n_shingles"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class: the one with the smallest id. Columns as in ``docs``.

    Of rows with the same id, or without one and with the same text, one stays.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    id_, text_ = f"_c{names.index(doc_id)}", f"_c{names.index(text)}"
    key = F.coalesce(F.col(id_).cast("long"), -F.abs(F.xxhash64(text_)))
    keyed = plain.withColumn("_key", key)
    with consumed() as block:
        classes = near_duplicates(keyed, doc_id="_key", text=text_, **options)
        of_key = stored(classes.groupBy("_key").agg((F.min("class_id") == F.col("_key")).alias("kept"), F.count("*").alias("n")), "kept")
        block.keep(of_key)
    single, several = of_key.filter("kept AND n = 1").select("_key"), of_key.filter("kept AND n > 1").select("_key")
    # most texts are told at the scan; those that share a bit with one that goes, or with
    # one that has other rows, are told by a join, in which few of those that go take part
    doubtful = _bits(of_key.filter("NOT kept OR n > 1"), "_key")
    tried = _among(single, doubtful)
    open_ = _among(_among(keyed, doubtful), _bits(tried, "_key"))
    once = _among(keyed, doubtful, False).union(open_.join(tried, "_key", "left_semi").select(keyed.columns))
    if not several.isEmpty():
        again = _among(keyed, _bits(several, "_key")).join(several, "_key", "left_semi").select(keyed.columns)
        once = once.union(again.dropDuplicates(["_key"]))
    return once.drop("_key").toDF(*names)
