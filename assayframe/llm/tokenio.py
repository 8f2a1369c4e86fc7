"""Token ids in compressed files, and back.

A file set is a Parquet folder. Its rows are segments of whole documents in ascending id
order; a segment's payload is a row of frames (see ``codec``), each of which can be read
alone and carries checksums. Parquet gives the files what a job needs on any store: they
appear once and whole, however often a task is tried again.

Columns: ``part`` (range of documents), ``segment`` (place within the part), ``first``
(ids of the part before the segment), ``n_ids``, ``doc_ids``, ``lengths`` (ids of each
document, with the end id) and ``payload``.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from assayframe.llm import codec
from assayframe.llm.scratch import small_batches
from assayframe.llm.text import slices, trimmed

SEGMENT = 1 << 16
#: Ids that are coded together: more keep numpy busy, fewer need less memory.
TOGETHER = 1 << 21
#: Bytes of text whose ids are sorted and coded by one task.
PART_BYTES = 16 << 20
#: Bytes of text that are parted together.
SLICE = 2 << 20
MEMO_SIZE = 150_000

_SCHEMA = "part int, segment bigint, first bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"


#: A line of letters that the library keeps or lower-cases one by one, as Python does, with ASCII signs behind
#: them; or any other.
_PLAIN = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-įı-žΑ-ΡΤ-Ωά-ία-ωό-ώЀ-џ]+)([!-/:-@\[-`{-~]*)|.*)$", re.M)
#: What a tokenizer must do to texts so that such letters are one word, and such signs another.
_NORMAL = ["NFC", {"Regex": "\\s+"}, "Lowercase"]
_PARTED = ["'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", "Removed", True, False, False]
#: Words given to the library at once.
WORDS = 10_000


@dataclass
class Chunks:
    """Different chunks, and where the ids of each begin and how many they are."""

    names: pa.Array
    starts: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray

    def __len__(self) -> int:
        return len(self.names)

    @classmethod
    def none(cls, kind: np.dtype) -> Chunks:
        """The empty chunk only."""
        return cls(pa.array([""], pa.large_string()), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, kind))

    def find(self, names: pa.Array) -> np.ndarray:
        """The place of each name, or -1."""
        return pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy()

    def with_more(self, names: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> Chunks:
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        return Chunks(pa.concat_arrays([self.names, names]), np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids]))


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``ids`` in a row."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - ends + sizes, sizes)
    at += np.arange(len(at))
    return ids.take(at)


class ChunkEncoder:
    """Ids of texts, as little-endian numbers, through a memory of chunks between spaces.

    The library lower-cases, normalises and splits a text so that nothing reaches across a
    space or line end; so a text's ids are those of its chunks in a row. ASCII texts are
    lower-cased beforehand. Texts are parted and their different chunks found by Arrow. New
    chunks of plain letters, with signs behind them, go to the library's model as words between
    spaces, where the tokenizer is known to make such words of them: the last id of a word tells
    that it ends. Others go through the whole tokenizer together, parted by a digit that is one
    id and that none of them has.
    The memory has two ages: what was not met again while the younger one filled is forgotten.
    """

    def __init__(self, content: str, kind: str = "<u4"):
        self.tokenizer = Tokenizer.from_str(content)
        self.kind = np.dtype(kind)
        alone = {d: self._ids(d) for d in "0123456789"}
        self.mark = next(((d, ids[0]) for d, ids in alone.items() if len(ids) == 1), None)
        self.memo, self.older = Chunks.none(self.kind), Chunks.none(self.kind)
        self.model, self.last = self._words_model(json.loads(content))

    def _words_model(self, made: dict) -> tuple[Tokenizer | None, np.ndarray]:
        """The model behind a cut at spaces, and which ids end a word; None where plain words may be cut otherwise."""
        try:
            nfc, spaces, lower = made["normalizer"]["normalizers"]
            split, octets = made["pre_tokenizer"]["pretokenizers"]
            model = made["model"]
            fits = [nfc["type"], spaces["pattern"], lower["type"]] == _NORMAL and spaces["content"] == " "
            fits &= [split["pattern"]["Regex"], split["behavior"], split["invert"], octets["add_prefix_space"], octets["use_regex"]] == _PARTED and octets["type"] == "ByteLevel"
            fits &= model["type"] == "BPE" and not model["dropout"] and bool(model["end_of_word_suffix"])
            # no added token can stand in letters and signs behind them
            fits &= all(re.search(r"[!-/:-@\[-`{-~][A-Za-z]", t["content"]) for t in made["added_tokens"])
        except (KeyError, TypeError, ValueError):
            fits = False
        if not fits:
            return None, np.zeros(0, bool)
        plain = Tokenizer(self.tokenizer.model)
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = plain.get_vocab()
        last = np.zeros(max(vocab.values()) + 1, bool)
        last[[i for t, i in vocab.items() if t.endswith(model["end_of_word_suffix"])]] = True
        return plain, last

    def _ids(self, text: str, tokenizer: Tokenizer | None = None) -> np.ndarray:
        # one text a call, so the library starts no threads; offsets are not wanted
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _each(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of chunks by the whole tokenizer."""
        together = [c for c in chunks if self.mark is not None and self.mark[0] not in c]
        found = {}
        if together:
            ids = self._ids(f" {self.mark[0]} ".join(together))
            cuts = np.flatnonzero(ids == self.mark[1])
            if len(cuts) == len(together) - 1:  # else a chunk meets its neighbours
                found = {c: ids[lo:hi] for c, lo, hi in zip(together, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])}
        return [found[c] if c in found else self._ids(c) for c in chunks]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The number of ids of each word and the ids of all, by the model alone; None if a word does not end once."""
        some = [self._ids(" ".join(words[i:i + WORDS]), self.model) for i in range(0, len(words), WORDS)]
        ids = np.concatenate([np.zeros(0, self.kind), *some])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):
            return None
        return np.diff(ends, prepend=0), ids

    def learn(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each of different chunks, and the ids of all."""
        n = len(names)
        # a chunk has no line end
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), names), pa.scalar("\n", pa.large_string()))[0].as_py() if n else ""
        found = _PLAIN.findall(lines) if n and self.model is not None else [("", "")] * n
        plain = np.fromiter((x[0] != "" for x in found), bool, n)
        words = "\n".join([w for w, _ in found if w]).lower().split("\n") if plain.any() else []
        signs = [s for w, s in found if w]
        # the empty piece has no ids
        place = {p: i for i, p in enumerate(dict.fromkeys(["", *words, *signs]))}
        known = self._words([*place][1:])
        if known is None:
            plain[:] = False
            words, signs, known = [], [], (np.zeros(len(place) - 1, np.int64), np.zeros(0, self.kind))
        pairs = np.array([[*map(place.__getitem__, words)], [*map(place.__getitem__, signs)]], np.int64).T
        size = np.concatenate([[0], known[0]]).astype(np.int64)
        begin = np.cumsum(size) - size
        other = np.flatnonzero(~plain)
        chunks = lines.split("\n") if len(other) else []
        rest = self._each([chunks[i] for i in other])
        order = np.concatenate([np.flatnonzero(plain), other])
        starts, sizes = np.zeros(n, np.int64), np.zeros(n, np.int64)
        sizes[order] = np.concatenate([size[pairs].sum(axis=1), [len(x) for x in rest]]).astype(np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return sizes, _gathered(np.concatenate([_gathered(known[1], begin[pairs.ravel()], size[pairs.ravel()]), *rest]), starts, sizes)

    def together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and the last one's end."""
        if len(self.memo) > MEMO_SIZE:
            self.memo, self.older = Chunks.none(self.kind), self.memo
        parted = pc.split_pattern(pa.array([(t.lower() if t.isascii() else t).replace("\n", " ") for t in texts], pa.large_string()), " ")
        coded = parted.flatten().dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy()
        young, old = self.memo.find(names), self.older.find(names)
        new = np.flatnonzero((young < 0) & (old < 0))
        new_sizes, new_ids = self.learn(names.take(pa.array(new)))
        ids = np.concatenate([self.memo.ids, self.older.ids, new_ids])
        sizes = np.where(young >= 0, self.memo.sizes[young], self.older.sizes[old])
        starts = np.where(young >= 0, self.memo.starts[young], len(self.memo.ids) + self.older.starts[old])
        sizes[new], starts[new] = new_sizes, len(ids) - len(new_ids) + np.cumsum(new_sizes) - new_sizes
        more = np.flatnonzero(young < 0)
        self.memo = self.memo.with_more(names.take(pa.array(more)), sizes[more], _gathered(ids, starts[more], sizes[more]))
        each = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        return _gathered(ids, starts[codes], each), ends[parted.offsets.to_numpy()]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, bounds = self.together(texts)
        return [ids[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]


#: Kept between the tasks of a Python worker.
_ENCODERS: dict[tuple[int, str], ChunkEncoder] = {}


def chunked(content: str, kind: str) -> ChunkEncoder:
    key = zlib.crc32(content.encode()), kind
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ChunkEncoder(content, kind)
    return _ENCODERS[key]


def unencoding(run):
    """``run`` for mapInArrow, in a worker that encodes no more: its encoder and freed memory are given back."""

    def begin(batches):
        _ENCODERS.clear()
        return trimmed(run)(batches)

    return begin


def chunks_hold(tokenizer: Tokenizer) -> bool:
    """Whether the library's ids of a text are those of its chunks, tried on texts made for it."""
    trial = ["a b", "A  b\n\nC", " lead", "trail ", "it's 's  't", "x\n's", "é é ́a b́", "1 2 3.4 ,5", "Σας ΣΑΣ Σ", "a b c d", "<|endoftext|> a <|endoftext|>b", "ﬁ ½ 한 국", "a. B, c., d.. e,", "é. 'S, ½. x'. ́, É."]
    encoder = ChunkEncoder(tokenizer.to_str())
    return encoder.encode(trial) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in trial]


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    block: int = codec.BLOCK,
    segment: int = SEGMENT,
) -> None:
    """Encode every whole text, end it with ``end_id`` and write the ids in ascending id order.

    ``tokenizer``: path of a file of the tokenizers library on the driver, whose content is
    broadcast. Null texts are empty: one end id. Null ids come first. Rows with equal ids
    stand together, by text. Extra columns are left out. An empty table writes no segments.

    Texts are encoded where they lie and their ids are dealt to ranges of documents, 16 bits
    each where the vocabulary allows; texts are not shuffled. The ranges come from the ids of
    the documents alone. A hot id is dealt by text and row too, so no range must hold all of
    it. A task holds ``TOGETHER`` ids and the longest document.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    library = Tokenizer.from_str(content)
    if not chunks_hold(library):
        raise ValueError(f"{tokenizer} reaches across spaces")
    size = max(library.get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    wide = np.dtype(kind).itemsize
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(content)
    end = np.array([end_id], kind).tobytes()

    rows = docs.select(F.col(doc_id).cast("long").alias("key"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("m"), F.col(text).alias("text"))
    bounds = _bounds(rows)
    starts = spark.sparkContext.broadcast(bounds)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunked(held.value, kind)
        for batch in batches:
            places = [_place(*k) for k in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            parts = pa.array([bisect_right(starts.value, p) for p in places], pa.int32())
            for piece in slices(batch.column(3), SLICE):
                lo, n = piece.rows.start, len(piece.rows)
                ids, bounds = encoder.together([piece.text(i).decode("utf-8", "replace") for i in range(n)])
                held_ids = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((wide * bounds).astype(np.int32)), pa.py_buffer(ids)])
                some = [c.slice(lo, n) for c in (parts, *batch.columns[:3])]
                yield pa.RecordBatch.from_arrays([*some, held_ids], names=["part", "key", "h", "m", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names, ids, waiting = [], [], 0
        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(key)
                ids.append(found + end)
                waiting += len(ids[-1]) // wide
                if waiting >= TOGETHER:
                    out = _segments(names, ids, kind, size, block, segment, part, number, before)
                    number, before = number + len(out), before + waiting
                    names, ids, waiting = [], [], 0
                    yield out
        if names:
            yield _segments(names, ids, kind, size, block, segment, part, number, before)

    found = small_batches(rows).mapInArrow(trimmed(encoded), "part int, key bigint, h bigint, m bigint, ids binary")
    dealt = found.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("key", "h", "m")
    dealt.select("key", "ids").mapInArrow(unencoding(run), _SCHEMA).write.parquet(path)


def _place(key: int | None, h: int, m: int) -> tuple:
    """Where a row stands in the order of documents; null ids come first."""
    return (key is not None, key or 0, h, m)


def _bounds(rows: DataFrame) -> list[tuple]:
    """Where each range of documents but the first begins, one for each ``PART_BYTES`` of text.

    Only keys are shuffled. There are at most as many ranges as the session's shuffle
    partitions, and only their first rows reach the driver.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(-(-total // PART_BYTES), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if parts < 2:
        return []
    firsts = rows.select("key", "h", "m").repartitionByRange(parts, "key", "h", "m").groupBy(F.spark_partition_id()).agg(F.min(F.struct(F.col("key").isNotNull(), F.coalesce("key", F.lit(0)), "h", "m")).alias("first"))
    return sorted(tuple(r["first"]) for r in firsts.collect())[1:]


def _segments(names: list, ids: list[bytes], kind: str, size: int, block: int, segment: int, part: int, number: int, before: int) -> pa.RecordBatch:
    lengths = np.array([len(x) for x in ids]) // np.dtype(kind).itemsize
    groups = (np.cumsum(lengths) - lengths) // segment  # a new one at each multiple of ``segment``
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    stops = np.append(starts[1:], len(ids))
    blocks, counts = [], []
    for lo, hi in zip(starts, stops):
        whole = np.frombuffer(b"".join(ids[lo:hi]), kind)
        some = [whole[i:i + block] for i in range(0, len(whole), block)]
        blocks += some
        counts.append(len(some))
    frames = coded(codec.encode_blocks, blocks, size)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    totals = np.add.reduceat(lengths, starts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(starts), part), pa.int32()),
            pa.array(number + np.arange(len(starts))),
            pa.array(before + np.cumsum(totals) - totals),
            pa.array(totals),
            pa.array([names[lo:hi] for lo, hi in zip(starts, stops)], pa.list_(pa.int64())),
            pa.array([lengths[lo:hi] for lo, hi in zip(starts, stops)], pa.list_(pa.int64())),
            pa.array([b"".join(frames[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary()),
        ],
        names=["part", "segment", "first", "n_ids", "doc_ids", "lengths", "payload"],
    )


def coded(run, blocks: list, size: int) -> list:
    """Blocks through the coder, as many at once as its tables should hold."""
    step = TOGETHER // codec.BLOCK
    return [x for i in range(0, len(blocks), step) for x in run(blocks[i:i + step], size)]


def _decoded(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, list, list[np.ndarray]]]:
    """Row of each segment, its document ids and each document's token ids."""
    frames = [codec.split_frames(p) for p in batch.column(batch.schema.get_field_index("payload")).to_pylist()]
    blocks = coded(codec.decode_blocks, [f for fs in frames for f in fs], size)
    at = 0
    for i, fs in enumerate(frames):
        whole = np.concatenate([np.zeros(0, "<u4"), *blocks[at:at + len(fs)]])
        at += len(fs)
        lengths = batch.column(batch.schema.get_field_index("lengths"))[i].values.to_numpy()
        if lengths.sum() != len(whole):
            raise ValueError("a segment's documents do not fit its ids")
        yield i, batch.column(batch.schema.get_field_index("doc_ids"))[i].values.to_pylist(), np.split(whole, np.cumsum(lengths)[:-1])


def _read(spark: SparkSession, path: str, size: int, schema: str, names: list[str], make) -> DataFrame:
    """Rows of ``make`` for each document; ``start`` counts the ids of all documents before it."""
    files = spark.read.schema(_SCHEMA).parquet(path)
    # one row for each range of documents
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 128):
                some = batch.slice(lo, 128)
                rows = []
                for i, keys, docs in _decoded(some, size):
                    first, part = some.column(some.schema.get_field_index("first"))[i].as_py(), some.column(some.schema.get_field_index("part"))[i].as_py()
                    for key, ids in zip(keys, docs, strict=True):
                        rows.append((part, first, key, len(ids), *make(ids)))
                        first += len(ids)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *_KINDS[schema]]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["part", "start", "doc_id", "n_tokens", *names])

    read = small_batches(files).mapInArrow(unencoding(run), f"part int, start bigint, doc_id bigint, n_tokens bigint, {schema}")
    joined = read.join(F.broadcast(before), F.col("part") == F.col("of"))
    return joined.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", *names)


_KINDS = {"ids array<bigint>": [pa.list_(pa.int64())], "ids_crc32 bigint": [pa.int64()]}


def read_ids(spark: SparkSession, path: str, size: int) -> DataFrame:
    """doc_id, start, n_tokens and ``ids`` of each document; ``size``: number of different ids.

    A damaged block is an error.
    """
    return _read(spark, path, size, "ids array<bigint>", ["ids"], lambda ids: (ids.astype(np.int64),))


def read_checksums(spark: SparkSession, path: str, size: int) -> DataFrame:
    """doc_id, start, n_tokens and ``ids_crc32``, the crc32 of the ids as little-endian 32-bit numbers."""
    return _read(spark, path, size, "ids_crc32 bigint", ["ids_crc32"], lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))


def vocabulary(tokenizer: str, end_id: int = 2) -> int:
    """Number of different ids under a tokenizer file."""
    return max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)


def through_files(docs: DataFrame, path: str, tokenizer: str, **options) -> DataFrame:
    """Write the ids of ``docs`` to ``path`` and read their checksums back."""
    write_ids(docs, path, tokenizer, **options)
    return read_checksums(docs.sparkSession, path, vocabulary(tokenizer, options.get("end_id", 2)))
