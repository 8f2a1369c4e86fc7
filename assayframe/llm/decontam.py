"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words become one automaton. A document's words stream through it; at each
word the automaton gives the longest stretch ending there that occurs in some item.
Where that is at least a window long, the words of the window are hit.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from assayframe.llm.scratch import small_batches, stored
from assayframe.llm.text import slices, trimmed, words, words_of

WINDOW = 13
#: Words of the items that one automaton holds; it has at most twice as many states.
SHARD_WORDS = 200_000


class ItemAutomaton:
    """Suffix automaton over the word sequences of test items.

    ``windows``: for a state whose strings include one of ``window`` words, the items
    that hold that window. ``wholes``: items shorter than a window, by the state of
    their whole text; ``shorter`` leads from any state to the nearest such state on its
    suffix links, itself included.
    """

    def __init__(self, items: Iterable[tuple[object, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[object] = []
        coded = []
        for name, text in items:
            sequence = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if sequence:
                self.names.append(name)
                coded.append(sequence)
                state = 0
                for symbol in sequence:
                    state = self._extend(state, symbol)
        windows: dict[int, set[int]] = {}
        wholes: dict[int, list[tuple[int, int]]] = {}
        for number, sequence in enumerate(coded):
            state = size = 0
            for symbol in sequence:
                state, size = self.step(state, size, symbol)
                state, size = self.shorten(state, size, window)
                if size == window:
                    windows.setdefault(state, set()).add(number)
            if len(sequence) < window:
                wholes.setdefault(state, []).append((size, number))
        self.windows = {s: tuple(sorted(v)) for s, v in windows.items()}
        self.wholes = {s: tuple(sorted(v)) for s, v in wholes.items()}
        self.shorter = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.shorter[state] = state if state in self.wholes else self.shorter[self.link[state]]
        self.shortest = min([window, *map(len, coded)])
        self.known = _HashSet(words_hashes(self.vocabulary))

    def _extend(self, last: int, symbol: int) -> int:
        """Add one symbol after ``last``; states that exist are used again."""
        there = self.next[last].get(symbol)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._split(last, symbol, there)
        state = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = state
            p = self.link[p]
        if p >= 0:
            there = self.next[p][symbol]
            self.link[state] = there if self.length[there] == self.length[p] + 1 else self._split(p, symbol, there)
        return state

    def _split(self, p: int, symbol: int, there: int) -> int:
        """Part the shorter strings of ``there``, those that end a string of ``p``, from the rest."""
        copy = self._state(self.length[p] + 1, dict(self.next[there]), self.link[there])
        self.link[there] = copy
        while p >= 0 and self.next[p].get(symbol) == there:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def step(self, state: int, size: int, symbol: int) -> tuple[int, int]:
        """The longest stretch that ends with ``symbol`` after a match of ``size`` words at ``state``."""
        edges = self.next[state]
        while symbol not in edges and state:
            state = self.link[state]
            size = self.length[state]
            edges = self.next[state]
        return (edges[symbol], size + 1) if symbol in edges else (0, 0)

    def shorten(self, state: int, size: int, most: int) -> tuple[int, int]:
        """The state of the last ``most`` words of a match."""
        while size > most:
            if self.length[self.link[state]] >= most:
                state = self.link[state]
                size = self.length[state]
            else:
                size = most
        return state, size

    def scan(self, text: list[bytes], shift: int = 0) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of hit words as [from, to) and the numbers of the items hit."""
        spans: list[tuple[int, int]] = []
        hit: set[int] = set()
        state = size = 0
        get, window, wholes, shorter = self.vocabulary.get, self.window, self.wholes, self.shorter
        for at, word in enumerate(text, shift):
            symbol = get(word)
            if symbol is None:
                state = size = 0
                continue
            state, size = self.step(state, size, symbol)
            # only a window's worth of the match matters
            state, size = self.shorten(state, size, window)
            longest = 0
            if size == window:
                longest = window
                hit.update(self.windows[state])
            inner = shorter[state]
            while inner > 0:
                for length, number in wholes[inner]:
                    if length <= size:
                        hit.add(number)
                        longest = max(longest, length)
                inner = shorter[self.link[inner]] if self.link[inner] > 0 else -1
            if longest:
                lo, hi = at + 1 - longest, at + 1
                while spans and spans[-1][1] >= lo:
                    lo = min(lo, spans.pop()[0])
                spans.append((lo, hi))
        return spans, hit


class _HashSet:
    """Which of many 64-bit hashes are in a set: an open table looked up as an array."""

    def __init__(self, members: np.ndarray):
        members = np.unique(members)
        self.mask = np.uint64((1 << max(10, int(len(members) * 4).bit_length())) - 1)
        self.table = np.zeros(int(self.mask) + 1, np.uint64)
        for h in members:
            at = h & self.mask
            while self.table[at]:
                at = (at + np.uint64(1)) & self.mask
            self.table[at] = h

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        there = self.table[at]
        found = there == hashes
        open_ = np.flatnonzero(~found & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + np.uint64(1)) & self.mask
            there = self.table[at[open_]]
            same = there == hashes[open_]
            found[open_] = same
            open_ = open_[~same & (there != 0)]
        return found


def words_hashes(vocabulary: Iterable[bytes]) -> np.ndarray:
    column = pa.array(list(vocabulary), pa.binary())
    return np.concatenate([np.zeros(0, np.uint64), *(words(part).hashes for part in slices(column))])


def _runs(known: np.ndarray, offsets: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Stretches of at least ``least`` known words within a row: row, first, end."""
    cut = np.zeros(len(known) + 1, bool)
    cut[offsets] = True
    begin = known.copy()
    begin[1:] &= ~known[:-1] | cut[1:-1]
    end = known.copy()
    end[:-1] &= ~known[1:] | cut[1:-1]
    a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = b - a >= least
    a, b = a[long], b[long]
    yield from zip(np.searchsorted(offsets, a, side="right") - 1, a, b)


def scan_column(automaton: ItemAutomaton, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
    """Number of words, hit spans and hit items of each text.

    Only stretches of words that the items know, long enough for a window, are walked;
    no others can hold a window.
    """
    for part in slices(column):
        found = words(part)
        spans: list[list[tuple[int, int]]] = [[] for _ in part.rows]
        hit: list[set[int]] = [set() for _ in part.rows]
        for row, a, b in _runs(automaton.known.has(found.hashes), found.offsets, automaton.shortest):
            lo, hi = found.starts[a], found.starts[b - 1] + found.lengths[b - 1]
            more, items = automaton.scan(words_of(part.data[lo:hi].tobytes()), int(a - found.offsets[row]))
            spans[row] += more
            hit[row] |= items
        yield from zip(np.diff(found.offsets).tolist(), spans, hit)


def automata(benchmark: DataFrame, item: str, text: str, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, automaton): pickled automata of the items in groups of at most about ``shard_words`` words.

    A running word sum, within partitions and from one partition to the next, tells the
    group. Each group is built in a task of its own; no item passes the driver.
    """
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).cast("binary").alias("text")).filter("text IS NOT NULL")
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            # a word and what parts it from the next take two bytes at least
            sizes = np.asarray(pc.binary_length(batch.column(1)), np.int64) // 2
            before = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(batch), part, np.int64)), pa.array(before), pa.array(sizes)], names=["item", "text", "part", "before", "size"]
            )

    def build(key: tuple, items: pa.Table) -> pa.Table:
        automaton = ItemAutomaton(zip(items["item"].to_pylist(), items["text"].to_pylist()), window)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "automaton": pa.array([pickle.dumps(automaton, protocol=5)], pa.binary())})

    placed = stored(small_batches(rows).mapInArrow(run, f"item {kind}, text binary, part bigint, before bigint, size bigint"), "items")
    # one row per partition, so the unpartitioned window is over a short table
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.sum("size").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    shard = F.floor((F.col("start") + F.col("before")) / shard_words).cast("long").alias("shard")
    return placed.join(F.broadcast(starts), "part").select(shard, "item", "text").groupBy("shard").applyInArrow(build, "shard bigint, automaton binary")


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (word positions, [from, to)) and ``hit_items`` to ``docs``.

    The benchmark may be of any size: its items are cut into groups of bounded size, whose
    automata are built side by side and stored. Each automaton is a broadcast of bounded
    size, which the documents pass in one stage without a shuffle. If there are more
    groups, the table is written between them, so no task holds more than one automaton.

    Null texts and texts without words have no spans; null or empty items hit nothing;
    an empty benchmark hits nothing. Items with the same text all count, items that share
    an id are listed once, and the words of an item without an id are hit but it is not
    listed. ``keep`` names the columns to keep, all if None; those with the three names
    give way.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in _MADE]
    rest = list(dict.fromkeys([*kept, text]))
    found = docs.select(*rest)
    built = stored(automata(benchmark, item, item_text, window, shard_words), "automata")
    groups = sorted(r["shard"] for r in built.select("shard").collect())
    for n, group in enumerate(groups or [None]):
        automaton = pickle.dumps(None) if group is None else bytes(built.filter(F.col("shard") == group).first()["automaton"])
        found = _passed(stored(found, "spans") if n else found, automaton, text, rest)
    return found.select(*kept, *_MADE)


_MADE = ("n_words", "hit_spans", "hit_items")


def _passed(docs: DataFrame, automaton: bytes, text: str, rest: list[str]) -> DataFrame:
    """``rest`` of ``docs`` and the three columns by a pickled automaton or None, with what they held before if they were there."""
    held = docs.sparkSession.sparkContext.broadcast(automaton)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    before = set(_MADE) <= set(docs.columns)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "n_words bigint, hit_spans array<struct<lo:bigint,hi:bigint>>, hit_items array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pickle.loads(held.value)
        out = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            if before:
                spans = [[(x["lo"], x["hi"]) for x in s] for s in batch.column(batch.schema.get_field_index("hit_spans")).to_pylist()]
                items = [set(x) for x in batch.column(batch.schema.get_field_index("hit_items")).to_pylist()]
            else:
                spans, items = [[] for _ in range(len(batch))], [set() for _ in range(len(batch))]
            sizes = [0] * len(batch)
            if automaton is None:
                for part in slices(column):
                    sizes[part.rows.start:part.rows.stop] = np.diff(words(part).offsets).tolist()
            else:
                for i, (n, more, hit) in enumerate(scan_column(automaton, column)):
                    sizes[i] = n
                    spans[i] += more
                    items[i] |= {str(automaton.names[k]) for k in hit if automaton.names[k] is not None}
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in rest),
                    pa.array(sizes, pa.int64()),
                    pa.array([[{"lo": a, "hi": b} for a, b in joined(s)] for s in spans], out),
                    pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                ],
                names=[*rest, *_MADE],
            )

    return small_batches(docs).mapInArrow(trimmed(run), schema)


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that touch made one."""
    whole: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if whole and lo <= whole[-1][1]:
            whole[-1] = (whole[-1][0], max(hi, whole[-1][1]))
        else:
            whole.append((lo, hi))
    return whole


def n_hit() -> F.Column:
    """Number of hit words, from ``hit_spans``."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])


def over_limit(coverage: int = 20) -> F.Column:
    """Hit words are at least one in ``coverage`` of all."""
    return (n_hit() > 0) & (coverage * n_hit() >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, coverage: int = 20, cut: bool = False, text: str = "text", **options) -> DataFrame:
    """Drop the documents whose hit words are at least one in ``coverage``.

    With ``cut``, those documents stay and lose the hit spans instead: the words and what
    stands between them. Documents under the limit are left as they are. Columns as in
    ``docs``.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    body = f"_c{names.index(text)}"
    found = contaminated_spans(plain, benchmark, text=body, **options)
    if not cut:
        return found.filter(~over_limit(coverage)).select(*plain.columns).toDF(*names)
    less = F.when(over_limit(coverage), _cut(F.col(body), F.col("hit_spans"))).otherwise(F.col(body))
    return found.withColumn(body, less).select(*plain.columns).toDF(*names)


@F.pandas_udf(StringType())
def _cut(texts, spans):
    return texts.combine(spans, lambda t, s: t if t is None else without(t, [(x["lo"], x["hi"]) for x in s]))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans."""
    data = text.encode()
    found = words(next(slices(pa.array([data], pa.binary()))))
    kept, at = [], 0
    for lo, hi in joined(spans):
        kept.append(data[at:found.starts[lo]])
        at = found.starts[hi - 1] + found.lengths[hi - 1]
    return b"".join([*kept, data[at:]]).decode()
