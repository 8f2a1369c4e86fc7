"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of its first 3 to 6
bytes, so that stems count for words never seen. Filters of several widths run over the
words of the whole text; the largest response of each feeds a logistic output. Thresholds
are set for each language, which is told from the words of the text, and move the score
so that the threshold of any language is 0.3.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.scratch import sample_share, small_batches, unit
from assayframe.llm.text import Slice, mix, slices, trimmed, words

BITS = 16
STEMS = (3, 4, 5, 6)
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Rows and characters of each label that training takes on average.
SAMPLE_ROWS = 3500
SAMPLE_CHARS = 14_000_000
EPOCHS = 4
THRESHOLD = 0.3
#: A language with fewer toxic rows aside from training gets the threshold of all.
LEAST_TOXIC = 15


def word_buckets(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, one column for the word and each stem, and where rows begin."""
    found, stems = words(part, STEMS)
    columns = [(mix(h + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.uint16) for k, h in enumerate([found.hashes, *stems])]
    return np.stack(columns, axis=1), found.offsets


@dataclass
class ToxicityModel:
    table: np.ndarray
    taps: list[np.ndarray]  # for each width: width, dimension, filter
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float
    languages: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    threshold: float = 0.0  # as logits, like those of the languages

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        x = self.table[buckets[:, 0]]
        for k in range(1, buckets.shape[1]):
            x += self.table[buckets[:, k]]
        return x

    def responses(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each filter's response at each word; what lies beyond the end of the text is zero."""
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        out = []
        for taps in self.taps:
            z = x @ taps[0]
            for k in range(1, len(taps)):
                if len(x) > k:
                    z[:-k] += (x[k:] @ taps[k]) * (row[k:] == row[:-k])[:, None]
            out.append(z)
        return np.concatenate(out, axis=1)

    def pooled(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        top = np.full((len(offsets) - 1, len(self.out)), -np.inf, np.float32)
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            top[some] = np.maximum.reduceat(self.responses(self.embed(buckets), offsets), offsets[:-1][some], axis=0)
        return np.maximum(top + np.concatenate(self.shift), 0)

    def logits(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.pooled(buckets, offsets) @ self.out + self.bias

    def language(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Place of the likeliest language; -1 without words or languages."""
        best = np.full(len(offsets) - 1, -1)
        some = np.flatnonzero(np.diff(offsets))
        if len(some) and self.languages.shape[1]:
            best[some] = np.add.reduceat(self.languages[buckets[:, 0]], offsets[:-1][some], axis=0).argmax(axis=1)
        return best

    def scores(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        limits = np.append(self.thresholds, self.threshold)[self.language(buckets, offsets)]
        z = self.logits(buckets, offsets).astype(float) - limits + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def evidence(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """For each bucket a cautious log ratio of how often toxic and other rows have it, not below 0.

    Two standard errors are taken off, so that what is rare says little.
    """
    seen = np.zeros((2, 1 << BITS))
    for buckets, y in zip(rows, toxic):
        seen[int(y), np.unique(buckets)] += 1
    n = [max(1, int((toxic == y).sum())) for y in (0, 1)]
    ratio = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    return np.maximum(ratio - 2 * np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5)), 0)


def start(rows: list[np.ndarray], toxic: np.ndarray, seed: int) -> ToxicityModel:
    """Small random numbers, but the first dimension holds the evidence and the first filters read it."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (1 << BITS, DIMENSIONS)).astype(np.float32)
    table[:, 0] = evidence(rows, toxic)
    taps = [rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for t in taps:
        t[:, 0, 0] = 1 / len(t)
    out = rng.normal(0, 0.05, FILTERS * len(WIDTHS)).astype(np.float32)
    out[::FILTERS] = 0.5
    rate = float(np.clip(toxic.mean(), 0.001, 0.999))
    return ToxicityModel(table, taps, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, float(np.log(rate / (1 - rate)) - 1))


def step(model: ToxicityModel, rows: list[np.ndarray], toxic: np.ndarray, squares: dict, rate: float) -> None:
    """One Adagrad step on some rows. Only the words under each filter's largest response get a gradient."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    buckets = np.concatenate(rows)
    x = model.embed(buckets)
    z = model.responses(x, offsets)
    shift = np.concatenate(model.shift)
    place = np.zeros((len(rows), z.shape[1]), np.int64)
    for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
        if hi > lo:
            place[i] = lo + z[lo:hi].argmax(axis=0)
    empty = np.diff(offsets) == 0
    top = z[np.minimum(place, len(z) - 1), np.arange(z.shape[1])] + shift if len(z) else np.zeros(place.shape)
    top[empty] = 0
    pooled = np.maximum(top, 0)
    g = (1 / (1 + np.exp(-np.clip(pooled @ model.out + model.bias, -30, 30))) - toxic) / len(rows)
    back = g[:, None] * model.out * (top > 0)

    def move(name, value, gradient):
        squares[name] = squares.get(name, 1e-6) + gradient**2
        value -= (rate * gradient / np.sqrt(squares[name])).astype(np.float32)

    touched, pulls = [], []
    for n, taps in enumerate(model.taps):
        mine = slice(n * FILTERS, (n + 1) * FILTERS)
        grads = np.zeros_like(taps)
        for k in range(len(taps)):
            at = place[:, mine] + k
            inside = at < offsets[1:, None]
            b = back[:, mine] * inside
            at = np.minimum(at, max(len(x) - 1, 0))
            for f in range(FILTERS):
                grads[k, :, f] = b[:, f] @ x[at[:, f]]
                live = np.flatnonzero(b[:, f])
                touched.append(at[live, f])
                pulls.append(b[live, f, None] * taps[k, :, f])
        move(("taps", n), taps, grads)
        move(("shift", n), model.shift[n], back[:, mine].sum(axis=0))
    at, pull = np.concatenate(touched), np.concatenate(pulls)
    if len(at):
        used, inverse = np.unique(buckets[at].ravel(), return_inverse=True)
        total = np.zeros((len(used), DIMENSIONS))
        np.add.at(total, inverse, np.repeat(pull, buckets.shape[1], axis=0))
        store = squares.setdefault("table", np.full((1 << BITS, DIMENSIONS), 1e-4, np.float32))
        store[used] += total**2
        model.table[used] -= (0.3 * rate * total / np.sqrt(store[used])).astype(np.float32)
    move("out", model.out, pooled.T @ g)
    squares["bias"] = squares.get("bias", 1e-6) + g.sum() ** 2
    model.bias -= rate * float(g.sum() / np.sqrt(squares["bias"]))


def _all(model: ToxicityModel, rows: list[np.ndarray]) -> np.ndarray:
    return np.array([model.logits(r, np.array([0, len(r)]))[0] for r in rows])


def _loss(z: np.ndarray, toxic: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - toxic * z)) if len(z) else 0.0


def best_cut(z: np.ndarray, toxic: np.ndarray) -> float:
    """The logit with the highest F1; among equals, the middle of the widest gap."""
    order = np.argsort(-z, kind="stable")
    z, toxic = z[order], toxic[order]
    hits = np.cumsum(toxic)
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + toxic.sum())
    gap = -np.diff(np.append(z, z[-1] - 1))
    f1 = np.where(gap > 0, f1, -1)
    at = max(np.flatnonzero(f1 >= f1.max() - 1e-12), key=lambda i: gap[i])
    return float(z[at] - gap[at] / 2)


def fit(texts: list[bytes], toxic: list[int], langs: list[str | None], epochs: int = EPOCHS, seed: int = 3) -> ToxicityModel:
    """Train on labelled texts; a quarter is kept aside to choose the epoch and set the thresholds."""
    y = np.array(toxic, float)
    rows = [word_buckets(part)[0] for t in texts for part in slices(pa.array([t], pa.binary()), 1 << 62)]
    if len(set(toxic)) < 2:  # nothing to tell apart
        model = start(rows, y if len(y) else np.zeros(1), seed)
        model.out[:] = 0
        return model
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside, train = order[:len(order) // 4], order[len(order) // 4:]
    if len(set(y[aside])) < 2 or len(set(y[train])) < 2:
        aside = train = order
    model = start([rows[i] for i in train], y[train], seed)
    squares: dict = {}
    best, least = None, np.inf
    for epoch in range(epochs):
        mixed = rng.permutation(train)
        for i in range(0, len(mixed), 64):
            some = mixed[i:i + 64]
            step(model, [rows[j] for j in some], y[some], squares, 0.05)
        loss = _loss(_all(model, [rows[i] for i in aside]), y[aside])
        if loss < least:
            best, least = pickle.dumps(model), loss
    model = pickle.loads(best)

    known = sorted({x for x in langs if x is not None})
    counts = np.full((1 << BITS, len(known)), 0.5)
    for r, x in zip(rows, langs):
        if x is not None:
            np.add.at(counts[:, known.index(x)], r[:, 0], 1)
    model.languages = (np.log(counts / counts.sum(axis=0)) if known else counts).astype(np.float32)
    z = _all(model, [rows[i] for i in aside])
    told = np.array([model.language(rows[i], np.array([0, len(rows[i])]))[0] for i in aside])
    model.threshold = best_cut(z, y[aside])
    model.thresholds = np.full(len(known), model.threshold)
    for k in range(len(known)):
        if y[aside][told == k].sum() >= LEAST_TOXIC:
            model.thresholds[k] = best_cut(z[told == k], y[aside][told == k])
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str | None = "lang",
    toxic: str = "toxic",
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
    seed: int = 7,
) -> ToxicityModel:
    """Learn from the documents that ``labels`` marks 0 or 1.

    The sample has about ``rows`` rows or ``chars`` characters of each label at most,
    whatever the tables' size; it is fitted on the driver. Null ids, labels and texts
    teach nothing. Languages, where given, only serve to set thresholds.
    """
    marked = labels.filter(F.col(toxic).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(toxic).cast("int").alias("_toxic")).distinct()
    own = unit(F.col("_id"), seed=seed)
    first = {r["by"]: min(1.0, 4 * rows / r["n"]) for r in marked.groupBy(F.col("_toxic").alias("by")).agg(F.count("*").alias("n")).collect()}
    if not first:
        return fit([], [], [])

    def cut(df, share):
        return df.filter(own < F.element_at(F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))]), F.col("_toxic")))

    # at most about 8 * rows labels are left, so they may be broadcast
    few = F.broadcast(cut(marked, first))
    joined = docs.filter(F.col(text).isNotNull()).join(few, F.col(doc_id) == F.col("_id")).select(
        "_id", "_toxic", F.col(text).alias("_text"), (F.col(lang).cast("string") if lang else F.lit(None).cast("string")).alias("_lang")
    )
    share = sample_share(joined, F.col("_toxic"), "_text", rows, chars)
    if not share:
        return fit([], [], [])
    sample = cut(joined, {k: first[k] * v for k, v in share.items()}).select(F.col("_text").cast("binary"), "_toxic", "_lang").collect()
    sample.sort(key=lambda r: (bytes(r[0]), r[1]))
    return fit([bytes(r[0]) for r in sample], [r[1] for r in sample], [r[2] for r in sample])


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """``keep`` (all columns of ``docs`` if None) and the score of each whole text, 0 to 1; 0.3 and more is toxic.

    Null and empty texts get the score of a text without words. A column of ``docs`` named
    as ``out`` gives way. Rows are independent; nothing is shuffled.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(held.value)
        for batch in batches:
            scores = [np.zeros(0), *(model.scores(*word_buckets(part)) for part in slices(batch.column(batch.schema.get_field_index(text)), 1 << 20))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(np.concatenate(scores))], names=[*kept, out]
            )

    return small_batches(docs).select(*dict.fromkeys([*kept, text])).mapInArrow(trimmed(run), ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), f"`{out}` double"]))


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """The documents under the threshold, with their columns as they were."""
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    return score(plain, model, text=f"_c{names.index(text)}", out="_score").filter(F.col("_score") < THRESHOLD).drop("_score").toDF(*names)
