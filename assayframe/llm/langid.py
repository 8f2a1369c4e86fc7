"""Language identification: multinomial logistic regression on character n-grams.

Features are TF-IDF weights of hashed n-grams of one to three characters. Term frequency
is the share of the text's n-grams, so the sum of weights times features is a mean over
the n-grams of the text and needs one table look-up each. Weights are trained by
follow-the-regularised-leader with an elastic net, which leaves most of them zero; a
temperature fitted on rows kept aside from training calibrates the scores.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.scratch import sample_share, small_batches, unit
from assayframe.llm.text import Slice, slices

BUCKETS = 1 << 15
ORDERS = 3
#: Rows and characters of each language that training takes on average.
SAMPLE_ROWS = 1200
SAMPLE_CHARS = 6_000_000
EPOCHS = 4
UNDETERMINED = "und"


def _fold_table() -> tuple[np.ndarray, np.ndarray]:
    """For each character of the basic plane: itself lower-cased if it is a letter, else 0."""
    fold, letter = np.zeros(0x10000, np.uint32), np.zeros(0x10000, bool)
    for c in range(0x10000):
        if chr(c).isalpha():
            low = chr(c).lower()
            fold[c], letter[c] = ord(low) if len(low) == 1 else c, True
    return fold, letter


_TABLES: list[np.ndarray] = []


def characters(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of a slice (0 for all but letters), and where each row's begin."""
    if not _TABLES:
        _TABLES.extend(_fold_table())
    text = part.data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    offsets = begins[part.offsets]
    if len(points) != begins[-1]:  # broken UTF-8: row by row
        rows = [np.frombuffer(part.text(i).decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for i in range(len(part.rows))]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        points = np.concatenate([np.zeros(0, np.uint32), *rows])
    folded = _TABLES[0][np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        c = chr(points[i])
        folded[i] = points[i] if c.isalpha() else 0
    return folded, offsets


def ngrams(folded: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each row, and where each row's begin.

    Runs of other characters count as one space, which stands at both ends of a row too;
    n-grams without a letter are left out.
    """
    n_rows = len(offsets) - 1
    # a space after each row parts it from the next one
    spaced = np.zeros(len(folded) + n_rows + 1, np.uint32)
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    spaced[np.arange(len(folded)) + row + 1] = folded
    owner = np.zeros(len(spaced), np.int64)
    owner[np.arange(len(folded)) + row + 1] = row
    owner[offsets[1:] + np.arange(n_rows) + 1] = np.arange(n_rows)
    keep = spaced != 0
    keep[1:] |= spaced[:-1] != 0
    keep[0] = True
    text, owner = spaced[keep].astype(np.uint64), owner[keep]
    made, owners = [], []
    for order in range(1, ORDERS + 1):
        if len(text) < order:
            continue
        m = len(text) - order + 1
        h = np.full(m, order, np.uint64)
        for k in range(order):
            h = (h ^ text[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        # an n-gram belongs to the row of its last letter and stays within one row
        if order == 1:
            good = text != 0
            own = owner
        elif order == 2:
            good = (text[:-1] != 0) | (text[1:] != 0)
            own = np.where(text[1:] != 0, owner[1:], owner[:-1])
        else:
            good = text[1:-1] != 0
            own = owner[1:-1]
        made.append((h >> np.uint64(64 - buckets.bit_length() + 1))[good].astype(np.int32))
        owners.append(own[good])
    if not made:
        return np.zeros(0, np.int32), np.zeros(n_rows + 1, np.int64)
    counts = sum(np.bincount(o, minlength=n_rows) for o in owners)
    out = np.concatenate([[0], np.cumsum(counts)])
    values = np.empty(out[-1], np.int32)
    at = out[:-1].copy()
    for v, o in zip(made, owners):
        size = np.bincount(o, minlength=n_rows)
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        values[np.arange(len(v)) + np.repeat(at - begin, size)] = v
        at += size
    return values, out


def document_frequencies(docs: DataFrame, text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all rows, and the number of texts.

    Each task sums its rows; buckets are added up by a shuffle. ``buckets`` numbers reach
    the driver, however many rows there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            n += len(batch)
            for part in slices(batch.column(0)):
                values, offsets = ngrams(*characters(part), buckets)
                for lo, hi in zip(offsets[:-1], offsets[1:]):
                    mark = np.zeros(buckets, bool)
                    mark[values[lo:hi]] = True
                    seen += mark
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], n))], names=["bucket", "n"])

    rows = small_batches(docs).select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found, n = np.zeros(buckets, np.int64), 0
    for bucket, count in rows:
        if bucket < 0:
            n = count
        else:
            found[bucket] = count
    return found, n


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # bucket, language; inverse document frequencies are in it
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Before calibration; rows without n-grams get the bias."""
        out = np.tile(self.bias, (len(offsets) - 1, 1))
        sizes = np.diff(offsets)
        some = np.flatnonzero(sizes)
        if len(some):
            out[some] += np.add.reduceat(self.weights[values], offsets[:-1][some], axis=0) / sizes[some, None]
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal steps with an elastic net, for all languages at once."""

    n_features: int
    n_classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self):
        self.z = np.zeros((self.n_features, self.n_classes))
        self.n = np.zeros((self.n_features, self.n_classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, at: np.ndarray, x: np.ndarray, truth: int) -> None:
        w = self.weights(at)
        p = softmax((x @ w)[None])[0]
        p[truth] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(texts: list[bytes], languages: list[str], frequencies: np.ndarray, n_texts: int, epochs: int = EPOCHS, seed: int = 11) -> LanguageModel:
    """Train on labelled texts; a fifth of them only sets the temperature."""
    names = sorted(set(languages))
    buckets = len(frequencies)
    if not names:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0))
    idf = np.log((1 + n_texts) / (1 + frequencies)) + 1
    scale = 30.0  # shares are small numbers; this brings the features near one
    rows = []
    for text in texts:
        part = next(slices(pa.array([text], pa.binary()), 1 << 62))
        values, _ = ngrams(*characters(part), buckets)
        at, counts = np.unique(values, return_counts=True)
        rows.append((np.append(at, buckets), np.append(scale * counts / max(len(values), 1) * idf[at], 1.0)))
    truth = [names.index(x) for x in languages]
    order = np.random.default_rng(seed).permutation(len(rows))
    aside, train = (order[:len(order) // 5], order[len(order) // 5:]) if len(order) >= 50 else (order[:0], order)
    model = Ftrl(buckets + 1, len(names))
    for epoch in range(epochs):
        for i in np.random.default_rng(seed + epoch).permutation(train):
            model.step(*rows[i], truth[i])
    w = model.weights()
    found = LanguageModel(names, (w[:-1] * (scale * idf)[:, None]).astype(np.float32), w[-1])
    if len(aside):
        logits = np.array([x @ w[at] for at, x in (rows[i] for i in aside)])
        want = np.array([truth[i] for i in aside])
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        loss = [-np.log(softmax(logits / t)[np.arange(len(want)), want] + 1e-12).mean() for t in grid]
        found.temperature = float(grid[int(np.argmin(loss))])
    return found


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, seed: int = 2) -> LanguageModel:
    """Learn from ``docs``: statistics from all rows, weights from a sample.

    The sample has about ``rows`` rows or ``chars`` characters of each language at most; it
    is the only thing fitted on the driver. Rows with a null language or text teach nothing
    but count for the statistics if they have text.
    """
    frequencies, n = document_frequencies(docs.filter(F.col(text).isNotNull()), text)
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    share = sample_share(labelled, F.col("lang"), "text", rows, chars)
    if not share:
        return fit([], [], frequencies, n)
    of = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    sample = labelled.filter(unit(F.col("key"), F.col("text"), seed=seed) < F.element_at(of, F.col("lang"))).select(F.col("text").cast("binary"), "lang").collect()
    sample.sort(key=lambda r: (r[1], bytes(r[0])))
    return fit([bytes(r[0]) for r in sample], [r[1] for r in sample], frequencies, n)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``docs`` if None), ``lang_pred`` and ``score`` of each whole text.

    ``und`` with score 0 if the text is null, has no letter, or the model knows no
    language. Columns of ``docs`` named lang_pred or score give way. Rows are independent:
    copies and long texts need nothing more, and nothing is shuffled.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    names = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(held.value)
        for batch in batches:
            best, scores = [], []
            for part in slices(batch.column(batch.schema.get_field_index(text)), 1 << 20):
                values, offsets = ngrams(*characters(part), len(model.weights))
                if names:
                    p = model.probabilities(model.logits(values, offsets))
                    empty = np.diff(offsets) == 0
                    best += [UNDETERMINED if e else names[k] for e, k in zip(empty, p.argmax(axis=1))]
                    scores.append(np.where(empty, 0.0, p.max(axis=1)))
                else:
                    best += [UNDETERMINED] * len(part.rows)
                    scores.append(np.zeros(len(part.rows)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(best, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))],
                names=[*kept, "lang_pred", "score"],
            )

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "lang_pred string", "score double"])
    return small_batches(docs).select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
