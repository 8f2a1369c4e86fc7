"""Similar pairs, distance summaries and average dissimilarity.

Records with the same fingerprint are collapsed to one representative with a
count before anything is paired, so a large group of copies costs one row.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.functions import vectors as vec
from assayframe.operators.blocks import (
    ROWS_PER_BLOCK,
    block_count,
    block_of,
    distance_sum,
    over_block_pairs,
    shared_pieces,
    shared_tokens,
    tile_blocks,
    tile_sides,
    to_tiles,
)
from assayframe.operators.manhattan import average_normalized_manhattan
from assayframe.operators.packed import packed_pairs
from assayframe.operators.prefixes import MOST_ROWS, prefix_pairs
from assayframe.operators.quantiles import BINS
from assayframe.operators.skew import attach
from assayframe.runtime import cut_lineage, one_row, small

# Size of the token frequency table. It is an array of this fixed length: tokens
# that share a slot share a frequency, which changes the order, not the result.
SLOTS = 1 << 20
# Records that share a token and are looked up by it; longer lists are left to other ways.
POSTING_ROWS = 1000


def token_digest(tokens: str) -> Column:
    """128 bits that stand for a token array wherever it is grouped or joined."""
    return F.md5(F.to_json(F.col(tokens)))


def collapse_copies(df: DataFrame, *, key: str, tokens: str) -> DataFrame:
    """(rep, tokens, copies): one row per distinct fingerprint, named by its lowest key.

    Copies are grouped by a digest, each group with one of its equal token arrays, so a
    key in more than one row is never met by a join. Records without a key count as
    copies; a fingerprint that only they have keeps its row, with a null ``rep``.
    Written once, as everything that follows reads it several times.
    """
    known = df.filter(F.col(tokens).isNotNull())
    counted = known.groupBy(token_digest(tokens).alias("digest")).agg(
        F.min(key).alias("rep"), F.any_value(F.col(tokens)).alias("tokens"), F.count(F.lit(1)).alias("copies")
    )
    return cut_lineage(counted.select("rep", "tokens", "copies"))


def copy_members(df: DataFrame, reps: DataFrame, *, key: str, tokens: str) -> DataFrame:
    """(key, rep, copies): which representative stands for each record."""
    records = df.filter(F.col(tokens).isNotNull()).select(key, token_digest(tokens).alias("digest"))
    named = reps.select("rep", "copies", token_digest("tokens").alias("digest"))
    return attach(records, named, ["digest"], "copies", [key]).select(key, "rep", "copies")


def as_fraction(cutoff) -> Fraction:
    """An exact cutoff from (p, q), a Fraction, or a decimal number."""
    value = Fraction(*cutoff) if isinstance(cutoff, tuple) else Fraction(str(cutoff))
    if not 0 < value <= 1:
        raise ValueError("the cutoff has to be above 0 and at most 1")
    return value


def _slot_ranks(tokens: DataFrame) -> Column:
    """How frequent the tokens of each slot are, as an array of SLOTS bytes.

    Frequency on a scale of half powers of two: enough to put rare tokens first,
    and one byte each, so that every task can hold the table.
    """
    slots = tokens.select(F.pmod(F.col("t"), F.lit(SLOTS)).cast("int").alias("slot"), F.lit(1).alias("n"))
    every = tokens.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"), F.lit(0).alias("n"))
    counted = slots.unionByName(every).groupBy("slot").agg(F.sum("n").alias("n"))
    rank = F.floor(2 * F.log2(F.greatest("n", F.lit(1)))).cast("byte")
    ordered = counted.agg(F.sort_array(F.collect_list(F.struct("slot", rank.alias("rank")))).alias("s"))
    return one_row(ordered.select(F.col("s.rank").alias("ranks")))["ranks"]


def _slot(ranks: Column, token: Column) -> Column:
    return F.get(ranks, F.pmod(token, F.lit(SLOTS)).cast("int"))


def rarest_first(sets: DataFrame, counted: DataFrame, *keep: str) -> DataFrame:
    """(rep, size, ranked): the tokens of each set, those rare among ``counted`` first, and the columns ``keep``.

    Any order is exact where prefixes are compared; this one gives the shortest lists.
    """
    frequency = _slot_ranks(counted.select(F.explode("tokens").alias("t")))
    return sets.select("rep", *keep, F.size("tokens").alias("size"), "tokens", frequency.alias("__f")).select(
        "rep",
        *keep,
        "size",
        F.transform(
            F.sort_array(F.transform("tokens", lambda t: F.struct(_slot(F.col("__f"), t).alias("f"), t.alias("t")))),
            lambda e: e["t"],
        ).alias("ranked"),
    )


def _qualifying_pairs(cutoff: Fraction):
    """Tile work: the pairs of a tile at or above the cutoff, compared in integers."""
    p, q = cutoff.numerator, cutoff.denominator

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = tile_sides(pdf, "rep")
        shared = shared_tokens(left["tokens"].tolist(), right["tokens"].tolist()).astype(np.int64)
        size_l = left["tokens"].map(len).to_numpy()
        size_r = right["tokens"].map(len).to_numpy()
        union = size_l[:, None] + size_r[None, :] - shared
        mask = shared * q >= union * p
        if same:
            mask = np.triu(mask, k=1)
        i, j = np.nonzero(mask)
        rep_i, rep_j = left["rep"].to_numpy()[i], right["rep"].to_numpy()[j]
        n_i, n_j = left["copies"].to_numpy()[i], right["copies"].to_numpy()[j]
        swap = rep_i > rep_j
        return pd.DataFrame(
            {
                "a": np.where(swap, rep_j, rep_i),
                "b": np.where(swap, rep_i, rep_j),
                "n_a": np.where(swap, n_j, n_i),
                "n_b": np.where(swap, n_i, n_j),
                "common": shared[i, j],
                "total": union[i, j],
            }
        )

    return run


def _pair_schema(reps: DataFrame) -> str:
    kind = reps.schema["rep"].dataType.simpleString()
    return f"a {kind}, b {kind}, n_a long, n_b long, common long, total long"


def _dense_pairs(reps: DataFrame, cutoff: Fraction, n_rows: int, rows_per_block: int) -> DataFrame:
    n_blocks = block_count(n_rows, rows_per_block)
    tiles = to_tiles(reps, block_of(F.col("rep"), n_blocks), F.lit(n_blocks))
    return tiles.groupBy("__lo", "__hi").applyInPandas(_qualifying_pairs(cutoff), _pair_schema(reps))


def _index_pairs(reps: DataFrame, cutoff: Fraction, most_rows: int) -> DataFrame:
    reps = reps.filter(F.size("tokens") > 0)
    return prefix_pairs(rarest_first(reps, reps, "copies"), cutoff, most_rows)


def similarity_pairs(
    reps: DataFrame,
    *,
    cutoff,
    strategy: str = "index",
    rows_per_block: int = ROWS_PER_BLOCK,
    posting_rows: int = MOST_ROWS,
    n_bits: int | None = None,
) -> DataFrame:
    """Pairs of distinct fingerprints with Tanimoto similarity at or above the cutoff.

    Takes the output of :func:`collapse_copies` and gives (a, b, n_a, n_b, common,
    total) with a < b. Copies of one fingerprint are not listed as pairs: they all
    have similarity 1 and are counted in ``copies``. A fingerprint with a null ``rep``
    has no name to be paired by and is in no pair.

    ``index`` looks up the rarest tokens and suits sparse fingerprints; its cost
    follows the lengths of the token lists, of at most ``posting_rows`` sets each. No
    table of candidates is written: a set is stored once, and read for each block it meets. ``packed`` suits narrow, full fingerprints
    of ``n_bits`` bits: it compares those whose numbers of bits are near enough, as words,
    in the JVM. ``dense`` compares blocks of rows of any tokens in Python. The cost of the
    last two is quadratic within what can be similar by size, or at all.
    """
    limit = as_fraction(cutoff)
    reps = reps.filter("rep IS NOT NULL")
    if strategy == "index":
        return _index_pairs(reps, limit, posting_rows)
    if strategy == "dense":
        return _dense_pairs(reps, limit, reps.count(), rows_per_block)
    if strategy == "packed":
        if n_bits is None:
            raise ValueError("packed pairs need n_bits")
        return packed_pairs(reps, limit, n_bits)
    raise ValueError(f"unknown strategy {strategy!r}: use 'index', 'packed' or 'dense'")


def unordered_pairs(df: DataFrame, *, key: str, n_blocks: int) -> DataFrame:
    """Number of unordered pairs of a set for each pair of hash blocks.

    Only the block sizes are counted; a row holds at most ``n_blocks`` of them.
    """
    sizes = df.groupBy(block_of(F.col(key), n_blocks).alias("block")).agg(F.count(F.lit(1)).alias("n"))
    every = sizes.agg(F.collect_list(F.struct("block", "n")).alias("sizes"))
    pairs = every.select("sizes", F.explode("sizes").alias("a")).select("a", F.explode("sizes").alias("b"))
    a, b = F.col("a"), F.col("b")
    n = F.when(a["block"] == b["block"], F.expr("a.n * (a.n - 1) div 2")).otherwise(a["n"] * b["n"])
    return (
        pairs.filter(a["block"] <= b["block"])
        .select(a["block"].alias("block_a"), b["block"].alias("block_b"), n.alias("n_pairs"))
        .filter("n_pairs > 0")
    )


def pair_distances(
    df: DataFrame, *, key: str, tokens: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """The distance matrix (1 - Tanimoto) summed up by record.

    One row per record: number of other records, and the sum, least and largest
    distance to them. The matrix itself is never written.
    """
    df = cut_lineage(df.select(key, tokens))
    # named by digests here: a key may be null or stand in several rows
    reps = cut_lineage(collapse_copies(df, key=key, tokens=tokens).withColumn("rep", token_digest("tokens")))
    schema = "rep string, n long, total double, nearest double, farthest double"

    def work(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        sides = (left,) if same else (left, right)
        tokens = [side["tokens"].tolist() for side in (left, right)]
        sizes = [np.array([len(x) for x in t], dtype=np.float64) for t in tokens]
        copies = [side["copies"].to_numpy().astype(np.float64) for side in (left, right)]
        total = [np.zeros(len(side)) for side in sides]
        nearest, farthest = ([np.full(len(side), far) for side in sides] for far in (np.inf, -np.inf))

        def add(side: int, rows: slice, distances: np.ndarray, others: np.ndarray) -> None:
            total[side][rows] += distances @ others

        def reach(side: int, rows: slice, least: np.ndarray, most: np.ndarray) -> None:
            nearest[side][rows] = np.minimum(nearest[side][rows], least)
            farthest[side][rows] = np.maximum(farthest[side][rows], most)

        for i, j, shared in shared_pieces(*tokens, same):
            shared = shared.astype(np.float64)
            union = sizes[0][i][:, None] + sizes[1][j][None, :]
            union -= shared
            # two empty sets are the same
            distances = np.divide(shared, union, out=np.ones_like(shared), where=union > 0)
            np.subtract(1, distances, out=distances)
            add(0, i, distances, copies[1][j])
            if same and i == j:
                np.fill_diagonal(distances, np.inf)
                least = distances.min(axis=1)
                np.fill_diagonal(distances, -np.inf)
                reach(0, i, least, distances.max(axis=1))
                continue
            reach(0, i, distances.min(axis=1), distances.max(axis=1))
            other = 0 if same else 1
            add(other, j, distances.T, copies[0][i])
            reach(other, j, distances.min(axis=0), distances.max(axis=0))
        parts = []
        for side, rows in enumerate(sides):
            others = left if same else sides[1 - side]
            n = int(others["copies"].sum()) - (rows["copies"].to_numpy() if same else 0)
            parts.append(pd.DataFrame({"rep": rows["rep"], "n": n, "total": total[side], "nearest": nearest[side], "farthest": farthest[side]})[np.isfinite(nearest[side])])
        return pd.concat(parts, ignore_index=True)

    sides = over_block_pairs(reps, "rep", tile_blocks(reps, "tokens", rows_per_block), work, schema)
    per_rep = sides.groupBy("rep").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("nearest").alias("nearest"),
        F.max("farthest").alias("farthest"),
    )
    full = reps.select("rep", "copies").join(per_rep, "rep", "left")
    own = F.col("copies") - 1
    nearest = F.when(own > 0, 0.0).otherwise(F.col("nearest"))
    farthest = F.coalesce(F.col("farthest"), F.when(own > 0, 0.0))
    full = full.select(
        "rep",
        "copies",
        (F.coalesce("n", F.lit(0)) + own).alias("n_others"),
        F.coalesce("total", F.lit(0.0)).alias("sum_distance"),
        nearest.alias("nearest"),
        farthest.alias("farthest"),
    )
    members = copy_members(df, reps, key=key, tokens=tokens)
    return attach(members.drop("copies"), full, ["rep"], "copies", [key]).select(
        key, "n_others", "sum_distance", "nearest", "farthest"
    )


def average_tanimoto(
    df: DataFrame, *, key: str, tokens: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Mean similarity and dissimilarity over all unordered pairs of records."""
    per_record = pair_distances(df, key=key, tokens=tokens, rows_per_block=rows_per_block)
    mean = F.try_divide(F.sum("sum_distance"), F.sum("n_others"))
    return per_record.agg(
        F.count(F.lit(1)).alias("n"), (1 - mean).alias("avg_similarity"), mean.alias("avg_dissimilarity")
    )


def vector_distances(df: DataFrame, *, left: str, right: str) -> DataFrame:
    """Add every distance measure between two vector columns."""
    a, b = F.col(left), F.col(right)
    return df.withColumns(
        {
            "dot": vec.dot(a, b),
            "norm_left": vec.norm(a),
            "euclidean": vec.euclidean(a, b),
            "manhattan": vec.manhattan(a, b),
            "cosine": vec.cosine(a, b),
        }
    )


def normalized_distances(df: DataFrame, *, left: str, right: str) -> DataFrame:
    """Add the normalised Euclidean and Manhattan distances of two vector columns."""
    a, b = F.col(left), F.col(right)
    return df.withColumns(
        {
            "normalized_euclidean": vec.normalized_euclidean(a, b),
            "normalized_manhattan": vec.normalized_manhattan(a, b),
        }
    )


def average_dissimilarity(
    df: DataFrame,
    *,
    key: str,
    vector: str,
    metric: str = "euclidean",
    normalize: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Mean distance over all unordered pairs of vectors, as one row (n, average).

    Manhattan and cosine have closed forms that need no pairs, and the normalised
    Manhattan distance needs a sort of each component, see :mod:`manhattan`. The others
    are summed up over pairs of blocks, one number per task. Fewer than two rows, or
    an undefined distance, give null.
    """
    measure = vec.distance(metric, normalize)  # unknown names are refused
    rows = df.filter(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias("v"))
    own = vec.USER_DISTANCES[metric] if metric in vec.MATRIX_DISTANCES else None
    if metric in vec.USER_DISTANCES and own is None:
        return _average_of(rows, key, measure)
    if metric == "cosine":
        return _average_cosine(rows)
    if metric == "manhattan" and not normalize:
        return _average_manhattan(rows)
    if metric == "manhattan":
        average = average_normalized_manhattan(rows)
        if average is not None:
            return average

    def work(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"pairs": [0], "total": [0.0]})
        a, b = np.array(left["v"].tolist()), np.array(right["v"].tolist())
        n_pairs = len(a) * (len(a) - 1) // 2 if same else len(a) * len(b)
        return pd.DataFrame({"pairs": [n_pairs], "total": [distance_sum(a, b, own or metric, normalize, same)]})

    # a number of its own for each row: a key may be null or stand in several
    rows = cut_lineage(rows.select("v", F.xxhash64(key, F.monotonically_increasing_id()).alias("__id")))
    sums = over_block_pairs(rows, "__id", tile_blocks(rows, "v", rows_per_block), work, "pairs long, total double")
    n = one_row(rows.agg(F.count(F.lit(1)).alias("n")))["n"]
    average = F.try_divide(F.sum("total"), F.sum("pairs"))
    return sums.agg(average.alias("average")).select(
        n.alias("n"), F.when(~F.isnan("average"), F.col("average")).alias("average")
    )


def _average_of(rows: DataFrame, key: str, measure) -> DataFrame:
    """The mean of a column expression over all pairs, in a grid of blocks with a tile for each few tasks."""
    rows = cut_lineage(rows.select("v", F.xxhash64(key, F.monotonically_increasing_id()).alias("__id")))
    n = rows.count()
    side = max(1, min(n, ceil(sqrt(2 * rows.sparkSession.sparkContext.defaultParallelism))))
    block = F.pmod("__id", F.lit(side)).cast("int")
    left = rows.select(F.col("v").alias("x"), F.col("__id").alias("i"), block.alias("at"), F.explode(F.sequence(block, F.lit(side - 1))).alias("to"))
    right = rows.select(F.col("v").alias("y"), F.col("__id").alias("j"), block.alias("here"), F.explode(F.sequence(F.lit(0), block)).alias("there"))
    once = (F.col("at") < F.col("to")) | (F.col("i") < F.col("j"))
    pairs = left.hint("shuffle_hash").join(right, (F.col("at") == F.col("there")) & (F.col("to") == F.col("here")) & once)
    d = measure(F.col("x"), F.col("y"))
    mean = pairs.agg(F.when(F.count(d) == F.count(F.lit(1)), F.avg(d)).alias("average"))
    return mean.select(F.lit(n).cast("long").alias("n"), "average")


def _average_cosine(rows: DataFrame) -> DataFrame:
    # Sum of the unit vectors u: the dot products of all ordered pairs of
    # different rows add up to |sum u|^2 minus the number of non-zero rows.
    length = vec.norm(F.col("v"))
    units = rows.select("v", length.alias("length"))
    per_dim = (
        units.select(F.posexplode("v").alias("dim", "x"), "length")
        .groupBy("dim")
        .agg(F.sum(F.when(F.col("length") > 0, F.col("x") / F.col("length")).otherwise(0.0)).alias("s"))
    )
    square = one_row(per_dim.agg(F.sum(F.col("s") * F.col("s")).alias("square")))["square"]
    return units.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("length") > 0).alias("known")
    ).select(
        "n",
        (
            1
            - F.try_divide(square - F.col("known"), (F.col("n") * (F.col("n") - 1)).cast("double"))
        ).alias("average"),
    )


def _average_manhattan(rows: DataFrame) -> DataFrame:
    # Per dimension, the value at rank r of n adds (2r - n - 1) * x over all
    # pairs. Ranks come from counts of equal-width bins plus a sort inside a bin.
    values = (
        rows.select(F.posexplode("v").alias("dim", "x"))
        .groupBy("dim", "x")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    extent = small(
        values.groupBy("dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("times").alias("n"))
    )
    binned = values.join(extent, "dim").withColumn(
        "bin",
        F.when(
            F.col("hi") > F.col("lo"),
            F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS),
        ).otherwise(0),
    )
    binned = cut_lineage(binned)
    starts = binned.groupBy("dim", "bin").agg(F.sum("times").alias("in_bin"))
    starts = starts.withColumn(
        "bin_start", F.sum("in_bin").over(Window.partitionBy("dim").orderBy("bin")) - F.col("in_bin")
    ).drop("in_bin")
    within = Window.partitionBy("dim", "bin").orderBy("x")
    ranked = binned.join(starts, ["dim", "bin"]).withColumn(
        "start", F.col("bin_start") + F.sum("times").over(within) - F.col("times")
    )
    weight = F.col("times") * (2 * F.col("start") + F.col("times") - F.col("n"))
    per_dim = ranked.groupBy("dim").agg(
        F.sum(weight * F.col("x")).alias("total"), F.max("n").alias("n")
    )
    pairs = F.max("n").cast("double") * (F.max("n") - 1) / 2
    return per_dim.agg(
        F.max("n").alias("n"),
        F.when(F.max("n") > 1, F.try_divide(F.sum("total"), pairs)).alias("average"),
    )
