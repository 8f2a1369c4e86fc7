"""Mixing sources to target weights by fitting subset sums.

Each source gets a target number of words. Whole passes over a source come first; for
what remains, documents are counted by their exact length. Every length gives the same
share of its documents, and a bounded-knapsack program over the lengths left spends the
last words exactly. Within a length, documents are taken in a seeded order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.scratch import stored
from assayframe.operators.skew import number_rows

WEIGHTS = (3, 1, 2)
SEED = 20
BINS = 4096
#: Words that the program spends at least; it may hold twice the shortest document.
PROGRAM = 1 << 15
#: So many cuts (short rows, one for each source and length) are broadcast; more are joined by a shuffle.
BROADCAST_CUTS = 200_000
#: Below every hash.
LOWEST = -(1 << 63)

_MADE = ("size", "source_size", "target", "taken")


def word_count(text: F.Column) -> F.Column:
    """Number of runs without a space or a character from tab to carriage return; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """From ``source`` and ``source_size`` (one row per source), each source's ``target``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all
    words. A target stops at ``most`` times its source; the excess goes to the others by
    weight until none is above. That is one level for all: targets are the smaller of the
    stop and level times weight, and the sources that stop are the first ones by
    stop / weight. One row per source is sorted as a whole.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("stop", F.col("source_size") * most).withColumn("at", F.col("stop") / F.col("weight"))
    by_stop = Window.orderBy("at", F.asc_nulls_last("source"))
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levelled = weighed.withColumn("level", level)
    chosen = F.min(F.when(F.col("level") < F.col("at"), F.struct("at", "level"))).over(everything)["level"]
    return levelled.select("source", "source_size", F.coalesce(F.least(F.col("stop"), chosen * F.col("weight")), F.col("stop")).alias("target"))


def fit(counts: list[tuple[int, int]], budget: int, program: int = PROGRAM) -> dict[int, int]:
    """How many documents of each length sum to ``budget``, or as near below as the program gets.

    ``counts``: (length, number of documents), lengths over 0. A program that misses is
    given more words to spend, twice.
    """
    counts = sorted(counts)
    total = sum(n * c for n, c in counts)
    if budget >= total:
        return dict(counts)
    best, missed = {}, budget + 1
    for floor in (max(program, 2 * counts[0][0]) * 4**i for i in range(3)):
        taken = _fit_once(counts, total, budget, floor)
        left = budget - sum(n * t for n, t in taken.items())
        if left < missed:
            best, missed = taken, left
        if not missed:
            break
    return best


def _fit_once(counts: list[tuple[int, int]], total: int, budget: int, floor: int) -> dict[int, int]:
    taken = {n: c * budget // total for n, c in counts}
    left = budget - sum(n * t for n, t in taken.items())
    spare = {n: c - taken[n] for n, c in counts}
    # what rounding left over: one more of the lengths that lost most by it, then as many as fit
    for n, c in sorted(counts, key=lambda x: (-(x[1] * budget % total), x[0])):
        if spare[n] and left - n >= floor:
            taken[n], spare[n], left = taken[n] + 1, spare[n] - 1, left - n
    for n, _ in reversed(counts):
        more = max(0, min(spare[n], (left - floor) // n))
        taken[n], spare[n], left = taken[n] + more, spare[n] - more, left - more * n
    # or the shares of the longest are given back until the program has enough to spend
    for n, _ in reversed(counts):
        back = min(taken[n], max(0, -(-(floor - left) // n)))
        taken[n], spare[n], left = taken[n] - back, spare[n] + back, left + back * n
    for n, more in knapsack([(n, spare[n]) for n, _ in counts if spare[n] and n <= left], left).items():
        taken[n] += more
    return taken


def knapsack(spare: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """Bounded knapsack over sums up to ``budget``: the numbers of each length whose sum is largest.

    Bit s of ``reach`` says whether the sum s can be made. Numbers are split into powers
    of two; the program ends as soon as the budget is reached.
    """
    reach, goal, steps = 1, 1 << budget, []
    for n, c in spare:
        c, power = min(c, budget // n), 1
        while c and not reach & goal:
            some = min(power, c)
            wider = reach | (reach << n * some) & ((goal << 1) - 1)
            if wider != reach:
                steps.append((n, some, reach))
            reach = wider
            c -= some
            power *= 2
    sum_, used = reach.bit_length() - 1, {}
    for n, some, before in reversed(steps):
        if not before >> sum_ & 1:
            used[n] = used.get(n, 0) + some
            sum_ -= n * some
    return used


def plan(counts: DataFrame, sources: DataFrame, program: int = PROGRAM) -> DataFrame:
    """For each source and length: ``passes`` whole passes and ``extra`` documents taken once more.

    ``counts``: source, size, n. One source's distinct lengths meet in one task: at most as
    many as its longest document has words, however many documents there are.
    """
    schema = "source string, size bigint, extra bigint"

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        budget = rows["budget"][0].as_py()
        took = fit(list(zip(rows["size"].to_pylist(), rows["n"].to_pylist())), budget, program)
        return pa.table({"source": pa.array([key[0].as_py()] * len(took), pa.string()), "size": pa.array(list(took), pa.int64()), "extra": pa.array(list(took.values()), pa.int64())})

    fitted = (
        counts.filter("size > 0")
        .join(sources.filter("budget > 0").select(F.col("source").alias("of"), "budget"), F.col("source").eqNullSafe(F.col("of")))
        .select("source", "size", "n", "budget")
        .groupBy("source")
        .applyInArrow(run, schema)
    )
    return fitted.filter("extra > 0")


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple[float, ...] = WEIGHTS,
    seed: int = SEED,
    program: int = PROGRAM,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    A document is taken whole, as often as ``taken / size``; at most ``most`` times.
    Columns of ``docs`` with those four names give way. The same rows give the same mix.

    Null and empty texts have size 0 and take 0 words. A null source is a source of its
    own. Equal rows are told apart only by number. An empty table gives an empty table.

    Documents of one source and length, which copies may make very many, stand in the
    order of a seeded hash. For each length a cut says up to which hash its documents
    are taken once more; it is found from counts of hash bins, then from the hashes of
    the one bin where the number runs out. So texts are read twice and never shuffled:
    documents meet the cuts, one row for each source and length, by a counted broadcast.
    Only rows that share the very hash of a cut are numbered, over all tasks.
    """
    kept = docs.select(*[c for c in docs.columns if c not in _MADE])
    own = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    rows = kept.withColumns({"_mix_source": F.col(source).cast("string"), "_mix_size": word_count(F.col(text)), "_mix_hash": own})
    hashes = stored(rows.select(F.col("_mix_source").alias("source"), F.col("_mix_size").alias("size"), F.col("_mix_hash").alias("hash")), "mix-hashes")
    keys = stored(hashes.groupBy("source", "size", _bin("hash").alias("bin")).agg(F.count("*").alias("n")), "mix-bins")
    counts = keys.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    wanted = targets(sizes, share, most, weights)
    words = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0))
    sources = stored(wanted.withColumn("passes", passes).withColumn("budget", words - F.col("passes") * F.col("source_size")), "mix-sources")
    extra = stored(plan(counts, sources, program), "mix-plan")
    cuts = stored(_cuts(hashes, keys, extra, sources), "mix-cuts")

    def met(some: DataFrame) -> DataFrame:
        mine = F.col("_mix_source").eqNullSafe(F.col("_cut_source")) & (F.col("_mix_size") == F.col("_cut_size"))
        named = cuts.toDF("_cut_source", "_cut_size", "_mix_source_size", "_mix_target", "_mix_passes", "_mix_bin", "_mix_cut", "_mix_ties")
        return some.join(F.broadcast(named) if cuts.count() <= BROADCAST_CUTS else named, mine)

    def out(some: DataFrame, more: F.Column) -> DataFrame:
        return some.select(
            *kept.columns,
            F.col("_mix_size").alias("size"),
            F.col("_mix_source_size").alias("source_size"),
            F.col("_mix_target").alias("target"),
            (F.col("_mix_size") * (F.col("_mix_passes") + more.cast("long"))).alias("taken"),
        )

    decided = met(rows)
    own_bin = _bin("_mix_hash")
    below = (own_bin < F.col("_mix_bin")) | (own_bin == F.col("_mix_bin")) & (F.col("_mix_hash") < F.coalesce("_mix_cut", F.lit(LOWEST)))
    if cuts.filter("ties > 0").isEmpty():
        return out(decided, below)
    tied = F.coalesce((F.col("_mix_ties") > 0) & (F.col("_mix_hash") == F.col("_mix_cut")), F.lit(False))
    apart = decided.filter(tied).withColumn("_mix_row", F.monotonically_increasing_id())
    numbered = number_rows(apart, ["_mix_source", "_mix_size", doc_id, "_mix_row"], "_mix_place")
    # one row for each cut that rows share
    first = numbered.groupBy("_mix_source", "_mix_size").agg(F.min("_mix_place").alias("first")).toDF("s", "l", "first")
    placed = numbered.join(first, F.col("_mix_source").eqNullSafe(F.col("s")) & (F.col("_mix_size") == F.col("l")))
    return out(decided.filter(~tied), below).unionByName(out(placed, F.col("_mix_place") - F.col("first") < F.col("_mix_ties")))


def _bin(column: str) -> F.Column:
    return F.pmod(column, F.lit(BINS))


def _cuts(hashes: DataFrame, keys: DataFrame, extra: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, size, source_size, target, passes, bin, cut, ties) for each source and length.

    Documents of bins below ``bin`` are taken once more, and so are those of this bin
    with a hash below ``cut`` (none if it is null), and ``ties`` of those whose hash it is.
    """
    wanted = extra.select(F.col("source").alias("s"), F.col("size").alias("l"), "extra")
    up_to = Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = keys.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("l")), "left").withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    left = F.coalesce("extra", F.lit(0)) - F.col("before")
    # the first bin that is not taken whole
    at = bins.withColumn("left", F.greatest(left, F.lit(0))).filter(F.col("left") < F.col("n")).groupBy("source", "size").agg(F.min("bin").alias("bin"), F.max_by("left", -F.col("bin")).alias("left"))
    every = keys.groupBy("source", "size").agg(F.count("*").alias("n_bins"))
    at = at.select(F.col("source").alias("s"), F.col("size").alias("l"), "bin", "left")
    ends = stored(every.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("l")), "left").select("source", "size", F.coalesce("bin", F.lit(BINS).cast("long")).alias("bin"), F.coalesce("left", F.lit(0)).alias("left")), "mix-ends")

    cut = ends.filter("left > 0").select(F.col("source").alias("s"), F.col("size").alias("l"), F.col("bin").alias("b"), "left")
    inside = hashes.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("l")) & (_bin("hash") == F.col("b")))
    times = inside.groupBy("source", "size", "hash", "left").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the first hash whose rows are not all taken
    over = times.withColumn("before", before).filter(F.col("before") + F.col("n") > F.col("left"))
    found = over.groupBy("source", "size").agg(F.min("hash").alias("cut"), F.greatest(F.max(F.col("left") - F.col("before")), F.lit(0)).alias("ties"))
    found = found.select(F.col("source").alias("s"), F.col("size").alias("l"), "cut", "ties")
    cuts = ends.join(found, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("l")), "left").drop("s", "l")
    per_source = sources.select(F.col("source").alias("s"), "source_size", "target", "passes")
    return cuts.join(per_source, F.col("source").eqNullSafe(F.col("s"))).select("source", "size", "source_size", "target", "passes", "bin", "cut", F.coalesce("ties", F.lit(0)).cast("long").alias("ties"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``.

    Documents without words cost nothing and are kept once.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    for role in ("doc_id", "source", "text"):
        options[role] = f"_c{names.index(options.get(role, role))}"
    mixed = mix(plain, **options)
    times = F.when(F.col("size") == 0, 1).otherwise((F.col("taken") / F.col("size")).cast("int"))
    return mixed.withColumn("times", times).filter("times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*plain.columns).toDF(*names)
