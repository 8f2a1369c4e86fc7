"""Queries for similarity, distances and clustering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from assayframe.functions import fingerprint as fp
from assayframe.functions import user
from assayframe.operators import cluster, similarity
from assayframe.plans import inputs as inp
from assayframe.plans.registry import query
from assayframe.runtime import cut_lineage


def _neighbours(df, key, column):
    """Every record next to the one with the following key."""
    left = df.select(F.col(key).alias("a"), F.col(column).alias("x"))
    right = df.select((F.col(key) - 1).alias("a"), F.col(key).alias("b"), F.col(column).alias("y"))
    return left.join(right, "a")


SHARED = "len(list_intersect(p.bits, q.bits))"


@query(
    "tanimoto_bits",
    f"""WITH {inp.VECTORS_SQL}, t AS (
  SELECT p.vec_id AS a, q.vec_id AS b, {SHARED}::DOUBLE AS c, len(p.bits) + len(q.bits) AS s
  FROM vectors p JOIN vectors q ON q.vec_id = p.vec_id + 1)
SELECT a, b, round(c / (s - c), 6) AS tanimoto, round(c / (s - c), 6) AS tanimoto_packed FROM t""",
)
def tanimoto_bits(spark, sf_dir):
    pairs = _neighbours(inp.vectors(spark, sf_dir), "vec_id", "bits")
    x, y = F.col("x"), F.col("y")
    packed = fp.tanimoto_packed(fp.packed_words(x, 64), fp.packed_words(y, 64))
    return pairs.select("a", "b", F.round(fp.tanimoto(x, y), 6).alias("tanimoto"), F.round(packed, 6).alias("tanimoto_packed"))


COUNT_PAIRS = f"""WITH {inp.VECTORS_SQL}, t AS (
  SELECT p.vec_id AS a, q.vec_id AS b,
         list_sum(list_transform(range(1, 65), lambda i: least(p.counts[i], q.counts[i])))::DOUBLE AS c,
         (list_sum(p.counts) + list_sum(q.counts))::DOUBLE AS s
  FROM vectors p JOIN vectors q ON q.vec_id = p.vec_id + 1)"""


def _count_pairs(spark, sf_dir):
    df = inp.vectors(spark, sf_dir).select("vec_id", fp.count_tokens(F.col("counts"), 64).alias("tokens"))
    return _neighbours(df, "vec_id", "tokens")


@query("tanimoto_counts", f"{COUNT_PAIRS} SELECT a, b, CASE WHEN s = 0 THEN 1.0::DOUBLE ELSE round(c / (s - c), 6) END AS tanimoto FROM t")
def tanimoto_counts(spark, sf_dir):
    return _count_pairs(spark, sf_dir).select("a", "b", F.round(fp.tanimoto(F.col("x"), F.col("y")), 6).alias("tanimoto"))


@query("dice_distance", f"{COUNT_PAIRS} SELECT a, b, CASE WHEN s = 0 THEN 0.0::DOUBLE ELSE round(1 - 2 * c / s, 6) END AS dice FROM t")
def dice_distance(spark, sf_dir):
    return _count_pairs(spark, sf_dir).select("a", "b", F.round(fp.dice_distance(F.col("x"), F.col("y")), 6).alias("dice"))


@query(
    "unordered_pairs",
    f"""WITH n AS (SELECT ({inp.hash_sql('doc_id::VARCHAR')} % 4)::INT AS block, count(*) AS n FROM documents GROUP BY 1)
SELECT a.block AS block_a, b.block AS block_b,
  CASE WHEN a.block = b.block THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END AS n_pairs
FROM n a JOIN n b ON a.block <= b.block""",
)
def unordered_pairs(spark, sf_dir):
    return similarity.unordered_pairs(inp.table(spark, sf_dir, "documents"), key="doc_id", n_blocks=4)


ALL_PAIRS = f"""WITH {inp.VECTORS_SQL}, t AS (
  SELECT p.vec_id AS a, q.vec_id AS b, {SHARED}::DOUBLE AS c, len(p.bits) + len(q.bits) AS s
  FROM vectors p JOIN vectors q ON q.vec_id <> p.vec_id),
d AS (SELECT a, b, 1 - c / (s - c) AS distance FROM t)"""


@query(
    "pair_distances",
    f"""{ALL_PAIRS} SELECT a AS vec_id, count(*) AS n_others, round(sum(distance), 6) AS sum_distance,
  round(min(distance), 6) AS nearest, round(max(distance), 6) AS farthest FROM d GROUP BY 1""",
)
def pair_distances(spark, sf_dir):
    df = similarity.pair_distances(inp.vectors(spark, sf_dir), key="vec_id", tokens="bits", rows_per_block=256)
    return df.select("vec_id", "n_others", *[F.round(c, 6).alias(c) for c in ("sum_distance", "nearest", "farthest")])


@query(
    "average_tanimoto",
    f"""{ALL_PAIRS} SELECT (SELECT count(*) FROM vectors) AS n, round(1 - avg(distance), 6) AS avg_similarity,
  round(avg(distance), 6) AS avg_dissimilarity FROM d""",
)
def average_tanimoto(spark, sf_dir):
    df = similarity.average_tanimoto(inp.vectors(spark, sf_dir), key="vec_id", tokens="bits", rows_per_block=256)
    return df.select("n", *[F.round(c, 6).alias(c) for c in ("avg_similarity", "avg_dissimilarity")])


def _reps_sql(p: int, q: int) -> str:
    """Distinct fingerprints of the documents and their pairs from p/q on."""
    return f"""{inp.fingerprints_sql()},
reps AS MATERIALIZED (SELECT min(doc_id) AS rep, count(*) AS copies, tokens, len(tokens) AS n FROM fp GROUP BY tokens),
bits AS MATERIALIZED (SELECT rep, unnest(tokens) AS t FROM reps),
shared AS (SELECT x.rep AS a, y.rep AS b, count(*) AS common FROM bits x JOIN bits y ON x.t = y.t AND x.rep < y.rep GROUP BY 1, 2),
pairs AS MATERIALIZED (
  SELECT a, b, x.copies AS n_a, y.copies AS n_b, common, x.n + y.n - common AS total
  FROM shared JOIN reps x ON x.rep = a JOIN reps y ON y.rep = b
  WHERE common * {q} >= (x.n + y.n - common) * {p})"""


@query("similarity_pairs", f"WITH {_reps_sql(3, 5)} SELECT a, b, n_a, n_b, common, total FROM pairs")
def similarity_pairs(spark, sf_dir):
    reps = similarity.collapse_copies(cut_lineage(inp.fingerprints(spark, sf_dir)), key="doc_id", tokens="tokens")
    return similarity.similarity_pairs(reps, cutoff=(3, 5))


@query(
    "similarity_pairs_dense",
    f"""WITH {inp.VECTORS_SQL}, t AS (
  SELECT p.vec_id AS a, q.vec_id AS b, {SHARED} AS common, len(p.bits) + len(q.bits) AS s
  FROM vectors p JOIN vectors q ON q.vec_id > p.vec_id)
SELECT a, b, 1::BIGINT AS n_a, 1::BIGINT AS n_b, common, s - common AS total FROM t WHERE common * 5 >= (s - common) * 2""",
)
def similarity_pairs_dense(spark, sf_dir):
    reps = similarity.collapse_copies(inp.vectors(spark, sf_dir), key="vec_id", tokens="bits")
    return similarity.similarity_pairs(reps, cutoff=(2, 5), strategy="packed", n_bits=inp.EMBEDDING_SIZE)


DOT = "list_sum(list_transform(range(1, 65), lambda i: p.vector[i] * q.vector[i]))"
NORM_P = "sqrt(list_sum(list_transform(p.vector, lambda v: v * v)))"
NORM_Q = "sqrt(list_sum(list_transform(q.vector, lambda v: v * v)))"
EUCLIDEAN = "sqrt(list_sum(list_transform(range(1, 65), lambda i: (p.vector[i] - q.vector[i]) * (p.vector[i] - q.vector[i]))))"
MANHATTAN = "list_sum(list_transform(range(1, 65), lambda i: abs(p.vector[i] - q.vector[i])))"
SUMS = "(list_sum(list_transform(p.vector, lambda v: abs(v))) + list_sum(list_transform(q.vector, lambda v: abs(v))))"
NEXT = "FROM vectors p JOIN vectors q ON q.vec_id = p.vec_id + 1"


@query(
    "vector_distances",
    f"""WITH {inp.VECTORS_SQL}
SELECT p.vec_id AS a, q.vec_id AS b, round({DOT}, 6) AS dot, round({NORM_P}, 6) AS norm_left,
  round({EUCLIDEAN}, 6) AS euclidean, round({MANHATTAN}, 6) AS manhattan,
  round(1 - {DOT} / ({NORM_P} * {NORM_Q} + 1e-9), 6) AS cosine {NEXT}""",
)
def vector_distances(spark, sf_dir):
    df = similarity.vector_distances(_neighbours(inp.vectors(spark, sf_dir), "vec_id", "vector"), left="x", right="y")
    return df.select("a", "b", *[F.round(c, 6).alias(c) for c in ("dot", "norm_left", "euclidean", "manhattan", "cosine")])


@query(
    "normalized_distances",
    f"""WITH {inp.VECTORS_SQL}
SELECT p.vec_id AS a, q.vec_id AS b, round({EUCLIDEAN} / ({NORM_P} * {NORM_Q}), 6) AS normalized_euclidean,
  round({MANHATTAN} / {SUMS}, 6) AS normalized_manhattan {NEXT}""",
)
def normalized_distances(spark, sf_dir):
    pairs = _neighbours(inp.vectors(spark, sf_dir), "vec_id", "vector")
    df = similarity.normalized_distances(pairs, left="x", right="y")
    return df.select("a", "b", *[F.round(c, 6).alias(c) for c in ("normalized_euclidean", "normalized_manhattan")])


AVERAGES = {
    ("euclidean", False): EUCLIDEAN,
    ("euclidean", True): f"{EUCLIDEAN} / ({NORM_P} * {NORM_Q})",
    ("manhattan", False): MANHATTAN,
    ("manhattan", True): f"{MANHATTAN} / {SUMS}",
    ("cosine", False): f"1 - {DOT} / ({NORM_P} * {NORM_Q} + 1e-9)",
}


def _average(metric: str, normalize: bool) -> None:
    name = f"average_dissimilarity_{'normalized_' if normalize else ''}{metric}"
    sql = f"""WITH {inp.VECTORS_SQL}
SELECT (SELECT count(*) FROM vectors) AS n, round(avg({AVERAGES[metric, normalize]}), 6) AS average
FROM vectors p JOIN vectors q ON q.vec_id > p.vec_id"""

    @query(name, sql)
    def run(spark, sf_dir):
        df = similarity.average_dissimilarity(
            inp.vectors(spark, sf_dir), key="vec_id", vector="vector", metric=metric, normalize=normalize, rows_per_block=256
        )
        return df.select("n", F.round("average", 6).alias("average"))


for _metric, _normalize in AVERAGES:
    _average(_metric, _normalize)


def _largest_gap(a, b):
    """The largest difference of a component, of all rows of two matrices; missing ones do not count."""
    gap = np.full((len(a), len(b)), np.nan)
    if a.shape[1] and not (np.isnan(a).any() or np.isnan(b).any()):
        # row by row, so that what is worked on stays in the cache
        columns = np.ascontiguousarray(b.T)
        difference = np.empty_like(columns)
        for row, out in zip(a, gap):
            np.subtract(columns, row[:, None], out=difference)
            np.maximum.reduce(np.abs(difference, out=difference), axis=0, out=out)
        return gap
    for x, y in zip(a.T, b.T):
        difference = x[:, None] - y[None, :]
        np.fmax(gap, np.abs(difference, out=difference), out=gap)
    return gap


# The largest difference of a component, as a user's own distance.
@query(
    "user_distance",
    f"""WITH {inp.VECTORS_SQL}
SELECT (SELECT count(*) FROM vectors) AS n, round(avg(list_max(list_transform(range(1, 65), lambda i: abs(p.vector[i] - q.vector[i])))), 6) AS average
FROM vectors p JOIN vectors q ON q.vec_id > p.vec_id""",
)
def user_distance(spark, sf_dir):
    user.register_distance("largest_gap", _largest_gap, matrices=True)
    df = similarity.average_dissimilarity(inp.vectors(spark, sf_dir), key="vec_id", vector="vector", metric="largest_gap")
    return df.select("n", F.round("average", 6).alias("average"))


# --- groups and clusters -------------------------------------------------------------


@query(
    "group_by_scaffold",
    f"""WITH {inp.SCAFFOLDS_SQL},
g AS (SELECT scaffold, count(*) AS group_size, min(id) AS first_member FROM scaffolds GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY group_size DESC, first_member) AS group_rank FROM g)
SELECT s.id, s.scaffold, r.group_size, r.group_rank FROM scaffolds s JOIN r ON r.scaffold = s.scaffold""",
)
def group_by_scaffold(spark, sf_dir):
    return cluster.group_by_scaffold(inp.scaffolds(spark, sf_dir), scaffold="scaffold", key="id")


def greedy_sql(pairs: str, prefix: str = "") -> str:
    """The sequential clustering over ``pairs`` (id, other) in both directions and ``ids`` (id).

    One step takes the first record left in the order and removes it and its
    neighbours. Gives CTEs ending in ``{prefix}picked`` (leader, members).
    """
    p = prefix
    return f"""{p}nb AS MATERIALIZED (
  SELECT i.id, coalesce(list(o.other) FILTER (o.other IS NOT NULL), []) AS nbrs, count(o.other) AS deg
  FROM ids i LEFT JOIN {pairs} o ON o.id = i.id GROUP BY 1),
{p}steps(k, leader, members, remaining) AS (
  SELECT 0, NULL::BIGINT, []::BIGINT[], (SELECT list(id ORDER BY deg DESC, id) FROM {p}nb)
  UNION ALL
  SELECT k + 1, remaining[1],
         list_filter(remaining, lambda x: x = remaining[1] OR list_contains(n.nbrs, x)),
         list_filter(remaining, lambda x: x <> remaining[1] AND NOT list_contains(n.nbrs, x))
  FROM {p}steps s JOIN {p}nb n ON n.id = s.remaining[1]
  WHERE len(remaining) > 0),
{p}picked AS MATERIALIZED (SELECT leader, members FROM {p}steps WHERE k > 0)"""


@query(
    "leader_clusters",
    f"""WITH RECURSIVE {_reps_sql(3, 5)},
ids AS (SELECT doc_id AS id FROM fp),
near AS MATERIALIZED (
  SELECT x.doc_id AS id, y.doc_id AS other FROM fp x JOIN reps rx ON rx.tokens = x.tokens
    JOIN (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs UNION ALL SELECT rep, rep FROM reps) e ON e.a = rx.rep
    JOIN reps ry ON ry.rep = e.b JOIN fp y ON y.tokens = ry.tokens
  WHERE x.doc_id <> y.doc_id),
{greedy_sql('near')}
SELECT unnest(members) AS doc_id, leader AS cluster, len(members) AS cluster_size FROM picked""",
)
def leader_clusters(spark, sf_dir):
    return cluster.leader_clusters(inp.fingerprints(spark, sf_dir), key="doc_id", tokens="tokens", cutoff=(3, 5))


CUTOFFS = {"0.4": (2, 5), "0.5": (1, 2), "0.6": (3, 5), "0.7": (7, 10)}


def _sweep_sql() -> str:
    parts = [
        f"""WITH RECURSIVE {inp.VECTORS_SQL}, ids AS (SELECT vec_id AS id FROM vectors),
t AS MATERIALIZED (SELECT p.vec_id AS id, q.vec_id AS other, {SHARED} AS common, len(p.bits) + len(q.bits) AS s
  FROM vectors p JOIN vectors q ON q.vec_id <> p.vec_id)"""
    ]
    for i, (p, q) in enumerate(CUTOFFS.values()):
        parts.append(f"near{i} AS MATERIALIZED (SELECT id, other FROM t WHERE common * {q} >= (s - common) * {p})")
        parts.append(greedy_sql(f"near{i}", f"c{i}_"))
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS cutoff, count(*) AS n_clusters, max(len(members)) AS largest,
  count(*) FILTER (len(members) = 1) AS n_singletons FROM c{i}_picked"""
        for i, name in enumerate(CUTOFFS)
    )
    return ",\n".join(parts) + "\n" + rows


@query("cutoff_sweep", _sweep_sql())
def cutoff_sweep(spark, sf_dir):
    return cluster.cutoff_sweep(
        inp.vectors(spark, sf_dir), key="vec_id", tokens="bits", cutoffs=CUTOFFS, strategy="packed", n_bits=inp.EMBEDDING_SIZE
    )
