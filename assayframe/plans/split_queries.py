"""Queries for splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.operators import cluster, profile, rows, split
from assayframe.plans import inputs as inp
from assayframe.plans.registry import query
from assayframe.runtime import cut_lineage, scratch_path
from assayframe.sources import tables

SEED = 7


def _groups_sql(source: str, group: str, shuffled: bool = False) -> str:
    """Groups of ``source`` numbered in filling order, and the number of rows."""
    base = f"""sizes AS (
  SELECT {group} AS grp, count(*) AS size, min(id) AS first_member FROM {source} GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY size DESC, first_member) AS rank FROM sizes)"""
    order = "rank"
    if shuffled:
        order = f"least(rank, 11), CASE WHEN rank > 10 THEN md5('{SEED}|' || first_member::VARCHAR) END NULLS FIRST, rank"
    return f"""{base},
groups AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {order}) AS ord FROM ranked),
total AS (SELECT count(*) AS n FROM {source})"""


def _walk_sql(train: str, val: str, first: bool) -> str:
    """One group after the other into the first split that has room."""
    fits_train = f"(tr + g.size <= {train}" + (" OR g.ord = 1)" if first else ")")
    fits_val = f"(NOT {fits_train} AND {val} > 0 AND va + g.size <= {val})"
    return f"""walk(ord, tr, va, role, grp) AS (
  SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, '', NULL::VARCHAR
  UNION ALL
  SELECT g.ord, CASE WHEN {fits_train} THEN tr + g.size ELSE tr END, CASE WHEN {fits_val} THEN va + g.size ELSE va END,
    CASE WHEN {fits_train} THEN 'train' WHEN {fits_val} THEN 'val' ELSE 'test' END, g.grp
  FROM walk JOIN groups g ON g.ord = walk.ord + 1)"""


def _share(ratio: float, whole: bool) -> str:
    text = f"({ratio}::DOUBLE * (SELECT n FROM total))"
    return f"trunc({text})" if whole else text


def _split_sql(train: float, val: float, *, whole: bool, shuffled: bool = False) -> str:
    walk = _walk_sql(_share(train, whole), _share(val, whole), whole)
    return f"""WITH RECURSIVE {inp.SCAFFOLDS_SQL}, {_groups_sql('scaffolds', 'scaffold', shuffled)}, {walk}
SELECT s.id, s.scaffold, w.role FROM scaffolds s JOIN walk w ON w.grp = s.scaffold AND w.ord > 0"""


@query("group_split", _split_sql(0.7, 0.15, whole=False))
def group_split(spark, sf_dir):
    df = inp.scaffolds(spark, sf_dir)
    return split.group_split(df, group="scaffold", key="id", train=0.7, val=0.15, test=0.15)


@query("group_split_no_val", _split_sql(0.8, 0.0, whole=False))
def group_split_no_val(spark, sf_dir):
    return split.group_split(inp.scaffolds(spark, sf_dir), group="scaffold", key="id")


@query("cluster_split", _split_sql(0.7, 0.15, whole=True))
def cluster_split(spark, sf_dir):
    df = inp.scaffolds(spark, sf_dir)
    return split.cluster_split(df, cluster="scaffold", key="id", train=0.7, val=0.15, test=0.15)


@query("shuffled_tail", _split_sql(0.7, 0.15, whole=True, shuffled=True))
def shuffled_tail(spark, sf_dir):
    df = inp.scaffolds(spark, sf_dir)
    return split.cluster_split(
        df, cluster="scaffold", key="id", train=0.7, val=0.15, test=0.15, shuffle_seed=SEED
    )


@query(
    "contiguous_kfold",
    """WITH n AS (SELECT ceil(count(*) / 5.0)::BIGINT - 1 AS step FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderkey, least((rn - 1) // step, 4)::INT AS fold FROM r, n""",
)
def contiguous_kfold(spark, sf_dir):
    return split.contiguous_kfold(inp.table(spark, sf_dir, "orders"), key="o_orderkey", n_folds=5)


BUCKETS = 16


@query(
    "bucketed_folds",
    """WITH n AS (SELECT ceil(count(*) / 5.0)::BIGINT - 1 AS step FROM orders),
r AS (SELECT o_orderkey, o_totalprice, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderkey, least((rn - 1) // step, 4)::INT AS fold, o_totalprice, o_orderstatus FROM r, n""",
)
def bucketed_folds(spark, sf_dir):
    """Folds and features kept in buckets of their key, the folds in a part for each fold, and joined from there."""
    orders = inp.table(spark, sf_dir, "orders")
    folds = split.contiguous_kfold(orders, key="o_orderkey", n_folds=5)
    kept = []
    for df, part in ((folds, ["fold"]), (orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), [])):
        path = scratch_path(spark, "bucketed")
        name = "bucketed_" + path.rsplit("-", 1)[1]
        tables.save_bucketed(df, name, key="o_orderkey", buckets=BUCKETS, path=path, partition_by=part)
        kept.append(tables.load_bucketed(spark, name, path=path, schema=df.schema, key="o_orderkey", buckets=BUCKETS, partition_by=part))
    return rows.folds_with_features(*kept, key="o_orderkey")


N_FOLDS = 5
N_REPEATS = 2
TEST_RATIO = 0.1


def _kfold_sql() -> str:
    """Clusters to test, then fold by fold first-fit, once per repeat."""
    parts = [
        f"""WITH RECURSIVE {inp.CUSTOMERS_ORDERS_SQL}, {_groups_sql('records', 'cluster')},
size AS (SELECT trunc({TEST_RATIO}::DOUBLE * n)::BIGINT AS test_size,
                floor((n - trunc({TEST_RATIO}::DOUBLE * n)) / {N_FOLDS})::BIGINT AS fold_size FROM total)"""
    ]
    for r in range(N_REPEATS):
        parts.append(
            f"""s{r} AS MATERIALIZED (SELECT grp, size,
  row_number() OVER (ORDER BY md5('{SEED + r}|' || first_member::VARCHAR), rank) AS ord FROM ranked),
small{r} AS (SELECT *, sum(size) OVER (ORDER BY ord) - size AS before FROM s{r} WHERE size <= 5),
test{r} AS MATERIALIZED (SELECT grp, size FROM small{r} WHERE before < (SELECT test_size FROM size)),
left{r}_0 AS MATERIALIZED (SELECT grp, size, row_number() OVER (ORDER BY ord) AS ord FROM s{r}
  WHERE grp NOT IN (SELECT grp FROM test{r}))"""
        )
        for f in range(N_FOLDS - 1):
            parts.append(
                f"""walk{r}_{f}(ord, filled, grp) AS (
  SELECT 0::BIGINT, 0::BIGINT, NULL::BIGINT
  UNION ALL
  SELECT g.ord, CASE WHEN filled + g.size <= (SELECT fold_size FROM size) THEN filled + g.size ELSE filled END,
    CASE WHEN filled + g.size <= (SELECT fold_size FROM size) THEN g.grp END
  FROM walk{r}_{f} w JOIN left{r}_{f} g ON g.ord = w.ord + 1),
fold{r}_{f} AS MATERIALIZED (SELECT grp FROM walk{r}_{f} WHERE grp IS NOT NULL),
left{r}_{f + 1} AS MATERIALIZED (SELECT grp, size, row_number() OVER (ORDER BY ord) AS ord FROM left{r}_{f}
  WHERE grp NOT IN (SELECT grp FROM fold{r}_{f}))"""
            )
        union = [f"SELECT {r} AS repeat, grp, -1 AS part FROM test{r}"]
        union += [f"SELECT {r}, grp, {f} FROM fold{r}_{f}" for f in range(N_FOLDS - 1)]
        union += [f"SELECT {r}, grp, {N_FOLDS - 1} FROM left{r}_{N_FOLDS - 1}"]
        parts.append(f"parts{r} AS MATERIALIZED ({' UNION ALL '.join(union)})")
    every = " UNION ALL ".join(f"SELECT * FROM parts{r}" for r in range(N_REPEATS))
    parts.append(f"parts AS MATERIALIZED ({every})")
    parts.append(
        f"""folds AS (
  SELECT p.repeat, f.fold, x.id,
    CASE WHEN p.part = -1 THEN 'test' WHEN p.part = f.fold THEN 'val' ELSE 'train' END AS role
  FROM records x JOIN parts p ON p.grp = x.cluster, (SELECT unnest(range(0, {N_FOLDS}))::INT AS fold) f)"""
    )
    return ",\n".join(parts) + "\n"


def _folds(spark, sf_dir):
    return split.cluster_kfold(
        inp.customers_orders(spark, sf_dir),
        cluster="cluster",
        key="id",
        n_folds=N_FOLDS,
        test_ratio=TEST_RATIO,
        n_repeats=N_REPEATS,
        seed=SEED,
    )


@query("cluster_kfold", f"{_kfold_sql()} SELECT repeat, fold, role, id FROM folds")
def cluster_kfold(spark, sf_dir):
    return _folds(spark, sf_dir)


@query(
    "folds_with_features",
    f"{_kfold_sql()} SELECT f.repeat, f.fold, f.role, f.id, x.label, x.price FROM folds f JOIN records x ON x.id = f.id",
)
def folds_with_features(spark, sf_dir):
    features = inp.customers_orders(spark, sf_dir).select("id", "label", "price")
    return rows.folds_with_features(_folds(spark, sf_dir), features, key="id")


def _ratio_sql(role: str) -> str:
    return f"""round(count(*) FILTER (f.role = '{role}' AND label = 1)::DOUBLE
  / nullif(count(*) FILTER (f.role = '{role}' AND label = 0), 0)::DOUBLE, 3) AS {role}_ratio"""


@query(
    "fold_class_ratios",
    f"""{_kfold_sql()} SELECT f.repeat, f.fold, {', '.join(_ratio_sql(r) for r in ('train', 'val', 'test'))}
FROM folds f JOIN records x ON x.id = f.id GROUP BY 1, 2""",
)
def fold_class_ratios(spark, sf_dir):
    features = inp.customers_orders(spark, sf_dir).select("id", "label")
    joined = rows.folds_with_features(_folds(spark, sf_dir), features, key="id")
    return profile.fold_class_ratios(joined, by=["repeat", "fold"], label="label")


SPREAD = ("0.45", "0.38", "0.3")


def _walk_sql(name: str, left: str) -> str:
    """One record at a time, level by level: picked if no neighbour on that level is."""
    return f"""{name}_steps AS (
  SELECT row_number() OVER (ORDER BY level, ord) AS s, vec_id, nb
  FROM (SELECT o.vec_id, o.ord, l.level, coalesce(n.nb, []) AS nb
        FROM o CROSS JOIN (SELECT unnest(range(0, {len(SPREAD)})) AS level) l
        LEFT JOIN nb n ON n.a = o.vec_id AND n.level = l.level WHERE {left})),
{name}_walk AS (
  SELECT 0::BIGINT AS s, []::BIGINT[] AS picked
  UNION ALL
  SELECT w.s + 1, CASE WHEN list_contains(w.picked, t.vec_id) OR list_has_any(w.picked, t.nb) THEN w.picked
                       ELSE list_append(w.picked, t.vec_id) END
  FROM {name}_walk w JOIN {name}_steps t ON t.s = w.s + 1),
{name}_picked AS MATERIALIZED (SELECT picked FROM {name}_walk ORDER BY s DESC LIMIT 1),
{name}_list AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY p, ord) - 1 AS pick
  FROM (SELECT o.vec_id, o.ord, coalesce(nullif(list_position(picked, o.vec_id), 0), 1000000000) AS p
        FROM o, {name}_picked WHERE {left}))"""


MAXMIN_SQL = f"""WITH RECURSIVE {inp.VECTORS_SQL},
o AS MATERIALIZED (SELECT vec_id, bits, md5('{SEED}|' || vec_id) || '|' || vec_id AS ord FROM vectors WHERE vec_id % 23 <> 0),
d AS (SELECT a.vec_id AS a, b.vec_id AS b, 2 * len(list_intersect(a.bits, b.bits)) AS c2, len(a.bits) + len(b.bits) AS n
      FROM o a JOIN o b ON a.vec_id <> b.vec_id),
nb AS MATERIALIZED (
  {' UNION ALL '.join(f"SELECT a, {i} AS level, list(b) AS nb FROM d WHERE 100 * c2 > {100 - round(float(x) * 100)} * n GROUP BY a" for i, x in enumerate(SPREAD))}),
sizes AS (SELECT round_even(count(*) * 0.7::DOUBLE, 0) AS n_train, round_even(count(*) * 0.15::DOUBLE, 0) AS n_val FROM o),
{_walk_sql('t', 'true')},
train AS MATERIALIZED (SELECT vec_id, pick FROM t_list, sizes WHERE pick < n_train),
{_walk_sql('v', 'o.vec_id NOT IN (SELECT vec_id FROM train)')}
SELECT vec_id, 'train' AS role, pick FROM train
UNION ALL
SELECT vec_id, CASE WHEN pick < n_val THEN 'val' ELSE 'test' END, CASE WHEN pick < n_val THEN pick ELSE -1 END FROM v_list, sizes
UNION ALL
SELECT vec_id, 'test', -1 FROM vectors WHERE vec_id % 23 = 0"""


@query("maxmin_split", MAXMIN_SQL)
def maxmin_split(spark, sf_dir):
    """One vector in 23 has no bits: it stays, as a test row."""
    df = inp.vectors(spark, sf_dir).withColumn("bits", F.when(F.col("vec_id") % 23 != 0, F.col("bits")))
    return split.maxmin_split(df, key="vec_id", tokens="bits", seed=SEED, levels=SPREAD, strategy="dense")


KEY_SPLIT_SQL = f"""WITH {inp.ASSAY_SQL},
c AS (SELECT DISTINCT compound FROM assay),
o AS (SELECT compound, row_number() OVER (ORDER BY md5('{SEED}|' || compound)) AS rn, count(*) OVER () AS n FROM c),
roles AS (
  SELECT compound, CASE WHEN rn <= round_even(n * 0.7::DOUBLE, 0) THEN 'train'
    WHEN rn <= round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.15::DOUBLE, 0) THEN 'val' ELSE 'test' END AS role FROM o),
split AS (SELECT a.id, a.compound, r.role FROM assay a JOIN roles r ON r.compound = a.compound)"""


def _key_split(spark, sf_dir):
    return split.key_disjoint_split(inp.assay(spark, sf_dir), compound="compound", key="id", seed=SEED)


@query("key_disjoint_split", f"{KEY_SPLIT_SQL} SELECT id, compound, role FROM split")
def key_disjoint_split(spark, sf_dir):
    return _key_split(spark, sf_dir)


@query(
    "split_audit",
    f"""{KEY_SPLIT_SQL}, m AS (SELECT compound, count(DISTINCT role) AS n FROM split GROUP BY 1)
SELECT role, count(*) AS n_rows, count(DISTINCT s.compound) AS n_compounds,
  count(DISTINCT s.compound) FILTER (m.n > 1) AS n_straddling
FROM split s JOIN m ON m.compound = s.compound GROUP BY 1""",
)
def split_audit(spark, sf_dir):
    return split.split_audit(_key_split(spark, sf_dir), compound="compound")
