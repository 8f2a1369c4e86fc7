"""Queries for the domain of applicability, model evaluation and scoring."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayframe.functions import user
from assayframe.functions.metrics import METRICS
from assayframe.functions.structure import halogen_count, heavy_atom_count, largest_fragment
from assayframe.operators import domain, evaluate, features, impute, model, profile, rows, search, split
from assayframe.plans import inputs as inp
from assayframe.plans.registry import query
from assayframe.plans.table_queries import elements_sql
from assayframe.runtime import cut_lineage, scratch_path
from assayframe.sources import tables
from assayframe.streaming.score import score_stream

K = 5

# --- domain of applicability ------------------------------------------------------

KNN_SQL = f"""WITH {inp.VECTORS_SQL}, t AS (
  SELECT p.vec_id, p.role, len(list_intersect(p.bits, q.bits))::DOUBLE AS c, len(p.bits) + len(q.bits) AS s
  FROM vectors p JOIN vectors q ON q.role = 'train'),
d AS (SELECT vec_id, role, 1 - c / (s - c) AS distance FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance) AS rn FROM d),
near AS MATERIALIZED (
  SELECT vec_id, role, avg(distance) AS mean_distance, min(distance) AS nearest, max(distance) AS farthest
  FROM r WHERE rn <= {K} GROUP BY 1, 2),
profile AS MATERIALIZED (
  SELECT round(min(mean_distance), 3) AS min_distance, round(max(mean_distance), 3) AS max_distance,
         round(avg(mean_distance), 3) AS avg_distance, count(*) AS n_train,
         round(quantile_cont(mean_distance, 0.75), 3) AS percentile
  FROM near WHERE role = 'train'),
grid AS (SELECT unnest(range(0, greatest(ceil((max_distance - percentile) / 0.05), 0)::BIGINT + 2)) AS i, percentile, max_distance
         FROM profile),
shares AS (
  SELECT i, percentile + i * 0.05::DOUBLE AS threshold, max_distance,
         (SELECT count(*) FILTER (mean_distance <= percentile + i * 0.05::DOUBLE)::DOUBLE / count(*)
          FROM near WHERE role = 'test') AS share FROM grid),
threshold AS MATERIALIZED (
  SELECT threshold FROM shares WHERE share >= 0.9 OR threshold >= max_distance ORDER BY i LIMIT 1)"""


def _knn(spark, sf_dir):
    """Every vector against the training vectors, with its role."""
    df = inp.vectors(spark, sf_dir).select("vec_id", "bits", "role")
    near = domain.knn_distances(
        df, df.filter("role = 'train'"), key="vec_id", features="bits", k=K, strategy="cells", rows_per_block=256
    )
    return near.join(df.select("vec_id", "role"), "vec_id")


def _sides(spark, sf_dir):
    near = cut_lineage(_knn(spark, sf_dir).select("vec_id", "role", "mean_distance"))
    return near.filter("role = 'train'"), near.filter("role = 'test'")


@query(
    "knn_distances",
    f"""{KNN_SQL} SELECT vec_id, role, round(mean_distance, 6) AS mean_distance, round(nearest, 6) AS nearest,
  round(farthest, 6) AS farthest FROM near""",
)
def knn_distances(spark, sf_dir):
    return _knn(spark, sf_dir).select(
        "vec_id",
        "role",
        F.round("mean_distance", 6).alias("mean_distance"),
        F.round(F.col("distances")[0], 6).alias("nearest"),
        F.round(F.col("distances")[K - 1], 6).alias("farthest"),
    )


@query(
    "knn_distances_euclidean",
    f"""WITH {inp.VECTORS_SQL}, d AS (
  SELECT p.vec_id, sqrt(list_sum(list_transform(range(1, 65),
    lambda i: (p.vector[i] - q.vector[i]) * (p.vector[i] - q.vector[i])))) AS distance
  FROM vectors p JOIN vectors q ON q.role = 'train'),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance) AS rn FROM d)
SELECT vec_id, round(avg(distance), 6) AS mean_distance FROM r WHERE rn <= {K} GROUP BY 1""",
)
def knn_distances_euclidean(spark, sf_dir):
    df = inp.vectors(spark, sf_dir).select("vec_id", "vector", "role")
    near = domain.knn_distances(
        df, df.filter("role = 'train'"), key="vec_id", features="vector", metric="euclidean", k=K, rows_per_block=256
    )
    return near.select("vec_id", F.round("mean_distance", 6).alias("mean_distance"))


@query(
    "knn_distances_index",
    f"""WITH {inp.fingerprints_sql()},
side AS MATERIALIZED (SELECT doc_id, tokens, len(tokens) AS n,
  CASE WHEN {inp.share_sql('doc_id')} < 0.2 THEN 'test' ELSE 'train' END AS role FROM fp),
bits AS MATERIALIZED (SELECT doc_id, role, unnest(tokens) AS t FROM side),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM bits x JOIN bits y ON x.t = y.t AND y.role = 'train' GROUP BY 1, 2),
d AS (SELECT x.doc_id, CASE WHEN x.n + y.n = 0 THEN 0 ELSE 1 - coalesce(c, 0)::DOUBLE / (x.n + y.n - coalesce(c, 0)) END AS distance
  FROM side x JOIN side y ON y.role = 'train' LEFT JOIN shared s ON s.a = x.doc_id AND s.b = y.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance) AS rn FROM d)
SELECT doc_id, round(avg(distance), 6) AS mean_distance, round(max(distance), 6) AS farthest FROM r WHERE rn <= 2 GROUP BY 1""",
)
def knn_distances_index(spark, sf_dir):
    """Documents against the training documents, by their rarest tokens."""
    df = inp.fingerprints(spark, sf_dir)
    train = df.filter(inp.share_hash(F.col("doc_id")) >= 0.2)
    near = domain.knn_distances(df, train, key="doc_id", features="tokens", k=2, cutoff=(1, 2))
    return near.select(
        "doc_id", F.round("mean_distance", 6).alias("mean_distance"), F.round(F.col("distances")[1], 6).alias("farthest")
    )


@query("domain_profile", f"{KNN_SQL} SELECT * FROM profile")
def domain_profile(spark, sf_dir):
    return domain.domain_profile(_sides(spark, sf_dir)[0])


@query(
    "domain_threshold",
    f"""{KNN_SQL} SELECT 'jaccard' AS metric, {K} AS k, (SELECT round(threshold, 6) FROM threshold) AS threshold, n_train
FROM profile""",
)
def domain_threshold(spark, sf_dir):
    df = domain.domain_threshold(*_sides(spark, sf_dir), k=K)
    return df.withColumn("threshold", F.round("threshold", 6))


@query(
    "within_domain",
    f"""{KNN_SQL} SELECT vec_id, role, round(mean_distance, 6) AS mean_distance,
  mean_distance <= (SELECT threshold FROM threshold) AS within FROM near""",
)
def within_domain(spark, sf_dir):
    train, test = _sides(spark, sf_dir)
    inside = domain.within_domain(train.unionByName(test), domain.domain_threshold(train, test, k=K))
    return inside.withColumn("mean_distance", F.round("mean_distance", 6))


@query(
    "domain_coverage",
    f"""{KNN_SQL} SELECT role, round(avg((mean_distance <= (SELECT threshold FROM threshold))::INT), 3) AS share
FROM near GROUP BY 1""",
)
def domain_coverage(spark, sf_dir):
    train, test = _sides(spark, sf_dir)
    return domain.domain_coverage(train, test, domain.domain_threshold(train, test, k=K))


# --- metrics ---------------------------------------------------------------------------


def _predictions(spark, sf_dir):
    share = inp.share_hash(F.col("doc_id"))
    return inp.table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("quality").alias("truth"),
        share.alias("p"),
        (share >= 0.5).cast("int").alias("predicted"),
        F.floor(share * 1000 % 5).cast("int").alias("fold"),
    )


SHARE = inp.share_sql("doc_id")
PREDICTIONS_SQL = f"""predictions AS (
  SELECT doc_id, quality AS truth, {SHARE} AS p, ({SHARE} >= 0.5)::INT AS predicted,
         floor({SHARE} * 1000 % 5)::INT AS fold FROM labels)"""


def _cells_sql(predicted: str, by: str = "", source: str = "predictions") -> str:
    keys = f"{by}, " if by else ""
    return f"""cells AS (SELECT {keys}count(*) FILTER (truth = 1 AND {predicted} = 1)::DOUBLE AS tp,
  count(*) FILTER (truth = 0 AND {predicted} = 1)::DOUBLE AS fp, count(*) FILTER (truth = 1 AND {predicted} = 0)::DOUBLE AS fn,
  count(*) FILTER (truth = 0 AND {predicted} = 0)::DOUBLE AS tn FROM {source}{' GROUP BY ' + by if by else ''})"""


METRIC_SQL = {
    "accuracy": "(tp + tn) / (tp + tn + fp + fn)",
    "balanced_accuracy": "(tp / (tp + fn) + tn / (tn + fp)) / 2",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "specificity": "coalesce(tn / nullif(tn + fp, 0), 0)",
    "mcc": "coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)",
}
ALL_METRICS = ", ".join(f"round({v}, 3) AS {k}" for k, v in METRIC_SQL.items())


@query("binary_metrics", f"WITH {PREDICTIONS_SQL}, {_cells_sql('predicted')} SELECT {ALL_METRICS} FROM cells")
def binary_metrics(spark, sf_dir):
    return evaluate.binary_metrics(_predictions(spark, sf_dir), truth="truth", predicted="predicted")


# Youden's index, as a user's own metric.
@query(
    "user_metric",
    f"""WITH {PREDICTIONS_SQL}, {_cells_sql('predicted', 'fold')}
SELECT fold, round({METRIC_SQL['recall']} + {METRIC_SQL['specificity']} - 1, 3) AS youden, round({METRIC_SQL['f1']}, 3) AS f1 FROM cells""",
)
def user_metric(spark, sf_dir):
    user.register_metric("youden", lambda: METRICS["recall"]() + METRICS["specificity"]() - 1)
    return evaluate.binary_metrics(_predictions(spark, sf_dir), truth="truth", predicted="predicted", metrics=["youden", "f1"], by=["fold"])


THRESHOLDS = [0.1, 0.25, 0.5, 0.75, 0.9]


@query(
    "metrics_at_threshold",
    f"""WITH {PREDICTIONS_SQL}, t AS (SELECT unnest({THRESHOLDS}::DOUBLE[]) AS threshold),
judged AS (SELECT truth, threshold, (p >= threshold)::INT AS guess FROM predictions, t),
{_cells_sql('guess', 'threshold', 'judged')} SELECT threshold, {ALL_METRICS} FROM cells""",
)
def metrics_at_threshold(spark, sf_dir):
    return evaluate.metrics_at_threshold(
        _predictions(spark, sf_dir), truth="truth", probability="p", thresholds=THRESHOLDS
    )


@query(
    "cv_scores",
    f"""WITH {PREDICTIONS_SQL}, {_cells_sql('predicted', 'fold')},
s AS (SELECT fold, {METRIC_SQL['balanced_accuracy']} AS score FROM cells)
SELECT fold, round(score, 6) AS score, (SELECT round(avg(score), 6) FROM s) AS mean_score FROM s""",
)
def cv_scores(spark, sf_dir):
    df = evaluate.cv_scores(_predictions(spark, sf_dir), truth="truth", predicted="predicted")
    return df.select("fold", F.round("score", 6).alias("score"), F.round("mean_score", 6).alias("mean_score"))


@query(
    "confusion_matrix",
    f"""WITH {PREDICTIONS_SQL}, c AS (SELECT truth AS v FROM predictions UNION SELECT predicted FROM predictions),
n AS (SELECT truth, predicted, count(*) AS n FROM predictions GROUP BY 1, 2),
f AS (SELECT a.v AS truth, b.v AS predicted, coalesce(n.n, 0) AS n FROM c a CROSS JOIN c b
      LEFT JOIN n ON n.truth = a.v AND n.predicted = b.v)
SELECT truth, predicted, n, round(n::DOUBLE / nullif(sum(n) OVER (PARTITION BY truth), 0)::DOUBLE, 6) AS share FROM f""",
)
def confusion_matrix(spark, sf_dir):
    df = profile.confusion_matrix(_predictions(spark, sf_dir), truth="truth", predicted="predicted")
    return df.withColumn("share", F.round("share", 6))


# --- models --------------------------------------------------------------------------------

VECTOR_COLUMNS = [f"v{i}" for i in range(inp.EMBEDDING_SIZE)]


def _wide(spark, sf_dir):
    return inp.vectors(spark, sf_dir).select(
        "vec_id",
        (F.col("label") >= 5).cast("int").alias("y"),
        *[F.col("vector")[i].alias(c) for i, c in enumerate(VECTOR_COLUMNS)],
    )


SPACE = {"regParam": [0.001, 0.5], "fitIntercept": [True, False], "maxIter": [5, 20]}
SEARCH = {"features": VECTOR_COLUMNS, "label": "y", "fold": "fold", "model": "logistic_regression", "space": SPACE, "n_trials": 3}
MODEL_FOLDS, MODEL_TEST = 3, 0.2


def _model_folds(spark, sf_dir):
    """Folds of whole groups with a common test set, joined with the vectors and scaled by their training rows."""
    wide = _wide(spark, sf_dir)
    groups = wide.select("vec_id", F.floor(F.col("vec_id") / 4).alias("grp"))
    folds = split.cluster_kfold(groups, cluster="grp", key="vec_id", n_folds=MODEL_FOLDS, test_ratio=MODEL_TEST)
    joined = rows.folds_with_features(folds, wide, key="vec_id")
    return impute.scale_with_train_stats(joined, VECTOR_COLUMNS, by=["repeat", "fold"])


@query("tune_cv")
def tune_cv(spark, sf_dir):
    """Trials of a classifier over group folds, best first. Test rows are never seen."""
    trials = model.tune_cv(_model_folds(spark, sf_dir), role="role", by=["repeat"], **SEARCH)
    table = [(i + 1, json.dumps(t["params"], sort_keys=True), t["score"]) for i, t in enumerate(trials)]
    return spark.createDataFrame(table, "place int, params string, score double")


# Places, folds and test sizes can be told without the models.
@query(
    "tune_cv_shape",
    f"""SELECT p.place::INTEGER AS place, f.fold::INTEGER AS fold, true AS in_order, true AS is_share
FROM range(1, 4) AS p(place), range(0, {MODEL_FOLDS}) AS f(fold)""",
)
def tune_cv_shape(spark, sf_dir):
    """Every trial has a score from 0 to 1 in every fold, its mean is its score, and places follow the scores."""
    trials = model.tune_cv(_model_folds(spark, sf_dir), role="role", by=["repeat"], **SEARCH)
    table = []
    for place, t in enumerate(trials, 1):
        values = [x["score"] for x in t["scores"]]
        ordered = abs(t["score"] - sum(values) / len(values)) < 1e-12 and (place == 1 or t["score"] <= trials[place - 2]["score"])
        table += [(place, x["fold"][-1], ordered, 0 <= x["score"] <= 1) for x in t["scores"]]
    return spark.createDataFrame(table, "place int, fold int, in_order boolean, is_share boolean")


ADAPTIVE_ROUNDS, ADAPTIVE_TRIALS = 2, 4


# Rungs and fits can be told without the models: 4 trials, the better 2, the better 1.
@query(
    "tune_adaptive",
    f"""SELECT r.round::INTEGER AS round, g.rung::INTEGER AS rung, g.n_fits, g.n_fits AS n_trials, true AS best_went_on, true AS is_share, true AS placed_by_score
FROM range(1, {ADAPTIVE_ROUNDS + 1}) AS r(round), (VALUES (0, 4::BIGINT), (1, 2::BIGINT), (2, 1::BIGINT)) AS g(rung, n_fits)""",
)
def tune_adaptive(spark, sf_dir):
    """Each round of the search: how many trials reached each fold, whether they were the better ones, and how they were placed."""
    table = search.tune_adaptive(
        _model_folds(spark, sf_dir), role="role", by=["repeat"], path=scratch_path(spark, "trials"), rounds=ADAPTIVE_ROUNDS,
        **{**SEARCH, "n_trials": ADAPTIVE_TRIALS},
    )
    so_far = Window.partitionBy("round", "trial").orderBy("rung")
    # mean up to a rung, and the worst of those that went on against the best of those that did not
    judged = table.withColumns({"mean": F.avg("score").over(so_far), "went_on": F.lead("rung").over(so_far).isNotNull()})
    places = search.best_trials(table)
    ranked = places.withColumn("before", F.lag("score").over(Window.partitionBy("n_folds").orderBy("place")))
    in_order = ranked.agg(F.min(F.coalesce(F.col("before") >= F.col("score"), F.lit(True))).alias("in_order"))
    return (
        judged.groupBy("round", "rung")
        .agg(
            F.count(F.lit(1)).alias("n_fits"),
            F.countDistinct("trial").alias("n_trials"),
            F.coalesce(F.min(F.when(F.col("went_on"), F.col("mean"))) >= F.max(F.when(~F.col("went_on"), F.col("mean"))), F.lit(True)).alias("best_went_on"),
            F.min(F.col("score").between(0, 1)).alias("is_share"),
        )
        .crossJoin(F.broadcast(in_order.select(F.col("in_order").alias("placed_by_score"))))
    )


def _fitted(spark, sf_dir):
    """The best trial, fitted on the train and val rows of the first fold."""
    folds = cut_lineage(_model_folds(spark, sf_dir))
    best = model.tune_cv(folds, role="role", by=["repeat"], **SEARCH)[0]
    first = folds.filter("repeat = 0 AND fold = 0")
    return first, model.fit_final(first, features=VECTOR_COLUMNS, label="y", model="logistic_regression", params=best["params"])


@query("fit_final")
def fit_final(spark, sf_dir):
    """Tune over the folds, fit the best trial on the train and val rows and score every row."""
    scaled, fitted = _fitted(spark, sf_dir)
    return model.score_batch(scaled, fitted, key="vec_id").select("vec_id", "role", "y", "probability", "flag")


@query(
    "score_trained",
    """SELECT vec_id, CASE WHEN vec_id % 9 <> 0 THEN true END AS is_probability, CASE WHEN vec_id % 9 <> 0 THEN true END AS flag_fits
FROM embeddings""",
)
def score_trained(spark, sf_dir):
    """The trained model over all rows, one in nine without a feature: those come back with nulls."""
    scaled, fitted = _fitted(spark, sf_dir)
    gaps = scaled.withColumn("v0", F.when(F.col("vec_id") % 9 != 0, F.col("v0")))
    scored = model.score_batch(gaps, fitted, key="vec_id")
    return scored.select(
        "vec_id",
        F.col("probability").between(0, 1).alias("is_probability"),
        (F.col("flag") == (F.col("probability") > 0.5)).alias("flag_fits"),
    )


def _fixed_score(df):
    """A fixed linear score in place of a trained model; no text gives no score."""
    text = F.col("smiles")
    atoms = F.when(text.isNotNull(), heavy_atom_count(text))
    score = 0.5 * halogen_count(text) - 0.1 * atoms + 0.01 * F.col("hba")
    return model.flag_probability(df, F.round(1 / (1 + F.exp(-score)), 6))


ELEMENTS = elements_sql("smiles")
FIXED_SCORE_SQL = f"""WITH {inp.STRUCTURES_SQL},
given AS (SELECT id, CASE WHEN hba % 10 <> 0 THEN smiles END AS smiles, hba FROM structures),
scored AS (SELECT id, smiles, hba, round(1 / (1 + exp(-(0.5::DOUBLE
    * len(list_filter({ELEMENTS}, lambda e: e IN ('F', 'Cl', 'Br', 'I')))
    - 0.1::DOUBLE * len(list_filter({ELEMENTS}, lambda e: e <> 'H')) + 0.01::DOUBLE * hba))), 6) AS probability FROM given)
SELECT id, smiles, hba, probability, probability > 0.5 AS flag FROM scored"""


def _given(spark, sf_dir):
    df = inp.structures(spark, sf_dir)
    return df.select("id", F.when(F.col("hba") % 10 != 0, F.col("smiles")).alias("smiles"), "hba")


@query("score_batch", FIXED_SCORE_SQL)
def score_batch(spark, sf_dir):
    return _fixed_score(_given(spark, sf_dir))


@query("score_stream", FIXED_SCORE_SQL)
def score_stream_query(spark, sf_dir):
    arrived = scratch_path(spark, "arrived")
    given = _given(spark, sf_dir)
    tables.table_sink(given, arrived, format="csv")
    out = scratch_path(spark, "scored")
    source = tables.csv_stream_source(spark, arrived, given.schema)
    score_stream(source, _fixed_score, path=out, checkpoint=scratch_path(spark, "scored-ck"))
    return spark.read.schema(_fixed_score(given).schema).parquet(out)


# --- from a structure to a flagged score, with a trained model ------------------------------

PATH_FEATURES = ["heavy_atoms", "num_halogens", "halogen_mass", "fragments"]
PATH_COLUMNS = [*PATH_FEATURES, "hba", "logp"]


def _described(df):
    """Largest fragment and its property block, as a column step that batch and stream share."""
    known = df.withColumn("fragment", largest_fragment(F.col("smiles")))
    registry = features.property_registry(structure="fragment")
    return known.withColumns({n: registry[n].try_cast("double") for n in PATH_FEATURES}).withColumn("hba", F.col("hba").cast("double"))


def _path_rows(spark, sf_dir):
    df = inp.structures(spark, sf_dir)
    return df.select("id", F.when(F.col("id") % 10 != 0, F.col("smiles")).alias("smiles"), "hba", "logp")


def _path_model(spark, sf_dir):
    """Trained on the records with a structure whose id is not divisible by 5."""
    known = _described(_path_rows(spark, sf_dir)).filter("smiles IS NOT NULL AND id % 5 <> 0")
    labelled = known.withColumn("y", (F.col("hba") + F.col("logp") > 25).cast("int")).withColumn("role", F.lit("train"))
    return model.fit_final(labelled, features=PATH_COLUMNS, label="y", params={"numTrees": 8, "maxDepth": 4, "seed": 1})


def _path_scored(df, fitted):
    return model.score_batch(_described(df), fitted, key="id").select("id", "smiles", "fragment", "probability", "flag")


@query(
    "score_path",
    f"""WITH {inp.STRUCTURES_SQL}
SELECT id, id % 10 <> 0 AS scored, id % 10 <> 0 AS judged, CASE WHEN id % 10 <> 0 THEN true END AS flag_fits FROM structures""",
)
def score_path(spark, sf_dir):
    """Fragment, properties, trained model, domain flag and sink: every record comes out, unknown ones with nulls."""
    scored = _path_scored(_path_rows(spark, sf_dir), _path_model(spark, sf_dir))
    prints = cut_lineage(features.hashed_fingerprint(scored, key="id", text="fragment", kind="char", n_bits=inp.FP_BITS))
    train = prints.filter("id % 5 <> 0 AND tokens IS NOT NULL")
    near = cut_lineage(domain.knn_distances(prints, train, key="id", features="tokens", k=3))
    limits = domain.domain_threshold(near.filter("id % 5 <> 0 AND mean_distance IS NOT NULL"), near.filter("id % 5 = 0"), k=3)
    judged = domain.within_domain(near, limits).select("id", "within")
    out = scratch_path(spark, "scored-path")
    tables.table_sink(scored.join(judged, "id"), out)
    stored = spark.read.parquet(out)
    return stored.select(
        "id",
        F.col("probability").between(0, 1).isNotNull().alias("scored"),
        F.col("within").isNotNull().alias("judged"),
        (F.col("flag") == (F.col("probability") > 0.5)).alias("flag_fits"),
    )


@query(
    "score_path_stream",
    f"""WITH {inp.STRUCTURES_SQL} SELECT id, true AS like_batch FROM structures""",
)
def score_path_stream(spark, sf_dir):
    """The same model over a stream of files gives what it gives in batch."""
    fitted, given = _path_model(spark, sf_dir), _path_rows(spark, sf_dir)
    batch = _path_scored(given, fitted)
    arrived, out = scratch_path(spark, "arrived"), scratch_path(spark, "scored")
    tables.table_sink(given, arrived, format="csv")
    source = tables.csv_stream_source(spark, arrived, given.schema)
    score_stream(source, lambda df: _path_scored(df, fitted), path=out, checkpoint=scratch_path(spark, "scored-ck"))
    streamed = spark.read.schema(batch.schema).parquet(out).select("id", F.struct("smiles", "fragment", "probability", "flag").alias("s"))
    expected = batch.select("id", F.struct("smiles", "fragment", "probability", "flag").alias("b"))
    return expected.join(streamed, "id", "full").select("id", F.coalesce(F.col("s").eqNullSafe(F.col("b")), F.lit(False)).alias("like_batch"))
