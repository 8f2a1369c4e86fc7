"""Tuning, final fit and scoring of a binary classifier, on pyspark.ml."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.metrics import cell_counts, named_metric

CLASSIFIERS = {
    "random_forest": RandomForestClassifier,
    "boosted_trees": GBTClassifier,
    "logistic_regression": LogisticRegression,
}


def score_of(scored: DataFrame, metric: str, truth: str) -> float | None:
    """A metric of the registry over ``prediction``; None where it is undefined."""
    cells = scored.agg(*cell_counts(F.col(truth), F.col("prediction")))
    value = cells.select(named_metric(metric)()).first()[0]
    return None if value is None else float(value)


def draw_params(space: Mapping[str, object], n_trials: int, seed: int) -> list[dict[str, object]]:
    """Random draws from a search space.

    A list of booleans or strings is a choice; a list of numbers is a range from
    its first to its last item; anything else is a constant. The spellings "True"
    and "False" are booleans. Trials that came out equal are listed once.
    """
    rng = random.Random(seed)

    def plain(value):
        return {"True": True, "False": False}.get(value, value) if isinstance(value, str) else value

    def one(value):
        if not isinstance(value, (list, tuple)):
            if not isinstance(value, (bool, int, float, str)):
                raise ValueError(f"unsupported constant {value!r}")
            return plain(value)
        first = value[0] if value else None
        if isinstance(first, (bool, str)):
            return plain(rng.choice(value))
        if isinstance(first, int) and isinstance(value[-1], int):
            return rng.randint(first, value[-1])
        if isinstance(first, (int, float)):
            return rng.uniform(first, value[-1])
        raise ValueError(f"unsupported range {value!r}")

    trials: list[dict[str, object]] = []
    for _ in range(n_trials):
        drawn = {name: one(value) for name, value in space.items()}
        if drawn not in trials:
            trials.append(drawn)
    return trials


def complete_rows(df: DataFrame, columns: Sequence[str], missing: str) -> DataFrame:
    """``df`` as the models can take it.

    ``missing`` says what happens to rows without one of the columns: "error" fails when
    such a row is met, "skip" leaves them out.
    """
    if missing not in ("error", "skip"):
        raise ValueError("missing is 'error' or 'skip'")
    return df.na.drop(subset=list(columns)) if missing == "skip" else df


def _stages(model: str, features: Sequence[str], label: str, standardize: bool, params: Mapping[str, object]):
    if model not in CLASSIFIERS:
        raise ValueError(f"unknown model {model!r}: use one of {sorted(CLASSIFIERS)}")
    stages = [VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="error")]
    column = "__raw"
    if standardize:
        # fitted with the training rows only, since it is part of the pipeline
        stages.append(StandardScaler(inputCol="__raw", outputCol="__x", withMean=True, withStd=True))
        column = "__x"
    stages.append(CLASSIFIERS[model](featuresCol=column, labelCol=label, **params))
    return stages


@contextmanager
def judged_folds(
    folds: DataFrame,
    *,
    features: Sequence[str],
    label: str,
    fold: str,
    model: str,
    metric: str,
    direction: str,
    standardize: bool,
    role: str | None,
    by: Sequence[str],
    missing: str,
    parallelism: int,
    fixed: Mapping[str, object] | None,
) -> Iterator[tuple[list[tuple], Callable]]:
    """The keys of the folds, and a function that fits and scores (params, fold number) pairs side by side.

    Arguments as those of :func:`tune_cv`. The folds are held while the context is open.
    """
    if direction not in ("maximize", "minimize"):
        raise ValueError("direction is 'maximize' or 'minimize'")
    named_metric(metric)  # unknown names are refused
    stages = _stages(model, features, label, standardize, dict(fixed or {}))
    classifier = stages[-1]
    kept = [*by, fold, *([role] if role else [])]
    data = complete_rows(folds, features, missing).select(*features, F.col(label).cast("double").alias(label), *kept)
    if role:
        data = data.filter(F.col(role).isin("train", "val"))
    # read once per trial and fold
    data = data.persist()
    try:
        # one row per fold
        keys = [tuple(r) for r in data.select(*by, fold).distinct().orderBy(*by, fold).collect()]

        def run(task: tuple[Mapping[str, object], int]) -> float | None:
            here = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(v) for c, v in zip([*by, fold], keys[task[1]])])
            if role:
                train, val = data.filter(here & (F.col(role) == "train")), data.filter(here & (F.col(role) == "val"))
            else:
                train, val = data.filter(~here), data.filter(here)
            params = {classifier.getParam(n): v for n, v in task[0].items()}
            return score_of(Pipeline(stages=stages).fit(train.select(*features, label), params).transform(val), metric, label)

        def judge(tasks: Sequence[tuple[Mapping[str, object], int]]) -> list[float | None]:
            with ThreadPool(max(1, parallelism)) as pool:
                return pool.map(run, tasks)

        yield keys, judge
    finally:
        data.unpersist()


def tune_cv(
    folds: DataFrame,
    *,
    features: Sequence[str],
    label: str,
    fold: str,
    model: str = "random_forest",
    space: Mapping[str, object] | None = None,
    n_trials: int = 4,
    metric: str = "balanced_accuracy",
    direction: str = "maximize",
    standardize: bool = False,
    role: str | None = None,
    by: Sequence[str] = (),
    missing: str = "error",
    seed: int = 1,
    parallelism: int = 4,
    fixed: Mapping[str, object] | None = None,
) -> list[dict[str, object]]:
    """Score of each trial in each fold and their mean, best first.

    Without ``role``, ``folds`` has one row per record with the number of the fold it
    validates. With it, ``folds`` has a row per record for each fold, as the fold builders
    give: training rows have the role train and are judged on those with the role val;
    no other role is ever seen. ``by`` names further columns that tell folds apart, such as
    the repeat.

    Each entry has the parameters, the mean score and the folds' ``scores``. A metric that
    is undefined in a fold is None there, the mean is None, and such trials come last.
    Nothing is fitted but the trials. ``missing`` as in :func:`complete_rows`.
    """
    trials = draw_params(space or {}, n_trials, seed)
    with judged_folds(
        folds, features=features, label=label, fold=fold, model=model, metric=metric, direction=direction, standardize=standardize,
        role=role, by=by, missing=missing, parallelism=parallelism, fixed=fixed,
    ) as (keys, judge):
        values = judge([(t, f) for t in trials for f in range(len(keys))])
    scored = []
    for i, trial in enumerate(trials):
        scores = values[i * len(keys):(i + 1) * len(keys)]
        mean = None if None in scores or not scores else sum(scores) / len(scores)
        scored.append({"params": trial, "score": mean, "scores": [{"fold": k, "score": v} for k, v in zip(keys, scores)]})
    sign = -1 if direction == "maximize" else 1
    return sorted(scored, key=lambda r: (r["score"] is None, sign * (r["score"] or 0.0)))


def fit_final(
    rows: DataFrame,
    *,
    features: Sequence[str],
    label: str,
    model: str = "random_forest",
    params: Mapping[str, object] | None = None,
    standardize: bool = False,
    role: str = "role",
    missing: str = "error",
) -> PipelineModel:
    """Fit on the train and val rows of a fold, scaled as in the search. ``missing`` as in :func:`complete_rows`."""
    data = complete_rows(rows.filter(F.col(role).isin("train", "val")), features, missing)
    data = data.select(*features, F.col(label).cast("double").alias(label))
    return Pipeline(stages=_stages(model, features, label, standardize, dict(params or {}))).fit(data)


def flag_probability(df: DataFrame, probability: Column, *, cutoff: float = 0.5) -> DataFrame:
    """Add the probability of class 1 and whether it is above the cutoff; null stays null."""
    return df.withColumn("probability", probability).withColumn("flag", F.col("probability") > cutoff)


def score_batch(df: DataFrame, model: PipelineModel, *, key: str) -> DataFrame:
    """All input columns, the probability of class 1 and the strict 0.5 flag.

    Rows with a missing feature are skipped by the model and come back with null. A
    model that never saw class 1 gives it 0.
    """
    stages = model.stages
    features = stages[0].getInputCols()
    complete = df.na.drop(subset=list(features))
    scored = model.transform(complete).select(
        *df.columns, F.coalesce(F.get(vector_to_array(F.col("probability")), 1), F.lit(0.0)).alias("__p")
    )
    incomplete = df.filter(" OR ".join(f"`{c}` IS NULL OR isnan(`{c}`)" for c in features))
    both = scored.unionByName(incomplete.withColumn("__p", F.lit(None).cast("double")))
    return flag_probability(both, F.col("__p")).drop("__p")
