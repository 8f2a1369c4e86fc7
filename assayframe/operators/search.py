"""A tuner that learns from earlier trials and stops poor ones early.

Trials come in rounds. The first round draws at random; later rounds draw where good
trials lie denser than bad ones. Within a round, all trials are judged on one fold, the
better half on the next, and so on, so most fits are spent on what looks good. All
scores are rows of a table that later rounds, and later runs, read.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayframe.operators.model import draw_params, judged_folds

# The better share of earlier trials, and how many draws from there are compared.
GOOD, DRAWS = 0.25, 24
# Rounds are random until so many trials are known.
LEAST_KNOWN = 4

TRIALS = "round int, trial int, rung int, fold string, params string, score double"


def propose(space: Mapping[str, object], known: Sequence[tuple[dict, float]], n: int, seed: int) -> list[dict[str, object]]:
    """``n`` trials: at random, or where the better of the ``known`` ones (higher is better) are denser.

    Trials that were known or are proposed twice are left out, so fewer may come back
    from a space that is used up.
    """
    if len(known) < LEAST_KNOWN:
        drawn = draw_params(space, n, seed)
        return [t for t in drawn if t not in [k for k, _ in known]]
    rng = random.Random(seed)
    ranked = [t for t, _ in sorted(known, key=lambda e: -e[1])]
    cut = max(2, math.ceil(GOOD * len(ranked)))
    good, bad = ranked[:cut], ranked[cut:]
    found: list[dict[str, object]] = []
    for _ in range(n):
        drawn = [{name: _near(name, value, good, rng) for name, value in space.items()} for _ in range(DRAWS)]
        fresh = [t for t in drawn if t not in ranked and t not in found]
        if fresh:
            found.append(max(fresh, key=lambda t: sum(math.log(_density(n_, v, t[n_], good) / _density(n_, v, t[n_], bad)) for n_, v in space.items())))
    return found


def _is_range(value: object) -> bool:
    return isinstance(value, (list, tuple)) and bool(value) and isinstance(value[0], (int, float)) and not isinstance(value[0], bool)


def _width(value, others: Sequence[dict]) -> float:
    """Reach of a kernel: narrower the more trials there are."""
    return max((value[-1] - value[0]) / (1 + len(others)), 1e-12)


def _near(name: str, value: object, good: Sequence[dict], rng: random.Random) -> object:
    """A draw around one of the good trials; now and then anywhere."""
    if rng.random() < 1 / (1 + len(good)):
        return draw_params({name: value}, 1, rng.randrange(1 << 30))[0][name]
    at = rng.choice(good)[name]
    if not _is_range(value):
        return at
    moved = min(max(rng.gauss(at, _width(value, good)), value[0]), value[-1])
    return int(round(moved)) if isinstance(value[0], int) and isinstance(value[-1], int) else moved


def _density(name: str, value: object, at: object, trials: Sequence[dict]) -> float:
    """How dense the trials are at a value, with one more spread over the whole range."""
    if not isinstance(value, (list, tuple)):
        return 1.0
    if not _is_range(value):
        return (1 + sum(t[name] == at for t in trials)) / (len(value) + len(trials))
    reach = _width(value, trials)
    spread = max(value[-1] - value[0], 1e-12)
    kernels = sum(math.exp(-(((at - t[name]) / reach) ** 2) / 2) / (reach * math.sqrt(2 * math.pi)) for t in trials)
    return (1 / spread + kernels) / (1 + len(trials))


def halving_round(trials: Sequence[dict], n_folds: int, judge: Callable[[list[tuple[int, int]]], list[float | None]], keep: float = 0.5) -> list[tuple[int, int, float | None]]:
    """(trial, rung, score): every trial on the first fold, the better share on the next, and so on.

    ``judge`` takes (trial, fold) pairs and gives their scores, higher is better. A trial
    whose score is undefined goes first.
    """
    alive, scores, rows = list(range(len(trials))), {t: [] for t in range(len(trials))}, []
    for rung in range(n_folds):
        for t, score in zip(alive, judge([(t, rung) for t in alive])):
            scores[t].append(score)
            rows.append((t, rung, score))
        mean = {t: -math.inf if None in scores[t] else sum(scores[t]) / len(scores[t]) for t in alive}
        alive = sorted(alive, key=lambda t: (-mean[t], t))[:max(1, math.ceil(keep * len(alive)))]
    return rows


def tune_adaptive(
    folds: DataFrame,
    *,
    features: Sequence[str],
    label: str,
    fold: str,
    path: str,
    model: str = "random_forest",
    space: Mapping[str, object] | None = None,
    rounds: int = 3,
    n_trials: int = 4,
    keep: float = 0.5,
    metric: str = "balanced_accuracy",
    direction: str = "maximize",
    standardize: bool = False,
    role: str | None = None,
    by: Sequence[str] = (),
    missing: str = "error",
    seed: int = 1,
    parallelism: int = 4,
    fixed: Mapping[str, object] | None = None,
) -> DataFrame:
    """The trial table of a search with ``rounds`` rounds of ``n_trials`` trials, see :func:`best_trials`.

    Arguments as those of :func:`model.tune_cv`. The table (round, trial, rung, fold,
    params as JSON, score) is kept at ``path``, one write for each round. Rounds that are
    there already are read and not run again, so a search that was broken off goes on
    and one with more rounds learns from the earlier ones.
    """
    if rounds < 1 or n_trials < 1 or not 0 < keep <= 1:
        raise ValueError("rounds and n_trials are positive, keep is a share")
    spark = folds.sparkSession
    sign = -1.0 if direction == "minimize" else 1.0
    with judged_folds(
        folds, features=features, label=label, fold=fold, model=model, metric=metric, direction=direction, standardize=standardize,
        role=role, by=by, missing=missing, parallelism=parallelism, fixed=fixed,
    ) as (keys, judge):
        for number in range(1, rounds + 1):
            earlier = [] if (table := _read(spark, path)) is None else table.orderBy("round", "trial", "rung").collect()
            if any(r["round"] == number for r in earlier):
                continue
            trials = propose(space or {}, _known(earlier, sign), n_trials, seed * 1_000_003 + number)
            if not trials:
                break
            signed = lambda tasks: [None if s is None else sign * s for s in judge([(trials[t], f) for t, f in tasks])]  # noqa: B023, E731
            rows = halving_round(trials, len(keys), signed, keep)
            found = [(number, t, rung, json.dumps(keys[rung]), json.dumps(trials[t], sort_keys=True), None if s is None else sign * s) for t, rung, s in rows]
            spark.createDataFrame(found, TRIALS).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(TRIALS).parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(TRIALS).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _known(rows: Sequence, sign: float) -> list[tuple[dict, float]]:
    """Trials with the mean of their scores, higher is better; undefined ones are worst of all."""
    scores: dict[str, list] = {}
    for r in rows:
        scores.setdefault(r["params"], []).append(r["score"])
    return [(json.loads(p), -math.inf if None in s else sign * sum(s) / len(s)) for p, s in scores.items()]


def best_trials(table: DataFrame, *, direction: str = "maximize") -> DataFrame:
    """One row per trial, best first by ``place``: params, score (mean), n_folds, complete.

    Only trials that were judged on every fold compete for the first places; the others
    follow by the folds they reached and their score. Undefined scores are last.
    """
    if direction not in ("maximize", "minimize"):
        raise ValueError("direction is 'maximize' or 'minimize'")
    # one row per trial from here on
    means = table.groupBy("round", "trial", "params").agg(
        F.when(F.count("score") == F.count(F.lit(1)), F.avg("score")).alias("score"), F.count(F.lit(1)).alias("n_folds")
    )
    most = F.max("n_folds").over(Window.partitionBy())
    score = F.col("score") if direction == "minimize" else -F.col("score")
    order = Window.orderBy(F.col("n_folds").desc(), score.asc_nulls_last(), "round", "trial")
    return means.withColumn("complete", F.col("n_folds") == most).withColumn("place", F.row_number().over(order))
