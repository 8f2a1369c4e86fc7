"""The adaptive search: rungs, proposals, and fewer fits for the same score."""

import json
import random

import pytest

from assayframe.operators import model, search

SPACE = {"a": [0.0, 1.0], "b": [1, 40], "c": ["x", "y", "z"], "d": 3}


def landscape(params, fold):
    """Best at a = 0.8, b = 30, c = y; folds differ a little."""
    return 1 - (params["a"] - 0.8) ** 2 - ((params["b"] - 30) / 40) ** 2 - (0 if params["c"] == "y" else 0.3) + 0.01 * fold


def run_search(seed, rounds, n_trials, n_folds):
    known, fits = [], 0
    best = -9.0
    for number in range(rounds):
        trials = search.propose(SPACE, known, n_trials, seed * 1000 + number)
        rows = search.halving_round(trials, n_folds, lambda tasks: [landscape(trials[t], f) for t, f in tasks])
        fits += len(rows)
        for t, trial in enumerate(trials):
            scores = [s for u, _, s in rows if u == t]
            known.append((trial, sum(scores) / len(scores)))
            if len(scores) == n_folds:
                best = max(best, known[-1][1])
    return best, fits


def test_fewer_fits_for_the_same_score():
    better = 0
    for seed in range(20):
        best, fits = run_search(seed, rounds=6, n_trials=8, n_folds=4)
        drawn = model.draw_params(SPACE, 48, seed + 500)
        plain = max(sum(landscape(t, f) for f in range(4)) / 4 for t in drawn)
        assert fits < 48 * 4 / 2
        better += best >= plain
    assert better >= 14


def test_halving_keeps_the_better():
    scores = {0: [0.1, 0.9], 1: [0.5, 0.1], 2: [0.4, 0.8], 3: [None, 1.0], 4: [0.45, 0.2]}
    rows = search.halving_round([{}] * 5, 2, lambda tasks: [scores[t][f] for t, f in tasks])
    assert [t for t, rung, _ in rows if rung == 0] == [0, 1, 2, 3, 4]
    assert sorted(t for t, rung, _ in rows if rung == 1) == [1, 2, 4]
    assert search.halving_round([], 2, lambda tasks: []) == []


def test_proposals_stay_in_the_space():
    rng = random.Random(1)
    known = [(t, rng.random()) for t in model.draw_params(SPACE, 20, 3)]
    for t in search.propose(SPACE, known, 30, 5):
        assert 0 <= t["a"] <= 1 and 1 <= t["b"] <= 40 and isinstance(t["b"], int) and t["c"] in SPACE["c"] and t["d"] == 3
        assert t not in [k for k, _ in known]
    few = {"e": [True, False]}
    assert search.propose(few, [({"e": True}, 0.1), ({"e": False}, 0.2)] * 3, 5, 1) == []


def test_search_goes_on_where_it_stopped(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, i % 3, x := rng.gauss(0, 1), rng.gauss(0, 1), int(x + rng.gauss(0, 0.5) > 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, fold int, u double, v double, y int")
    options = {
        "features": ["u", "v"], "label": "y", "fold": "fold", "model": "logistic_regression", "space": {"regParam": [0.0, 5.0]}, "n_trials": 3,
        "path": str(tmp_path / "trials"), "metric": "accuracy",
    }
    first = search.tune_adaptive(df, rounds=1, **options).collect()
    assert len(first) == 3 + 2 + 1 and {r["round"] for r in first} == {1}
    both = search.tune_adaptive(df, rounds=2, **options)
    rows = both.collect()
    assert len(rows) == 12 and set(first) <= set(rows)
    best = search.best_trials(both).orderBy("place").collect()
    assert [r["place"] for r in best] == [1, 2, 3, 4, 5, 6] and best[0]["complete"] and best[0]["n_folds"] == 3
    assert 0 <= json.loads(best[0]["params"])["regParam"] <= 5
    # the scores are those of the plain tuner
    trial = json.loads(best[0]["params"])
    plain = model.tune_cv(df, features=["u", "v"], label="y", fold="fold", model="logistic_regression", space=trial, n_trials=1, metric="accuracy")
    assert abs(plain[0]["score"] - best[0]["score"]) < 1e-12
    with pytest.raises(ValueError):
        search.tune_adaptive(df, **{**options, "n_trials": 0})
