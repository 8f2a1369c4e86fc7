"""Landmark scaling keeps distances where a plane can."""

import numpy as np
import pytest

from assayframe.operators import projection


def frame(spark, x, kind="array<double>"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(x)], f"id long, v {kind}")


def gaps(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))


@pytest.mark.parametrize("landmarks", [4, 40])
def test_distances_on_a_plane_are_kept(spark, landmarks):
    rng = np.random.default_rng(0)
    flat = rng.normal(size=(150, 2)) * [3, 1]
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0][:2]
    x = flat @ turn + 5  # a plane somewhere in six dimensions
    df = frame(spark, x.tolist())
    got = projection.project_by_landmarks({"a": df.filter("id < 100"), "b": df.filter("id >= 100")}, key="id", features="v", metric="euclidean", landmarks=landmarks)
    rows = sorted(got.collect(), key=lambda r: r.id)
    assert got.columns == ["origin", "id", "x1", "x2"]
    assert [r.origin for r in rows] == ["a"] * 100 + ["b"] * 50
    assert np.allclose(gaps(np.array([(r.x1, r.x2) for r in rows])), gaps(flat), atol=1e-5)


def test_more_axes_than_extent(spark):
    x = [[float(i), 0.0] for i in range(9)]
    rows = projection.project_by_landmarks({"s": frame(spark, x)}, key="id", features="v", metric="manhattan", axes=3).collect()
    place = {r.id: (r.x1, r.x2, r.x3) for r in rows}
    assert all(abs(abs(place[i][0] - place[j][0]) - abs(i - j)) < 1e-6 for i in place for j in place)
    assert all(abs(p[1]) < 1e-6 and abs(p[2]) < 1e-6 for p in place.values())


def test_rows_without_features_and_copies(spark):
    rows = [[1, 2, 3], None, [], [1, 2, 3], [2, 3, 4], [7]]
    df = frame(spark, rows, "array<int>")
    got = {r.id: (r.x1, r.x2) for r in projection.project_by_landmarks({"s": df}, key="id", features="v").collect()}
    assert len(got) == 6 and got[1] == (None, None) and got[0] == got[3] != got[4]
    assert all(None not in p for i, p in got.items() if i != 1)
    vectors = frame(spark, [[1.0, float("nan")], [1.0, None], [0.0, 1.0], [2.0, 2.0]])
    got = {r.id: r.x1 for r in projection.project_by_landmarks({"s": vectors}, key="id", features="v", metric="cosine").collect()}
    assert got[0] is None and got[1] is None and got[2] is not None
    none = projection.project_by_landmarks({"s": df.filter("v IS NULL")}, key="id", features="v")
    assert [(r.origin, r.id, r.x1) for r in none.collect()] == [("s", 1, None)]
    assert projection.project_by_landmarks({"s": df.limit(0)}, key="id", features="v").count() == 0


def test_near_sets_are_near(spark):
    rng = np.random.default_rng(3)
    groups = [rng.choice(1000, 60, replace=False) for _ in range(3)]
    sets = [sorted(set(rng.choice(groups[i % 3], 50, replace=False).tolist())) for i in range(90)]
    rows = projection.project_by_landmarks({"s": frame(spark, sets, "array<int>")}, key="id", features="v", landmarks=30).collect()
    at = np.array([(r.x1, r.x2) for r in sorted(rows, key=lambda r: r.id)])
    middle = np.array([at[i::3].mean(0) for i in range(3)])
    assert all(np.argmin(((middle - p) ** 2).sum(1)) == i % 3 for i, p in enumerate(at))


def test_same_place_in_every_run(spark):
    sets = [[i % 5, i % 7 + 10, i % 3 + 20] for i in range(40)]
    df = frame(spark, sets, "array<int>")
    first, second = (sorted(projection.project_by_landmarks({"s": d}, key="id", features="v").collect()) for d in (df, df.repartition(5)))
    assert np.allclose([r[2:] for r in first], [r[2:] for r in second])
