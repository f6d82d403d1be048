"""Clusters against plain k-means in whole numbers, and the bounds behind them."""

import hashlib
import math

import numpy as np
import pytest

from assaywright.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, id string, v string"


def plain(rows, settings):
    """Every vector against every centroid in every round."""
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == settings.width and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in e]))
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{settings.start}{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[: settings.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(settings.rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            members = [v for (_, v), k in zip(kept, own) if k == j]
            if members:
                centroids[j] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own, total = {}, 0
    for _, j, d in found:
        own[j], total = own.get(j, 0) + d, total + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, own[j], total, digest[j]) for i, j, d in found]


def got(df):
    return sorted([tuple(r)[:6] for r in df.collect()], key=repr)


@pytest.mark.parametrize("k,rounds,group", [(5, 4, 2), (3, 6, 10), (40, 3, 7)])
def test_against_plain_rounds(spark, k, rounds, group):
    rng = np.random.default_rng(k)
    rows = [(i, [float(x) for x in rng.normal(size=4) * (1 + i % 3)]) for i in range(120)]
    rows += [(7, rows[7][1]), (None, [0.5, 0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5, 0.5]), (500, None), (501, [1.0] * 3), (502, [])]
    rows += [(503, [1.0, None, 1.0, 1.0]), (504, [1.0, float("nan"), 0.0, 0.0]), (505, [float("-inf")] * 4), (506, [-0.001, 0.0, 0.5, 1.0])]
    rows += [(600 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(30)] + [(700 + i, [0.0, 0.0, float(i % 2), 1.0]) for i in range(8)]
    df = spark.createDataFrame([(i, e, 1, "x", "y", "z") for i, e in rows], SCHEMA)
    settings = clusters.Settings(clusters=k, rounds=rounds, width=4, group=group)
    assert got(clusters.clustered(df, settings)) == sorted(plain(rows, settings), key=repr)


def test_bounds_save_measurements(spark):
    """Well-separated vectors settle by their bounds, and the measured counts show it."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8)) * 20
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=8) * 0.05], 0, "", "", "") for i in range(600)]
    settings = clusters.Settings(clusters=12, rounds=6, width=8, group=4)
    found = clusters.clustered(spark.createDataFrame(rows, SCHEMA), settings)
    assert found.agg({"measured": "sum"}).first()[0] < 0.5 * 600 * 12 * 7


def test_a_returning_centroid_keeps_its_bounds():
    """Bounds of round 0 are as they were once the centroids are back; summed moves would have spent them."""
    there, away = np.array([[0.0, 0.0], [100.0, 0.0]]), np.array([[0.0, 40.0], [100.0, 40.0]])
    x = np.array([[1.0, 0.0], [99.0, 0.0]])
    groups = (np.array([0]), np.array([1]))
    state = clusters.Assignment(clusters.History((there,), groups)).first(x)
    before = state[5].copy()
    state = clusters.Assignment(clusters.History((there, away, there), groups)).again(x, state)
    assert (state[5] == before).all() and list(state[0]) == [0, 1] and (state[2] == 0).all()


def test_ties_go_to_the_smaller_number():
    groups = (np.array([0, 2]), np.array([1]))
    history = clusters.History((np.array([[2.0], [0.0], [2.0]]),), groups)
    state = clusters.Assignment(history).first(np.array([[1.0], [2.0], [0.0]]))
    assert list(state[0]) == [0, 0, 1]


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert clusters.clustered(empty).collect() == [] and clusters.clustered(empty).columns[0] == "vec_id"
    nothing = spark.createDataFrame([(1, None, None, None, None, None)], SCHEMA)
    assert clusters.clustered(nothing).collect() == []


def test_huge_components_are_held(spark):
    rows = [(1, [3e38, 0.0], 0, "", "", ""), (2, [-3e38, 0.0], 0, "", "", ""), (3, [0.0, 1.0], 0, "", "", "")]
    found = clusters.clustered(spark.createDataFrame(rows, SCHEMA), clusters.Settings(clusters=1, rounds=1, width=2))
    most = (1 << 27) - 1
    held = {r["vec_id"]: r["distance"] for r in found.collect()}
    assert held[1] == most**2 + (0 - 85) ** 2
