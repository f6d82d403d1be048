"""Hard negatives against every pair, and the tree's ranges against all distances."""

import math

import numpy as np
import pytest

from assaywright.llm import hypertree, negatives
from assaywright.llm.vectors import products, squares

SCHEMA = "vec_id long, label int, embedding array<double>, rank int, uid string, leaf string, block int"


def plain(rows, settings):
    """Every anchor against every row; rows are told apart by their position."""
    kept = []
    for vec_id, label, e in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec_id, label, [math.floor(256 * x) for x in e]))
    last = lambda i: (i is None, i or 0)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (vec_id, label, v) in enumerate(kept):
        if vec_id is None or vec_id % settings.anchors:
            continue
        scored = sorted(((-dot(v, x), *last(i), i, y) for j, (i, y, x) in enumerate(kept) if j != k), key=lambda r: r[:3])
        for score, _, _, positive, _ in [r for r in scored if r[4] == label][: settings.positives]:
            low, high = settings.least_percent * -score, settings.most_percent * -score
            hits = [r for r in scored if r[4] != label and low <= 100 * -r[0] <= high][: settings.negatives]
            out += [(vec_id, positive, n + 1, r[3], -score, -r[0]) for n, r in enumerate(hits)]
    return sorted(out, key=repr)


def found(spark, rows, settings):
    df = spark.createDataFrame([(i, y, e, 1, "u", "l", 2) for i, y, e in rows], SCHEMA)
    return sorted(map(tuple, negatives.mined(df, settings).collect()), key=repr)


def odd_rows(seed, n=300, width=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, width))
    rows = [(int(draw.integers(0, 400)), int(draw.integers(0, 3)), [float(x) for x in centres[k % 5] + draw.normal(size=width) * 0.4]) for k in range(n)]
    copy = rows[3][2]
    rows += [(500 + k, k % 2, copy) for k in range(60)] + [(10 * k, 1, copy) for k in range(4)] + [(30, 1, copy)] * 2
    rows += [(None, 0, copy), (None, 1, copy), (20, None, copy), (40, 1, None), (50, 1, [1.0, None] + [0.0] * (width - 2)), (60, 1, [float("nan")] * width)]
    rows += [(70, 1, [float("inf")] + [0.0] * (width - 1)), (80, 2, []), (90, 0, [0.5, -0.25]), (100, 0, [0.0] * width), (110, 7, copy), (-120, 0, copy)]
    return rows


@pytest.mark.parametrize(
    "settings",
    [
        negatives.Settings(anchors=10, sample=64, fan=3, block=16, leaves=32),
        negatives.Settings(anchors=10),
        negatives.Settings(anchors=10, positives=2, negatives=3, sample=5, fan=2, block=8, leaves=4, least_percent=-40, most_percent=60),
    ],
)
def test_against_every_pair(spark, settings):
    rows = odd_rows(settings.sample)
    got, want = found(spark, rows, settings), plain(rows, settings)
    assert len(want) > 100 and got == want


def test_ranges_rule_out_and_lose_nothing():
    draw = np.random.default_rng(4)
    rows = np.floor(256 * (draw.normal(size=(12, 8))[np.arange(3000) % 12] + draw.normal(size=(3000, 8)) * 0.05))
    tree = hypertree.grown(rows[:400], 4, 20)
    leaf = hypertree.leaf_of(tree, rows)
    ranges = hypertree.Ranges(tree)
    for at in range(0, 3000, 500):
        ranges.add(tree, rows[at : at + 500])
    queries = rows[::300]
    scores = products(queries, rows)
    lengths = squares(queries)
    for share, width in ((0.97, 0.02), (0.5, 0.1), (-0.5, 0.2), (3.0, 0.1)):
        low = np.floor(lengths * share).astype(np.int64)[:, None]
        high = low + np.ceil(lengths * width).astype(np.int64)[:, None]
        query, reached = hypertree.reachable(tree, ranges, queries, low, high)
        sent = set(zip(query.tolist(), reached.tolist()))
        assert len(sent) == len(query)
        q, r = np.nonzero((scores >= low) & (scores <= high))
        assert {(int(a), int(leaf[b])) for a, b in zip(q, r)} <= sent
        if share == 0.97:
            assert len(sent) < 0.5 * len(queries) * tree.leaf_count
        if share == 3.0:
            assert not sent


def test_windows_are_whole_scores():
    scores = np.array([[10, 7, 0, -5, negatives.NOTHING, 1]])
    low, high = negatives.windows_of(scores, negatives.Settings())
    for s, a, b in zip(scores[0], low[0], high[0]):
        inside = [] if s == negatives.NOTHING else [n for n in range(-20, 20) if 30 * s <= 100 * n <= 90 * s]
        assert [n for n in range(-20, 20) if a <= n <= b] == inside


def test_few_or_no_rows(spark):
    settings = negatives.Settings()
    assert found(spark, [], settings) == [] and negatives.mined(spark.createDataFrame([], SCHEMA)).columns[0] == "anchor_id"
    assert found(spark, [(0, 1, [1.0]), (100, 2, [1.0])], settings) == []
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (3, 2, [0.95])]
    assert found(spark, rows, settings) == plain(rows, settings) == [(0, 1, 1, 2, 65536, 32768)]
    bare = [(0, 1, []), (100, 1, []), (200, 2, [])]
    assert found(spark, bare, settings) == plain(bare, settings)
    same = [(k, k % 2, [0.25, 0.5]) for k in range(900)]
    assert found(spark, same, settings) == plain(same, settings)
