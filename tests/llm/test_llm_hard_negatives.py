"""Hard negatives against brute force over all pairs."""

import math

import numpy as np
import pytest

from basketline.llm import hard_negatives as H

KIND = "vec_id long, embedding array<double>, label int, v string, score int, rank string"


def brute_force(rows, every=100, scale=256):
    best = {}
    for vec_id, x, label, *_ in rows:
        if vec_id is None or label is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = ([math.floor(scale * c) for c in x], label)
        best[vec_id] = min(best.get(vec_id, row), row)
    data = {i: (v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, (v, lab) in best.items()}
    out = []
    for a, (q, label) in data.items():
        if a % every:
            continue
        scores = {i: sum(x * y for x, y in zip(q, v)) for i, (v, _) in data.items() if i != a and len(v) == len(q)}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if data[i][1] == label][:5]:
            fits = [i for i in order if data[i][1] != label and 30 * scores[p] <= 100 * scores[i] <= 90 * scores[p]]
            out += [(a, p, r, i, scores[p], scores[i]) for r, i in enumerate(fits[:10], 1)]
    return sorted(out)


def random_rows(seed, n, dim=16, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels)) if rng.random() < 0.6 else 1  # a label with more than a third of all rows
        x = centres[label] * rng.random() + rng.normal(size=dim)
        rows.append((i, (x / np.linalg.norm(x)).tolist(), label))
    return rows


def found(spark, rows, **k):
    frame = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], KIND)
    return sorted(tuple(r) for r in H.hard_negatives(frame, **k).collect())


@pytest.mark.parametrize("group_rows", [1 << 17, 400])
def test_matches_brute_force(spark, group_rows):
    rows = random_rows(group_rows, 1500)
    rows += [(5000 + i, rows[100][1], i % 3) for i in range(300)]  # copies: ties
    rows += [(6000, None, 1), (6100, [], 1), (6200, [1.0] * 15 + [None], 1), (6300, [float("nan")] * 16, 1), (6400, [float("inf")] * 16, 2),
             (6500, [0.0] * 16, 1), (6600, [0.1] * 16, None), (None, [0.1] * 16, 1), (100, [0.2] * 16, 3), (6700, [0.5, 0.5], 1), (6701, [0.5, 0.4], 1), (6702, [0.3, 0.2], 2)]
    got = found(spark, rows, group_rows=group_rows)
    assert got == brute_force(rows) and {6700} <= {r[0] for r in got}


def test_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * 1e5).tolist(), int(rng.integers(3))) for i in range(300)]
    assert found(spark, rows) == brute_force(rows)
    with pytest.raises(ValueError):
        found(spark, [(0, [1e14, 1.0], 1), (1, [1e14, 1.0], 2)])


def test_few_and_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0, 0.0], 1)]) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.95, 0.0], 2)]
    assert found(spark, rows) == brute_force(rows)


def test_leaves_hold_every_row_once_and_boxes_bound_the_scores(spark):
    rows = random_rows(9, 3000, 8)
    frame = H.usable_rows(spark.createDataFrame([(*r, "", 1, "") for r in rows], KIND), 256)
    packed = H.leaves(frame).toArrow()
    trees = H.Trees.of(packed)
    assert sorted(trees.ids.tolist()) == list(range(3000)) and np.diff(trees.begin).max() <= H.LEAF
    assert np.diff(trees.begin).mean() > H.LEAF / 2
    q = np.random.default_rng(1).integers(-256, 256, size=(20, 8))
    low, high = trees.bounds(q)
    scores = q @ trees.v.T
    assert (np.maximum.reduceat(scores, trees.begin[:-1], axis=1) <= high).all() and (np.minimum.reduceat(scores, trees.begin[:-1], axis=1) >= low).all()


def test_boxes_leave_leaves_unopened(spark):
    rows = random_rows(4, 3000, 3)
    trees = H.Trees.of(H.leaves(H.usable_rows(spark.createDataFrame([(*r, "", 1, "") for r in rows], KIND), 256)).toArrow())
    low, high = trees.bounds(q := trees.v[::150])
    opened = []
    for i in range(len(q)):
        queue = H.Queue(trees, q[i], low[i], high[i], np.ones(len(low[i]), bool))
        _, got = queue.best(5, H.LOWEST, H.WIDEST, lambda rows: np.ones(len(rows), bool))
        assert got.tolist() == sorted((q[i] @ trees.v.T).tolist(), reverse=True)[:5]
        opened.append(len(queue.memo))
    assert np.mean(opened) < len(low[0]) / 2
