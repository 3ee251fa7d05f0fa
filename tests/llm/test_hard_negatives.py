from __future__ import annotations

import math
import random

import numpy as np
import pytest
from helpers import with_clashing_columns
from pyspark.sql import functions as F

from tallyforge.llm import hard_negatives as H

VECTOR = "vec_id long, label int, embedding array<float>"


def expected(rows, is_anchor, scale=256, n_positives=5, n_negatives=10):
    """By all scores; rows are (id, label, vector)."""
    taken = [
        (place, i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for place, (i, label, v) in enumerate(rows)
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for place, i, label, v in taken:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for p, j, other, w in taken if p != place and len(w) == len(v)]
        positives = sorted((s, j) for s, j, other in scored if other == label)[:n_positives]
        for p, j in positives:
            inside = sorted((s, k) for s, k, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p)
            out += [(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(inside[:n_negatives], 1)]
    return sorted(out)


def mined(frame, **options):
    rows = H.mine(frame, F.col("vec_id") % 10 == 0, **options)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in rows.collect())


def made(n=300, d=6, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, d))
    rows = [(i, int(rng.integers(3)), [float(x) for x in centres[rng.integers(4)] + spread * rng.normal(size=d)]) for i in range(n)]
    rows += [(1000, 1, rows[0][2]), (1010, 2, rows[0][2]), (1020, 1, rows[0][2])]  # ties
    return rows


@pytest.mark.parametrize("spread", [0.3, 0.01])
def test_against_brute_force_in_small_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(H, "ANCHORS", 7)
    monkeypatch.setattr(H, "ROWS", 19)
    rows = made(spread=spread)
    assert mined(spark.createDataFrame(rows, VECTOR)) == expected(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = made(60, seed=3)
    odd = [
        (None, 1, [0.1] * 6), (2000, None, [0.1] * 6), (2010, 1, None), (2020, 1, [0.1, None, 0.2, 0.0, 0.0, 0.0]), (2030, 1, [float("nan")] * 6),
        (2040, 1, [float("inf")] * 6), (2050, 1, [0.5, 0.5]), (2051, 1, [0.4, 0.5]), (2052, 2, [0.2, 0.3]), (2060, 0, [0.0] * 6),
        (2070, 0, []), (2071, 0, []), (2072, 1, []), (2080, 5, [-1.0] * 6),
    ]
    frame = with_clashing_columns(spark.createDataFrame(rows + odd, VECTOR)).selectExpr("*", "1 AS size", "2 AS row", "3 AS anchor")
    assert mined(frame) == expected(rows + odd, lambda i: i % 10 == 0)


def test_repeated_rows_are_rows(spark):
    rows = made(40, seed=4)
    rows += [rows[10], rows[10], rows[11]]
    assert mined(spark.createDataFrame(rows, VECTOR)) == expected(rows, lambda i: i % 10 == 0)


def test_empty_table(spark):
    assert mined(spark.createDataFrame([], VECTOR)) == []


def test_spanning_tree_is_least():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(40, 3))
    order, parent, length = H.spanning_tree(points)
    assert sorted(order) == list(range(40)) and order[0] == 0
    place = {i: k for k, i in enumerate(order)}
    assert all(place[parent[i]] < place[i] for i in order[1:])
    distances = np.linalg.norm(points[:, None] - points[None], axis=2)
    edges, root, total = sorted((distances[i, j], i, j) for i in range(40) for j in range(i)), list(range(40)), 0.0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for w, i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            root[a], total = b, total + w
    assert length.sum() == pytest.approx(total)


def test_bounds_spare_products_where_anchors_are_near():
    dice = random.Random(1)
    base = np.floor(256 * np.random.default_rng(5).normal(size=(3, 16)))
    anchors = np.array([base[0] + dice.randrange(3) for _ in range(30)])
    rows = np.floor(256 * np.random.default_rng(6).normal(size=(2000, 16)))
    tree = H.TreeScores(anchors, rows)
    for i in tree.order:
        exact = rows @ anchors[i]
        least = np.sort(exact)[-5]

        def want(low, high, least=least, exact=exact):
            assert (low <= exact).all() and (exact <= high).all()
            return np.flatnonzero(high >= least)

        wanted, scores = tree.visit(int(i), want)
        assert (scores == exact[wanted]).all() and set(np.flatnonzero(exact >= least)) <= set(wanted)
    assert tree.scored < 0.5 * anchors.shape[0] * len(rows)
