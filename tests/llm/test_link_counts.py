from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import link_counts as L


def cloud(seed=3):
    """Sets of one group: unrelated ones, balls, chains that wander off, and a large ball of near copies."""
    dice = np.random.default_rng(seed)
    draw = lambda n: dice.choice(1 << 40, n, replace=False)
    sets = [draw(int(dice.integers(1, 60))) for _ in range(250)]

    def altered(base, most):
        out, k = base.copy(), int(dice.integers(0, most + 1))
        out[dice.choice(len(out), k, replace=False)] = draw(k)
        return out

    for _ in range(12):  # balls, some half way to the next
        base = draw(100)
        sets += [altered(base, 12) for _ in range(40)]
    walk = draw(120)
    for _ in range(300):  # a chain
        walk = altered(walk, 4)
        sets.append(walk)
    base = draw(200)
    sets += [altered(base, 14) for _ in range(500)]
    dice.shuffle(order := np.arange(len(sets)))
    return [np.sort(sets[i]) for i in order]


def brute(sets, weights, num, den):
    where: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        for x in s.tolist():
            where.setdefault(x, []).append(i)
    total, links = Counter(), []
    for i, s in enumerate(sets):
        common = Counter(j for x in s.tolist() for j in where[x])
        for j, c in common.items():
            if i != j and den * c >= num * (len(s) + len(sets[j]) - c):
                total[i] += weights[j]
                links.append((i, j))
    return total, links


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("num, limit", [(90, 30), (80, 30), (80, 5000)])
def test_counts_and_classes_against_brute_force(spark, monkeypatch, num, limit):
    """limit=30 parts 1,530 rows over several levels, to balls that no window parts."""
    levels, balls = [], []
    parted, ball = L._parted, L._balls
    monkeypatch.setattr(L, "_parted", lambda *a: levels.append(a[-1]) or parted(*a))
    monkeypatch.setattr(L, "_balls", lambda *a: balls.append(1) or ball(*a))
    sets = cloud()
    weights = [1 + i % 3 for i in range(len(sets))]
    rows = [(7, i, s.astype("<u8").tobytes(), w) for i, (s, w) in enumerate(zip(sets, weights))]
    rows += rows[:40] + [(8, 10**6, rows[0][2], 1), (9, 10**6 + 1, rows[1][2], 1), (9, 10**6 + 2, rows[1][2], 5)]
    found, _ = L.link_counts(spark.createDataFrame(rows, "group long, id long, payload binary, weight long"), num, 100, limit)
    found = found.collect()
    total, links = brute(sets, weights, num, 100)
    got = Counter()
    for r in found:
        got[r["id"]] += r["n"]
    assert got.pop(10**6 + 1) == 5 and got.pop(10**6 + 2) == 1 and 10**6 not in got
    assert +got == +total
    edges = [(r["id"], r["root"]) for r in found if r["id"] < 10**6]
    assert roots(len(sets), edges) == roots(len(sets), links)
    if limit == 30:
        assert max(levels) >= 2 and balls


def test_empty(spark):
    found, _ = L.link_counts(spark.createDataFrame([], "group long, id long, payload binary, weight long"), 90, 100)
    assert found.collect() == []
