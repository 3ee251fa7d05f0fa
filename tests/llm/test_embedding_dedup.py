from __future__ import annotations

import numpy as np
import pytest

from tallyforge.llm.embedding_dedup import near_duplicates

SCHEMA = "vec_id long, embedding array<double>, label int, id string"


def rows_of(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        centres = rng.normal(size=(6, 24))
        for i in range(120):
            x = centres[i % 6] + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.25, 0.4]) if i < 90 else rng.normal(size=24)
            rows.append((label * 1000 + i, x.tolist(), label))
    same = rows[0][1]
    rows += [(5000 + i, same, 0) for i in range(40)] + [(6000, (np.array(same) * 1e200).tolist(), 0), (6001, (np.array(same) * -1).tolist(), 0)]
    rows += [(7000, None, 0), (7001, [], 0), (7002, [0.0] * 24, 0), (7003, [None] * 24, 0), (7004, [float("nan")] * 24, 0), (7005, [float("inf")] + [1.0] * 23, 0)]
    rows += [(7006, same, None), (7007, same[:5], 0), (7008, same[:5], 0), (3, rows[3][1], 0), (None, same, 0), (7009, [-0.0, *same[1:]], 1), (7010, [0.0, *same[1:]], 1)]
    return rows


def brute(rows, threshold):
    usable = [v is not None and l is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v, l in rows]
    units = [np.array(v) / np.abs(v).max() if ok else None for (_, v, _), ok in zip(rows, usable)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    n, n_links, parent = len(rows), [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                n_links[i] += 1
                n_links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    smallest = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            smallest[root(i)] = min(key, smallest.get(root(i), key))
    return sorted(((key, n_links[i], smallest.get(root(i))) for i, (key, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("threshold, tile", [(0.93, 2048), (0.8, 16)])
def test_against_brute_force(spark, threshold, tile):
    rows = rows_of()
    table = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    found = near_duplicates(table, threshold, tile=tile).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows, threshold)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA), 0.93).collect() == []
