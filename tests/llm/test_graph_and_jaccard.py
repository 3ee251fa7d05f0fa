from __future__ import annotations

import random
from itertools import combinations

import pytest
from helpers import documents, with_clashing_columns

from tallyforge.llm.graph import components
from tallyforge.llm.jaccard_join import keep_one_of_each, similarity_classes


def classes_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    dice = random.Random(4)
    path = dice.sample(range(1000), 60)
    links = [*zip(path, path[1:]), *((2000, 2001 + i) for i in range(300)), (5000, 5000), (5001, 5002), (5002, 5001), (5001, 5002)]
    links += [(3000 + dice.randrange(100), 3000 + dice.randrange(100)) for _ in range(70)]
    found, _ = components(spark.createDataFrame([*links, (None, 1), (1, None)], "u long, v long"))
    nodes = {n for link in links for n in link}
    assert {r["node"]: r["component"] for r in found.collect()} == classes_of(nodes, links)
    assert components(spark.createDataFrame([], "u long, v long"))[0].collect() == []


def shingle_sets(rows, size):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        out.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return out


def brute(rows, size, num, den):
    sets = shingle_sets(rows, size)
    links = [(i, j) for (i, a), (j, b) in combinations(enumerate(sets), 2) if a and b and den * len(a & b) >= num * len(a | b)]
    root = classes_of(range(len(rows)), links)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[root[i]] = min(key, smallest.get(root[i], key))
    return sorted(((key, len(s), smallest.get(root[i]) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed=1):
    """Near copies at all distances, a chain, a passage that many share, and odd texts."""
    dice = random.Random(seed)
    words = ["the", "of", "and", *(f"w{i}" for i in range(3000))]
    texts = []
    for _ in range(6):
        base = dice.choices(words, k=dice.randint(60, 250))
        texts.append(base)
        for _ in range(14):
            copy = list(base)
            for _ in range(dice.randint(0, 6)):
                copy[dice.randrange(len(copy))] = dice.choice(words)
            texts.append(copy)
    chain = dice.choices(words, k=200)
    for _ in range(12):
        chain = list(chain)
        chain[dice.randrange(200)] = dice.choice(words)
        texts.append(chain)
    long = [dice.choices(words, k=4000) for _ in range(3)]
    texts += [t for base in long for t in (base, base[:3900] + dice.choices(words, k=100), base[200:])]
    passage = dice.choices(words, k=80)
    texts += [dice.choices(words, k=30) + passage for _ in range(15)]
    texts += [dice.choices(words, k=dice.randint(1, 8)) for _ in range(20)]
    rows = list(enumerate(" ".join(t) for t in texts))
    odd = [None, "", " \t\n\x0b\x0c\r", "A b", "a B", "one", "One", "é b\x85c", "É b\x85c", "x " * 50_000, "x y " * 30_000, rows[0][1].upper()]
    return rows + [(1000 + i, t) for i, t in enumerate(odd)] + [(3, "a b"), (3, rows[20][1]), (None, "one"), (None, "nothing like it at all")]


def brute_links(rows, size, num, den):
    """(key, n_links): other rows with a key that link."""
    sets = shingle_sets(rows, size)
    n = [0] * len(rows)
    for (i, a), (j, b) in combinations(enumerate(sets), 2):
        if a and b and den * len(a & b) >= num * len(a | b):
            n[i] += rows[j][0] is not None
            n[j] += rows[i][0] is not None
    return sorted(((key, k if key is not None else None) for (key, _), k in zip(rows, n)), key=str)


@pytest.mark.parametrize("size, num, limit", [(3, 90, 2000), (5, 80, 10)])
def test_links_against_brute_force(spark, size, num, limit):
    rows = corpus()
    docs = with_clashing_columns(documents(spark, rows))
    found = similarity_classes(docs, size=size, num=num, limit=limit, links=True).collect()
    assert sorted((tuple(r[:3]) for r in found), key=str) == brute(rows, size, num, 100)
    assert sorted(((r["doc_id"], r["n_links"]) for r in found), key=str) == brute_links(rows, size, num, 100)


@pytest.mark.parametrize("size, num, limit", [(3, 90, 2000), (5, 80, 2000), (3, 90, 4)])
def test_classes_against_brute_force(spark, size, num, limit):
    """limit=4 sends the regions through pivots, core, boundary and blocks."""
    rows = corpus()
    found = similarity_classes(with_clashing_columns(documents(spark, rows)), size=size, num=num, limit=limit).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, size, num, 100)


def test_one_of_each_class_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs = documents(spark, [(5, text), (2, text + " end"), (9, "else"), (None, text), (7, None)])
    kept = keep_one_of_each(docs, similarity_classes(docs, size=5, num=80))
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["2", "7", "9", "None"]
    assert kept.columns == docs.columns


def test_empty_table(spark):
    assert similarity_classes(documents(spark, [])).collect() == []
    assert similarity_classes(documents(spark, []), links=True).collect() == []
