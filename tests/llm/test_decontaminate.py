from __future__ import annotations

import hashlib
import random
import re

import pytest
from helpers import documents, with_clashing_columns

from tallyforge.llm import decontaminate as D

ITEM = "item_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    rows = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in windows}:
            for i in range(len(w) - n + 1):
                items_of = windows.get(tuple(w[i : i + n]))
                if items_of:
                    hit |= set(range(i, i + n))
                    found |= items_of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(rows, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def made(seed):
    dice = random.Random(seed)
    pool = ["the", "The", "a", "b", "É", "é", "ß", "x1", "K", "Σ", "to"]

    def text(n):
        return "".join(dice.choice(pool) + dice.choice([" ", ", ", "\n", "--", " "]) for _ in range(n))

    items = [(i, text(dice.choice([0, 1, 3, 4, 6, 9]))) for i in range(12)] + [(100, text(4)), (100, text(4)), (None, "a b"), (7, None)]
    docs = []
    for i in range(150):
        parts = [text(dice.randint(0, 12))]
        if dice.random() < 0.5:
            parts += [dice.choice(items)[1] or "", text(dice.randint(0, 5))]
        docs.append((i, dice.choice(["", " "]).join(parts)))
    return docs + [(5, docs[5][1]), (None, docs[6][1]), (200, None), (201, ""), (202, " ,. ")], items


@pytest.mark.parametrize("seed, broadcast", [(1, D.BROADCAST), (2, D.BROADCAST), (2, 3)])
def test_against_brute_force(spark, seed, broadcast):
    docs, items = made(seed)
    rows = D.leaks(documents(spark, docs), spark.createDataFrame(items, ITEM), window=4, broadcast=broadcast)
    want = expected(docs, items, window=4)
    assert found(rows) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)


def test_clashing_columns_and_long_texts(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    long = "filler words and more, " * 50_000 + passage.upper() + " end"
    docs = [(1, long), (2, passage), (2, passage), (3, "w1 w2 w3")]
    items = [(4, passage), (11, passage + " tail")]
    benchmark = with_clashing_columns(spark.createDataFrame(items, ITEM))
    assert found(D.leaks(with_clashing_columns(documents(spark, docs)), benchmark)) == expected(docs, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], ITEM)
    assert D.leaks(documents(spark, []), items).collect() == []
    assert found(D.leaks(documents(spark, {1: "a b c"}), items.limit(0))) == expected([(1, "a b c")], [])


def test_removal(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = {1: f"Before, {passage}. After; twice {passage}!", 2: "clean, text", 3: passage, 4: None, 5: ""}
    items = spark.createDataFrame([(4, passage)], ITEM)
    frame = with_clashing_columns(documents(spark, docs))
    spans = D.remove_spans(frame, items)
    assert spans.columns == frame.columns
    assert {r[0]: r[1] for r in spans.collect()} == {1: "Before. After; twice!", 2: "clean, text", 3: "", 4: None, 5: ""}
    assert {r[0] for r in D.remove_documents(frame, items).collect()} == {2, 4, 5}
    assert {r[0] for r in D.remove_documents(frame, items, share=0.95).collect()} == {1, 2, 4, 5}


def test_no_python_in_the_plan(spark):
    plan = D.leaks(documents(spark, {1: "x"}), spark.createDataFrame([(1, "x")], ITEM))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
