from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import documents, with_clashing_columns
from pyspark.sql import functions as F

from tallyforge.llm import toxicity as T


def labelled(n=900, seed=1):
    dice = random.Random(seed)
    words = ["house", "river", "green", "walk", "table", "morning", "stone", "people", "window", "garden"]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        text = dice.choices(words, k=dice.randint(5, 120))
        if toxic:
            for _ in range(dice.randint(1, 3)):
                text.insert(dice.randrange(len(text)), dice.choice(["moronic", "idiotic", "scumbag"]))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = [r for r in labelled() if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    docs = documents(spark, {i: t for i, t, _ in labelled()})
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return T.fit(docs, labels)


def test_held_out_rows_are_told_apart(spark, model):
    rows = labelled()
    scores = {r["doc_id"]: r["score"] for r in T.score(documents(spark, {i: t for i, t, _ in rows}), model).collect()}
    held = [(scores[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 150
    assert sum(s >= 0.3 for s, y in held if y) >= 0.97 * sum(y for _, y in held)
    assert sum(s >= 0.3 for s, y in held if not y) <= 0.02 * len(held)


def test_held_out_follows_crc32(spark):
    ids = [0, 1, 17, 123456789, -5, None]
    found = spark.createDataFrame([(i,) for i in ids], "i long").select("i", T.held_out(F.col("i")).alias("h")).collect()
    assert {r["i"]: r["h"] for r in found} == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_odd_texts_have_scores(spark, model):
    texts = [(1, None), (2, ""), (3, "   "), (4, "é字🎉"), (5, "moronic " * 100_000), (6, "house " * 400_000 + "scumbag"), (None, "idiotic"), (2, "")]
    rows = T.score(with_clashing_columns(documents(spark, texts)), model).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[1] == score[2] < 0.3 and score[5] >= 0.3 and score[6] >= 0.3 and score[None] >= 0.3
    kept = T.keep_clean(with_clashing_columns(documents(spark, texts)), model, 0.3)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 2, 3, 4] and "group" in kept.columns


def test_long_texts_are_hashed_as_in_one_piece():
    text = " ".join(f"word{i}" for i in range(3000))
    whole = next(T.buckets_of([text]))[1]
    chunk, T.CHUNK = T.CHUNK, 1000
    try:
        assert set(next(T.buckets_of([text]))[1]) == set(whole)
    finally:
        T.CHUNK = chunk


def test_one_class_or_no_labels_give_the_share(spark):
    docs = documents(spark, [(1, "a"), (2, "b")])
    none = T.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    one = T.fit(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert np.allclose(none.scores(["x"]), 0.5) and np.allclose(one.scores(["x", ""]), 0.5 / 3)
    assert T.score(documents(spark, []), none).collect() == []
