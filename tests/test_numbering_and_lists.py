"""Dense ids, level tables, lists by norm blocks, factors of new users."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import factors, features, numbering, topk
from tallyforge.plans import model_queries, recommender


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(2)
    rows = {(u, rng.randrange(60)): float(rng.randrange(1, 9)) for u in range(40) for _ in range(12)}
    return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double").cache()


@pytest.fixture(scope="module")
def model(ratings):
    return factors.fit_als(ratings, rank=4)


def test_dense_ids_are_places(spark):
    values = [5, 1 << 40, -3, 5, None, 7, 1 << 40]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "user long, row int")
    ids = numbering.dense_ids(df, "user")
    assert {r["user"]: r["dense"] for r in ids.collect()} == {-3: 0, 5: 1, 7: 2, 1 << 40: 3}
    numbered = numbering.replace_ids(df, ids, "user")
    assert sorted(map(tuple, numbered.collect())) == sorted((sorted({v for v in values if v is not None}).index(v), i) for i, v in enumerate(values) if v is not None)
    assert sorted(map(tuple, numbering.original_ids(numbered, ids, "user").collect())) == sorted((v, i) for i, v in enumerate(values) if v is not None)
    assert numbering.dense_ids(df.limit(0), "user").count() == 0


def test_a_million_levels(spark):
    rows = spark.range(1_000_000).selectExpr("concat('level ', id) AS level").unionByName(
        spark.range(5).selectExpr("concat('level ', id * 7) AS level")
    )
    levels = numbering.category_table(rows, "level")
    summary = levels.agg(F.count("*").alias("n"), F.countDistinct("index").alias("d"), F.max("index").alias("m")).first()
    assert tuple(summary) == (1_000_000, 1_000_000, 999_999.0)
    first = levels.filter("index < 6").orderBy("index").collect()
    assert [r["value"] for r in first] == ["level 0", "level 14", "level 21", "level 28", "level 7", "level 1"]
    odd = spark.createDataFrame([("level 7",), ("never",), (None,)], "level string")
    found = numbering.index_by_table(odd, "level", levels, "index").collect()
    assert {r["level"]: r["index"] for r in found} == {"level 7": 4.0, "never": 1e6, None: 1e6}


def test_level_table_equals_the_indexer(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(rng.choice("aabcdefggg") + rng.choice("xy"),) for _ in range(500)] + [(None,)], "kind string")
    fitted = features.category_indexer(["kind"]).fit(df)
    mine = numbering.index_by_table(fitted.transform(df), "kind", numbering.category_table(df, "kind"), "mine")
    assert mine.filter("mine <> kind_idx").count() == 0


def test_als_with_text_ids_and_large_ids(ratings, model):
    moved = ratings.select((F.col("user") + (1 << 40)).alias("user"), F.format_string("i%05d", "item").alias("item"), "rating")
    keyed = factors.fit_als_keyed(moved, rank=4)
    assert dict(factors.recommend_keyed(keyed, moved, 5).dtypes) == {"user": "bigint", "item": "string", "score": "double"}
    same = factors.recommend(factors.fit_als(ratings.join(ratings.select("item").distinct(), "item"), rank=4), ratings, 5)
    # ids here are dense already, so both fits see the same rows
    mine = {(r["user"] - (1 << 40), int(r["item"][1:])): r["score"] for r in factors.recommend_keyed(keyed, moved, 5).collect()}
    theirs = {(r["user"], r["item"]): r["score"] for r in same.collect()}
    assert mine.keys() == theirs.keys()
    assert all(mine[p] == pytest.approx(theirs[p], abs=1e-4) for p in mine)


@pytest.mark.parametrize("k", [1, 7, 100])
def test_lists_by_norm_blocks_equal_all_scores(ratings, model, k):
    users, items = ({r.id: np.array(r.features, np.float32) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    found = topk.top_k(model, ratings.filter("user < 25"), k, user_block=6, item_block=9).collect()
    lists = {}
    for r in found:
        lists.setdefault(r["user"], []).append((r["item"], r["score"]))
    assert set(lists) == set(range(25))
    for user, mine in lists.items():
        scores = {i: float(users[user] @ y) for i, y in items.items()}
        assert len(mine) == min(k, len(items)) == len({i for i, _ in mine})
        assert sorted((s for _, s in mine), reverse=True) == pytest.approx(sorted(scores.values(), reverse=True)[:k], abs=1e-5)
        assert all(scores[i] == pytest.approx(s, abs=1e-5) for i, s in mine)


def test_blocks_of_small_items_are_left_out(spark):
    rng = np.random.default_rng(3)

    def rows(n, fall):
        """Factors whose norms may fall steeply, as those of rarely met items do."""
        vectors = (np.abs(rng.normal(size=(n, 3))) + 0.2) * fall ** np.arange(n)[:, None]
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, features array<float>").cache()

    class Stretched:
        rank, userFactors, itemFactors = 3, rows(50, 1.0), rows(1000, 0.99)

    users = Stretched.userFactors.select(F.col("id").alias("user"))
    found, work = topk.top_k_with_work(Stretched, users, 10, user_block=10, item_block=50)
    x, y = (np.array([r.features for r in f.orderBy("id").collect()], np.float32) for f in (Stretched.userFactors, Stretched.itemFactors))
    want = {u: set(np.argsort(-(x[u] @ y.T), kind="stable")[:10].tolist()) for u in range(50)}
    got = {u: set() for u in want}
    for r in found.collect():
        got[r["user"]].add(r["item"])
    assert got == want
    counted = work.first()
    assert counted["block_pairs"] == 100 and counted["met"] <= 40


def test_lists_of_many_stripes_hold_k_rows_a_user(spark, monkeypatch):
    """Tasks hand on no more than the lists, ties go by item, and no scoring of Spark ML's is asked for."""
    rng = np.random.default_rng(5)

    def rows(n):
        return spark.createDataFrame([(3 * i, [float(x) for x in rng.integers(-2, 4, 3)]) for i in range(n)], "id int, features array<float>").cache()

    class Given:
        rank, userFactors, itemFactors = 3, rows(60), rows(90)

    monkeypatch.setattr(topk, "STRIPE", 7)
    monkeypatch.setattr(topk, "ITEMS", 16)
    stored = []
    write = topk.write_intermediate
    monkeypatch.setattr(topk, "write_intermediate", lambda df, label, **k: stored.append((label, write(df, label, **k))) or stored[-1][1])
    users = spark.createDataFrame([(3 * i,) for i in range(50)] + [(0,), (1,), (None,)], "user long")
    x, y = ({r.id: np.array(r.features) for r in f.collect()} for f in (Given.userFactors, Given.itemFactors))
    want = {(u, i) for u in range(0, 150, 3) for i in sorted(y, key=lambda i: (-(x[u] @ y[i]), i))[:8]}
    for lists in (factors.recommend(Given, users, 8), topk.top_k(Given, users, 8, user_block=3, item_block=5)):
        found = lists.collect()
        assert len(found) == len(want) and {(r["user"], r["item"]) for r in found} == want
        assert all(r["score"] == x[r["user"]] @ y[r["item"]] for r in found)
    handed_on = [df for label, df in stored if label == "lists"]
    assert [df.filter("user IS NOT NULL").count() for df in handed_on] == [400, 400]
    assert all(df.filter("user IS NULL").count() > 3 for df in handed_on)  # stripes


def test_lists_are_those_of_spark_to_the_last_digit(ratings, model):
    asked = ratings.select("user").distinct()
    theirs = model.recommendForUserSubset(asked, 20).select("user", F.inline("recommendations")).collect()
    want = {(r["user"], r["item"]): r["rating"] for r in theirs}
    for lists in (factors.recommend(model, asked, 20), topk.top_k(model, asked, 20, user_block=4, item_block=32)):
        assert {(r["user"], r["item"]): r["score"] for r in lists.collect()} == want


def test_many_users_get_wider_stripes(spark):
    """The copies of the items do not grow with the users."""
    sizes = [topk._stripe(spark.range(n), 50) for n in (100, 450_000, 1_000_000, 5_000_000)]
    assert sizes == [16_384, 16_384, 31_250, 65_536]
    assert topk._stripe(spark.range(5_000_000), 1 << 20) == 4  # a task's lists have a bound too


@pytest.fixture
def falling(spark, monkeypatch):
    """A model whose items get smaller by and by, in blocks of 50 before stripes of about 10 users; what the lists store."""
    rng = np.random.default_rng(8)

    def rows(n, fall):
        vectors = (np.abs(rng.normal(size=(n, 3))) + 0.2) * fall ** np.arange(n)[:, None]
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, features array<float>").cache()

    class Falling:
        rank, userFactors, itemFactors = 3, rows(50, 1.0), rows(1000, 0.99)

    stored = {}
    write = topk.write_intermediate
    for name, value in (("STRIPE", 10), ("ITEMS", 50), ("HEAD", 100)):
        monkeypatch.setattr(topk, name, value, raising=False)
    monkeypatch.setattr(topk, "write_intermediate", lambda df, label, **k: stored.setdefault(label, write(df, label, **k)))
    return Falling, stored


def met_pairs(stored):
    """Pairs of a user and a block of items that were scored, of 50 times 20."""
    return stored["lists"].agg(F.sum("met")).first()[0]


def test_asked_users_meet_only_items_that_can_be_listed(falling):
    model, stored = falling
    users = model.userFactors.select(F.col("id").alias("user"))
    found = {tuple(r) for r in factors.recommend(model, users, 10).collect()}
    assert 50 <= met_pairs(stored) <= 400
    assert 3 <= stored["reach"].count() <= 5 and stored["reach"].filter("reach > 0").count() > 0
    stored.clear()
    assert found == {tuple(r) for r in topk.all_scored(model, users, 10).collect()} and len(found) == 500


def test_held_out_metrics_score_items_that_can_be_listed(falling, monkeypatch):
    model, stored = falling
    held = model.userFactors.select(F.col("id").alias("user"), F.explode(F.array(F.lit(0), F.col("id") + 3, F.lit(900))).alias("item"))
    mine = [tuple(r) for r in factors.held_out_metrics(model, held, 10).collect()]
    assert met_pairs(stored) <= 400
    stored.clear()
    monkeypatch.setattr(factors, "recommend", topk.all_scored)
    assert mine == [tuple(r) for r in factors.held_out_metrics(model, held, 10).collect()] and len(mine) == 1


def test_the_list_check_scores_items_that_can_be_listed(spark, falling, monkeypatch):
    model, stored = falling
    held = model.userFactors.select(F.col("id").alias("user"))
    monkeypatch.setattr(model_queries, "prepared", lambda *_: recommender.Prepared(None, None, held, None))
    monkeypatch.setattr(factors, "fit_als", lambda _: model)
    assert sorted(map(tuple, model_queries.als_list_check(spark, "").collect())) == [(u, 50, 50, 50) for u in range(50)]
    assert met_pairs(stored) <= 400


def test_keyed_lists_score_items_that_can_be_listed(falling):
    model, stored = falling
    users = model.userFactors.select((F.col("id") + (1 << 40)).alias("user"), F.col("id").alias("dense"))
    items = model.itemFactors.select(F.format_string("i%04d", "id").alias("item"), F.col("id").alias("dense"))
    mine = {(r["user"] - (1 << 40), int(r["item"][1:])): r["score"] for r in factors.recommend_keyed(factors.KeyedFactors(model, users, items), users, 10).collect()}
    assert met_pairs(stored) <= 400
    stored.clear()
    theirs = topk.all_scored(model, users.select(F.col("dense").alias("user")), 10).collect()
    assert mine == {(r["user"], r["item"]): r["score"] for r in theirs}


def test_a_norm_of_nan_hides_no_other_item(spark, falling):
    model, stored = falling
    odd = spark.createDataFrame([(2000, [float("nan"), 1.0, 1.0]), (2001, [9.0, 0.0, 0.0]), (2002, [0.0, 0.0, 0.0])], model.itemFactors.schema)
    none = spark.createDataFrame([(60, [0.0, 0.0, 0.0]), (61, [-1.0, -1.0, -1.0])], model.userFactors.schema)

    class Odd:
        rank, userFactors, itemFactors = 3, model.userFactors.unionByName(none), model.itemFactors.unionByName(odd)

    users = Odd.userFactors.select(F.col("id").alias("user"))
    mine = {tuple(r) for r in factors.recommend(Odd, users, 10).collect()}
    stored.clear()
    assert mine == {tuple(r) for r in topk.all_scored(Odd, users, 10).collect()} and len(mine) == 520


def test_folded_in_users_equal_the_fit(ratings):
    model = factors.fit_als(ratings, rank=4, regParam=0.1, alpha=2.0, iterations=3)
    users = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    for user in (0, 7, 39):
        mine = factors.fold_in(model, ratings.filter(F.col("user") == user), 0.1, 2.0)
        assert np.allclose(mine, users[user], atol=1e-4)
    items = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    rated = ratings.filter("user = 7")
    top = factors.recommend_folded(model, rated, 5, 0.1, 2.0).collect()
    known = {r["item"] for r in rated.collect()}
    best = sorted(((float(users[7] @ y), -i) for i, y in items.items() if i not in known), reverse=True)[:5]
    assert [r["score"] for r in top] == pytest.approx([s for s, _ in best], abs=1e-3)
    assert factors.fold_in(model, rated.limit(0)) == [0.0] * 4
