import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.functions.scalar import rank_line
from tallyforge.operators import factors, features, tuning
from tallyforge.operators.relational import with_names
from tallyforge.plans import survey


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        color, size = rng.choice("rrrgb"), rng.random()
        yes = size + (0.3 if color == "r" else 0.0) + rng.random() * 0.2 > 0.8
        rows.append((i, color, size, "Yes" if yes else "No"))
    return spark.createDataFrame(rows, "key long, color string, size double, answer string").cache()


def small_study(table, search):
    return survey.tree_study(
        table, ["size"], ["color"], "answer", ["key"],
        points=tuning.grid(impurity=["gini"], maxDepth=[2, 4], maxBins=[16]), search=search, folds=3,
    )


def test_tree_study_learns_and_repeats(table, tmp_path):
    cv, tvs = small_study(table, "cv"), small_study(table, "tvs")
    report = {r.metric: r.value for r in cv.report.collect()}
    assert report["roc_auc"] > 0.9 and report["accuracy"] > 0.85
    assert cv.search.metrics.count() == 6 and tvs.search.metrics.count() == 2
    again = small_study(table.repartition(5), "cv")
    assert sorted(map(tuple, again.scored.collect())) == sorted(map(tuple, cv.scored.collect()))
    if cv.search.best == tvs.search.best:
        assert sorted(map(tuple, tvs.scored.collect())) == sorted(map(tuple, cv.scored.collect()))
    assert cv.search.model.stages[-1].getMaxDepth() == cv.search.best["maxDepth"]

    path = str(tmp_path / "model")
    tuning.save_model(cv.search.model, path)
    tuning.save_model(cv.search.model, path)
    before = cv.search.model.transform(table).select("key", "prediction").collect()
    assert tuning.load_model(path).transform(table).select("key", "prediction").collect() == before


def test_selection_by_probability_can_differ_from_raw_prediction(table):
    stages = features.tabular_stages(["size"], ["color"], "answer")
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=3)
    scored = Pipeline(stages=[*stages, tree]).fit(table).transform(table)
    raw = tuning.binary_auc_evaluator("rawPrediction").evaluate(scored)
    assert raw <= tuning.binary_auc_evaluator("probability").evaluate(scored)


def test_unseen_levels(spark, table):
    stages = Pipeline(stages=features.tabular_stages(["size"], ["color"], "answer")).fit(table)
    odd = spark.createDataFrame([(1, "new", 0.5, "Yes"), (2, None, None, "No")], table.schema)
    rows = stages.transform(odd).select("color_idx", vector_to_array("rawFeatures").alias("v")).collect()
    assert [r.color_idx for r in rows] == [3.0, 3.0]
    assert np.isnan(rows[1].v[0])
    with pytest.raises(Exception, match="Unseen label"):
        stages.transform(odd.withColumn("answer", F.lit("Maybe"))).collect()
    names = features.index_mapping(spark, features.stage_of(stages, StringIndexerModel))
    assert names.filter("column = 'color' AND index = 0").first()["label"] == "r"


def test_grids():
    assert (len(tuning.TREE_GRID), len(tuning.FOREST_GRID), len(tuning.LINEAR_GRID), len(tuning.ALS_GRID)) == (18, 54, 9, 27)
    first = tuning.first_equals(tuning.LINEAR_GRID, tuning.same_linear_model)
    assert first == [0, 0, 0, 3, 4, 5, 6, 7, 8]


def test_best_point_takes_the_first_of_equals(spark):
    rows = [(0, 0, 0.5, 1), (1, 0, 0.7, 2), (2, 0, 0.7, 3), (0, 1, 0.5, 1), (1, 1, 0.7, 2), (2, 1, 0.7, 3)]
    table = spark.createDataFrame(rows, ["point", "fold", "metric", "depth"])
    assert tuning.best_point(table) == (1, 0.7)
    assert tuning.best_point(table, larger_is_better=False) == (0, 0.5)
    assert [r.point for r in tuning.ranked_points(table).orderBy("place").collect()] == [1, 2, 0]


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(2)
    rows = {(u, rng.randrange(40)): float(rng.randrange(1, 9)) for u in range(30) for _ in range(12)}
    return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double").cache()


def vectors(df):
    return {r.id: np.array(r.features, dtype=float) for r in df.collect()}


def test_factors_solve_the_weighted_least_squares(ratings):
    """The last half step fits each user to the items with the confidence weights."""
    reg, alpha = 0.1, 2.0
    model = factors.fit_als(ratings, rank=4, regParam=reg, alpha=alpha, iterations=3)
    users, items = vectors(model.userFactors), vectors(model.itemFactors)
    gram = sum(np.outer(y, y) for y in items.values())
    rows = ratings.collect()
    for user, x in users.items():
        mine = [(items[r.item], r.rating) for r in rows if r.user == user]
        left = gram + sum(alpha * c * np.outer(y, y) for y, c in mine) + reg * len(mine) * np.eye(4)
        right = sum((1 + alpha * c) * y for y, c in mine)
        assert np.allclose(np.linalg.solve(left, right), x, atol=1e-3)


def test_lists_against_brute_force(ratings):
    model = factors.fit_als(ratings, rank=4)
    users, items = vectors(model.userFactors), vectors(model.itemFactors)
    wanted = ratings.filter("user < 5")
    got = factors.recommend(model, wanted, 7).collect()
    for user in range(5):
        scores = sorted((float(users[user] @ y) for y in items.values()), reverse=True)[:7]
        mine = sorted((r.score for r in got if r.user == user), reverse=True)
        assert mine == pytest.approx(scores, abs=1e-5)
    assert {r.user for r in got} == set(range(5))


def test_seen_items_can_be_left_out(ratings):
    model = factors.fit_als(ratings, rank=4)
    held = ratings.filter("item < 20")
    seen = ratings.filter("item >= 20")
    kept = factors.labelled_recommendations(model, held, 10, seen)
    assert kept.join(seen, ["user", "item"], "left_semi").count() == 0
    assert factors.labelled_recommendations(model, held, 10).count() >= kept.count()


def test_als_search_and_new_user(spark, ratings):
    keyed = ratings.withColumn("key", F.monotonically_increasing_id())
    points = tuning.grid(rank=[2, 4], regParam=[0.1], alpha=[1.0])
    table, best, model = factors.search_als(keyed, ["user", "item"], points, folds=2, k=10, parallelism=2)
    assert table.count() == 4 and best in points and model.rank == best["rank"]
    top = factors.new_user_recommendations(ratings, ratings, best, n_rated=5, fetch=20, keep=6)
    rows = top.collect()
    assert len(rows) == 6 and {r.user for r in rows} == {30}
    names = spark.createDataFrame([(r.item, f"name {r.item}") for r in rows[1:]], "item long, name string")
    shown = with_names(top, names)
    assert {r.name for r in shown.collect()} == {f"Unknown({rows[0].item})"} | {f"name {r.item}" for r in rows[1:]}
    line = shown.select(rank_line(F.lit(3), F.lit("x"), F.lit(7), F.lit(0.5))).first()[0]
    assert line == " 3. x (item=7, score=0.5000)"


def test_forests_do_not_follow_the_session(spark, table):
    def predictions(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            study = survey.forest_study(
                table.repartition(int(partitions)), ["size"], ["color"], "answer", ["key"],
                points=tuning.grid(impurity=["gini"], maxDepth=[3], maxBins=[16], numTrees=[5]), folds=2,
            )
            return sorted(map(tuple, study.scored.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    assert predictions("4") == predictions("19")


def test_indexed_columns_with_many_levels_need_no_more_bins(spark):
    rows = spark.range(900).selectExpr(
        "id AS key", "concat('c', id % 45) AS color", "id % 7 / 7 AS size", "IF(id % 45 < 20, 'Yes', 'No') AS answer"
    )
    study = survey.tree_study(
        rows, ["size"], ["color"], "answer", ["key"],
        points=tuning.grid(impurity=["gini"], maxDepth=[3], maxBins=[20]), search="tvs",
    )
    assert study.search.model.stages[-1].getMaxBins() == 20 and study.report.count() > 0


def test_lists_without_seen_items_are_filled_up(spark):
    facts = spark.range(4000).selectExpr("CAST(id % 40 AS INT) AS user", "CAST((id * 7 + id DIV 40) % 90 AS INT) AS item", "1.0D AS rating")
    facts = facts.distinct()
    model = factors.fit_als(facts, rank=4, iterations=2)
    n_items = facts.select("item").distinct().count()
    lists = factors.recommend_unseen(model, facts, facts, k=20)
    seen = {r["user"]: r["n"] for r in facts.groupBy("user").agg(F.count("*").alias("n")).collect()}
    found = {r["user"]: r["count"] for r in lists.groupBy("user").count().collect()}
    assert found == {u: min(20, n_items - n) for u, n in seen.items() if n < n_items}
    assert lists.join(facts, ["user", "item"]).count() == 0


def test_a_new_user_needs_enough_fetched_items(spark):
    facts = spark.createDataFrame([(1, 1, 1.0)], "user long, item long, rating double")
    with pytest.raises(ValueError):
        factors.new_user_recommendations(facts, facts, {}, n_rated=8, fetch=30, keep=25)
