"""Durable searches, depths read off one tree, grouped curve areas."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.operators import factors, features, metrics, tree_depths, tuning
from tallyforge.plans import model_queries
from tallyforge.operators.ledger import Ledger, fingerprint, point_key
from tallyforge.plans import survey


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        color, size, weight = rng.choice("rrrgb"), rng.random(), rng.randrange(40)
        yes = size * weight / 20 + (0.3 if color == "r" else 0.0) + rng.random() > 1.0
        rows.append((i, color, size, float(weight), "Yes" if yes else "No"))
    return spark.createDataFrame(rows, "key long, color string, size double, weight double, answer string").cache()


@pytest.fixture(scope="module")
def prepared(table):
    stages = features.tabular_stages(["size", "weight"], ["color"], "answer")
    fitted = Pipeline(stages=stages).fit(table)
    return fitted.transform(table).select("key", "features", "label").cache()


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
@pytest.mark.parametrize("select_by", ["rawPrediction", "probability"])
def test_depths_of_one_tree_equal_separate_fits(prepared, impurity, select_by):
    fit_rows, check_rows = prepared.filter("key % 3 > 0").cache(), prepared.filter("key % 3 = 0").cache()
    depths = [0, 1, 2, 3, 5, 8, 12, 20]
    points = [{"maxDepth": d, "impurity": impurity, "maxBins": 30} for d in depths]
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=3, impurity=impurity, maxBins=30)
    judge = tree_depths.DepthAuc(select_by)
    assert judge.families(points) == [[7, 6, 5, 4, 3, 2, 1, 0]]
    deep = tree.copy({tree.maxDepth: 20}).fit(fit_rows)
    mine = judge.metrics(deep, check_rows, points)
    tallies = tree_depths.depth_tallies(deep, check_rows, depths).collect()
    for depth, auc in zip(depths, mine):
        alone = tree.copy({tree.maxDepth: depth}).fit(fit_rows)
        scored = alone.transform(check_rows).withColumn("score", vector_to_array(select_by)[1])
        assert auc == pytest.approx(metrics.binary_auc(scored).first()["roc_auc"], abs=1e-12)
        said = {}
        for r in tallies:
            if r["depth"] == depth:
                key = (r["prediction"], r["label"], tuple(r["stats"]))
                said[key] = said.get(key, 0) + r["n"]
        raw = scored.groupBy("prediction", "label", vector_to_array("rawPrediction").alias("raw")).count().collect()
        assert said == {(r["prediction"], r["label"], tuple(r["raw"])): r["count"] for r in raw}


def test_leaf_owners_merge_equal_siblings():
    #        0
    #      1   4
    #     2 3  5 6
    left, right = np.array([1, 2, -1, -1, 5, -1, -1]), np.array([4, 3, -1, -1, 6, -1, -1])
    prediction = np.array([0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0])
    owners = tree_depths.leaf_owners(left, right, prediction, [0, 1, 2])
    assert owners[0].tolist() == [0, 0, 0, 0]
    assert owners[1].tolist() == [0, 0, 0, 0]  # both halves say 0
    assert owners[2].tolist() == [2, 3, 4, 4]


def test_areas_by_group_equal_each_alone(spark):
    rng = random.Random(8)
    rows = [(g, round(rng.random(), 1 + g), int(rng.random() < 0.3 + 0.1 * g), rng.randrange(1, 4)) for g in range(4) for _ in range(300)]
    rows += [(7, 0.5, 1, 2), (8, 0.5, 0, 2)]
    df = spark.createDataFrame(rows, "g int, score double, label int, n bigint")
    together = {r["g"]: r for r in metrics.binary_auc_by(df, ["g"], weight="n").collect()}
    long = df.withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    for g in (0, 1, 2, 3, 7, 8):
        alone = metrics.binary_auc(long.filter(F.col("g") == g)).first()
        assert (together[g]["n_pos"], together[g]["n_neg"]) == (alone["n_pos"], alone["n_neg"])
        assert together[g]["roc_auc"] == pytest.approx(alone["roc_auc"], abs=1e-12)
        assert together[g]["pr_auc"] == pytest.approx(alone["pr_auc"], abs=1e-12)


def test_fingerprint_follows_rows_and_settings_alone(spark, table):
    one = fingerprint(table, "a")
    assert fingerprint(table.repartition(7).orderBy(F.rand(1)).select(*reversed(table.columns)), "a") == one
    assert fingerprint(table, "b") != one
    assert fingerprint(table.filter("key <> 5"), "a") != one
    assert fingerprint(table.union(table.filter("key = 5")), "a") != one
    moved = spark.createDataFrame([(None, "x"), ("y", None)], "p string, q string")
    other = spark.createDataFrame([("x", None), (None, "y")], "p string, q string")
    assert fingerprint(moved) != fingerprint(other)


def test_ledger_keeps_what_is_whole(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.finished() == {}
    ledger.add({"b": 1, "a": 2.0}, 0, 0.5)
    ledger.add({"a": 2.0, "b": 1}, 1, 0.25)
    ledger.add({"a": 2.0, "b": 1}, 1, 0.25)
    torn = tmp_path / "ledger" / "fit-torn" / "_temporary" / "0"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_bytes(b"PAR1")
    key = point_key({"a": 2.0, "b": 1})
    assert ledger.finished() == {(key, 0): 0.5, (key, 1): 0.25}


POINTS = tuning.grid(impurity=["gini", "entropy"], maxDepth=[2, 4], maxBins=[16])


def study(table, points=POINTS, **options):
    return survey.tree_study(table, ["size", "weight"], ["color"], "answer", ["key"], points=points, folds=3, partitions=4, **options)


def test_a_stopped_search_goes_on(table, tmp_path, monkeypatch):
    whole = study(table)
    folder, fits = str(tmp_path), []
    fit = DecisionTreeClassifier.fit

    def counted(self, rows, *args):
        if len(fits) == 3 and not hold:
            raise RuntimeError("the driver is lost")
        fits.append(self.getImpurity())
        return fit(self, rows, *args)

    monkeypatch.setattr(DecisionTreeClassifier, "fit", counted)
    hold = []
    with pytest.raises(RuntimeError, match="lost"):
        study(table, ledger=folder, parallelism=1)
    hold.append(True)
    assert len(fits) == 3
    rest = study(table, ledger=folder, parallelism=1)
    assert len(fits) == 3 + 3 + 1  # what was left of 3 folds and 2 trees each, and the winner again
    assert sorted(map(tuple, rest.search.metrics.collect())) == sorted(map(tuple, whole.search.metrics.collect()))
    assert rest.search.best == whole.search.best
    wider = tuning.grid(impurity=["gini", "entropy"], maxDepth=[2, 4], maxBins=[16, 20])
    del fits[:]
    study(table, wider, ledger=folder)
    assert len(fits) == 6 + 1  # a larger grid over the same rows fits what is new


def test_time_limit_cancels_the_running_fits(spark, table, tmp_path, monkeypatch):
    fit = DecisionTreeClassifier.fit

    def slow(self, rows, *args):
        if self.getImpurity() == "entropy":
            rows.sparkSession.range(4).select(F.expr("java_method('java.lang.Thread', 'sleep', 60000L)")).collect()
        return fit(self, rows, *args)

    monkeypatch.setattr(DecisionTreeClassifier, "fit", slow)
    start = time.time()
    with pytest.raises(tuning.Unfinished) as stopped:
        study(table, ledger=str(tmp_path), seconds=12, parallelism=2)
    assert time.time() - start < 50
    assert stopped.value.total == 12 and 0 <= stopped.value.done <= 2
    means = tuning.ledger_means(stopped.value.ledger, POINTS, 3).collect()
    assert len(means) == 4 and all(r["place"] is None for r in means)


def test_als_search_goes_on(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    rows = {(u, rng.randrange(40)): float(rng.randrange(1, 9)) for u in range(30) for _ in range(12)}
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double").cache()
    points = tuning.grid(rank=[2, 4], regParam=[0.1], alpha=[1.0])
    options = {"folds": 2, "k": 10, "ledger": str(tmp_path)}
    with pytest.raises(tuning.Unfinished):
        factors.search_als(ratings, ["user", "item"], points, seconds=0.0, **options)
    calls, fit = [], factors.fit_als
    monkeypatch.setattr(factors, "fit_als", lambda *a, **k: (calls.append(k["rank"]), fit(*a, **k))[1])
    table, best, _ = factors.search_als(ratings, ["user", "item"], points, **options)
    assert len(calls) == 5 and table.count() == 4
    again, best_again, _ = factors.search_als(ratings, ["user", "item"], points, **options)
    assert len(calls) == 6 and best_again == best
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, table.collect()))


def test_a_search_can_cut_by_a_condition(table):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    stages = [VectorAssembler(inputCols=["size"], outputCol="features")]
    line = LinearRegression(labelCol="weight", regParam=0.0)
    judge = RegressionEvaluator(labelCol="weight", metricName="rmse")
    found = tuning.train_validate(table, ["key"], stages, line, [{"maxIter": 50}], judge, partitions=4, in_train=F.col("key") <= 2000)
    rows = stages[0].transform(table)
    alone = line.copy({line.maxIter: 50}).fit(rows.filter("key <= 2000"))
    assert found.best_metric == pytest.approx(judge.evaluate(alone.transform(rows.filter("key > 2000"))), abs=1e-9)


def test_search_partitions_follow_the_line_items(spark, tmp_path, monkeypatch):
    """A partition of the training rows stays bounded on larger tables; small tables keep the number they had."""
    seen = []

    def study(*_, partitions, **__):
        seen.append(partitions)
        raise tuning.Unfinished(None, 0, 1)

    monkeypatch.setattr(model_queries.fx, "survey_like", lambda *_: None)
    monkeypatch.setattr(model_queries.survey, "tree_study", study)
    monkeypatch.setattr(model_queries.survey, "forest_study", study)
    monkeypatch.setattr(model_queries, "SEARCH_ROWS", 10, raising=False)
    for rows in (160, 161, 1000):
        spark.range(rows).write.parquet(f"{tmp_path}/{rows}/lineitem.parquet")
        for query in (model_queries.dt_cv, model_queries.dt_tvs, model_queries.rf_multiclass_cv):
            query(spark, f"{tmp_path}/{rows}")
    assert seen == [16] * 3 + [17] * 3 + [100] * 3


def test_factor_models_keep_nothing_in_memory(spark, tmp_path):
    """Several fits side by side would fill the heap with blocks, on which each builds whole blocks more."""

    def held():
        return {i: rdd.getStorageLevel() for i, rdd in spark.sparkContext._jsc.getPersistentRDDs().items()}

    rows = spark.createDataFrame([(u, (u * 7 + i) % 30, 1.0 + i) for u in range(20) for i in range(6)], "user long, item long, rating double")
    before = held()
    points, levels, fit = tuning.grid(rank=[2], regParam=[0.1], alpha=[1.0]), [], factors.fit_als

    def watched(*args, **options):
        model = fit(*args, **options)
        levels.extend(level for i, level in held().items() if i not in before)
        return model

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(factors, "fit_als", watched)
        factors.search_als(rows, ["user", "item"], points, folds=2, k=5)
    assert levels and all(level.useDisk() and not level.useMemory() for level in levels)


def test_factor_models_of_many_rows_are_fitted_one_at_a_time(spark, tmp_path, monkeypatch):
    seen = []

    class Empty:
        path = str(tmp_path)

    def search(*_, parallelism, **__):
        seen.append(parallelism)
        raise tuning.Unfinished(Empty, 0, 1)

    monkeypatch.setattr(model_queries.factors, "search_als", search)
    monkeypatch.setattr(model_queries.tuning, "ledger_means", lambda *_: None)
    monkeypatch.setattr(model_queries, "FITTED_ROWS", 100, raising=False)
    for rows in (0, 25, 26, 50, 51, 1000):
        data = model_queries.recommender.Prepared(None, spark.range(rows), None, None)
        monkeypatch.setattr(model_queries, "prepared", lambda *_, data=data: data)
        model_queries.als_search(spark, str(tmp_path))
    assert seen == [4, 4, 3, 2, 1, 1]
