import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from tallyforge.operators import metrics, ranking


def test_auc_agrees_with_mllib(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300) / 300, float(rng.random() < 0.4)) for _ in range(2000)]
    theirs = BinaryClassificationMetrics(spark.sparkContext.parallelize(pairs))
    mine = metrics.binary_auc(spark.createDataFrame(pairs, "score double, label double")).first()
    assert mine.roc_auc == pytest.approx(theirs.areaUnderROC, abs=1e-12)
    assert mine.pr_auc == pytest.approx(theirs.areaUnderPR, abs=1e-12)


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_auc_of_one_class_agrees_with_mllib(spark, label):
    pairs = [(float(i), label) for i in range(5)]
    theirs = BinaryClassificationMetrics(spark.sparkContext.parallelize(pairs))
    mine = metrics.binary_auc(spark.createDataFrame(pairs, "score double, label double")).first()
    assert (mine.roc_auc, mine.pr_auc) == pytest.approx((theirs.areaUnderROC, theirs.areaUnderPR))


def test_multiclass_agrees_with_evaluator(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(5)), float(rng.randrange(6))) for _ in range(1000)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    mine = metrics.multiclass_metrics(df).first()
    for name, column in (("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall")):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert mine[column] == pytest.approx(theirs, abs=1e-12)
    assert mine.accuracy == pytest.approx(mine.weighted_recall, abs=1e-12)


def test_regression_agrees_with_evaluator(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.random(), rng.random()) for _ in range(500)], "label double, prediction double")
    mine = metrics.regression_metrics(df).first()
    for name in ("mse", "rmse", "mae", "r2"):
        assert mine[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df), abs=1e-12)


def test_rates_without_positive_predictions(spark):
    row = metrics.binary_rates(spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")).first()
    assert (row.precision, row.recall, row.accuracy, row.class_accuracy) == (0.0, 0.0, 0.5, 0.5)


def walk(labels):
    """Brute-force stepwise and exact AUC of labels in list order."""
    p, n = labels.count(1.0), labels.count(0.0)
    if not p or not n:
        return 0.5, 0.5
    tp = before = 0
    stepwise = exact = 0.0
    for label in labels:
        if label:
            tp += 1
        else:
            stepwise += (tp + before) / 2
            exact += tp
            before = tp
    return stepwise / (p * n), exact / (p * n)


@pytest.fixture(scope="module")
def lists(spark):
    rng = random.Random(4)
    rows = [
        (u, i, float(rng.randrange(8)), float(rng.random() < u / 60))
        for u in range(60) for i in rng.sample(range(1000), rng.randrange(1, 30))
    ]
    return rows, spark.createDataFrame(rows, "user long, item long, score double, label double")


def test_list_auc_against_brute_force(lists):
    rows, df = lists
    got = {r.user: r for r in ranking.list_auc(df).collect()}
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (-r[2], r[1]))
        assert (got[user].stepwise, got[user].exact) == pytest.approx(walk([r[3] for r in mine]))


def test_pooled_auc_against_brute_force(lists):
    rows, df = lists
    ordered = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    got = ranking.pooled_auc(df).first()
    assert (got.stepwise, got.exact) == pytest.approx(walk([r[3] for r in ordered]))
    by = ranking.pooled_auc(df.withColumn("fold", F.col("user") % 3), ["fold"]).collect()
    for r in by:
        expected = walk([x[3] for x in ordered if x[0] % 3 == r.fold])
        assert (r.stepwise, r.exact) == pytest.approx(expected)


def test_two_row_list(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 1.0), (1, 2, 1.0, 0.0)], "user long, item long, score double, label double")
    row = ranking.list_auc(df).first()
    assert (row.stepwise, row.exact) == (0.5, 1.0)


def test_shared_list_equals_explicit_lists(spark):
    rng = random.Random(5)
    held = spark.createDataFrame(
        [(u, rng.randrange(30)) for u in range(50) for _ in range(rng.randrange(1, 25))], "user long, item long"
    )
    top = spark.createDataFrame([(i, 100.0 - r, r + 1) for r, i in enumerate(rng.sample(range(30), 20))], "item long, total double, rank int")
    explicit = ranking.list_auc(ranking.label_lists(ranking.same_list(held.select("user").distinct(), top), held))
    a = {r.user: tuple(r) for r in explicit.filter("hits > 0").collect()}
    b = {r.user: tuple(r) for r in ranking.shared_list_auc(held, top).collect()}
    assert a.keys() == b.keys()
    assert all(a[u] == pytest.approx(b[u]) for u in a)


def test_macro_without_eligible_users(spark):
    one = spark.createDataFrame([(1, 1, 1.0, 1.0)], "user long, item long, score double, label double")
    assert tuple(ranking.macro_auc(ranking.list_auc(one), empty=0.0).first()) == (0, 0.0, 0.0)
    row = ranking.macro_rank_metrics(one, one.select("user", "item")).first()
    assert row.n_users == 0 and row.stepwise is None
