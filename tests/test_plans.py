import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import splits, tuning
from tallyforge.operators.features import LINEAR_FEATURES, add_cyclical
from tallyforge.plans import catalog, fixtures as fx, recommender, survey, weather
from tallyforge.plans.catalog import QUERIES
from tallyforge.session import shared_folder
from tallyforge.sources import survey as survey_source
from tallyforge.sources.fixed_width import read_fixed_width

SMALL = "/root/testdata/sf0.001"


def test_survey_file_end_to_end(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    ages = [f"{a}-{a + 4}" for a in range(18, 78, 5)] + ["80 or older"]
    lines = [",".join(survey_source.SURVEY_COLUMNS)]
    for i in range(300):
        bmi, age = rng.randrange(15, 45), rng.randrange(13)
        sick = "Yes" if bmi + age * 2 + rng.randrange(8) > 50 else "No"
        values = {"HeartDisease": sick, "BMI": str(bmi) if i else "", "AgeCategory": ages[age]}
        lines.append(",".join(values.get(c, str(rng.randrange(10)) if c in survey_source.SURVEY_NUMERIC else rng.choice(["Yes", "No"])) for c in survey_source.SURVEY_COLUMNS))
    path = tmp_path / "survey.csv"
    path.write_text("\n".join(lines) + "\n")
    small = tuning.grid(impurity=["gini"], maxDepth=[3], maxBins=[20])
    monkeypatch.setattr(survey.tree_study, "__defaults__", (small, *survey.tree_study.__defaults__[1:]))
    forest = tuning.grid(impurity=["gini"], maxDepth=[3], maxBins=[20], numTrees=[5])
    monkeypatch.setattr(survey.forest_study, "__defaults__", (forest, 2, *survey.forest_study.__defaults__[2:]))
    study = survey.run(spark, str(path), "binary", "tvs", 2)
    report = {r.metric: r.value for r in study.report.collect()}
    assert report["roc_auc"] > 0.7 and report["tp"] + report["tn"] + report["fp"] + report["fn"] == study.scored.count()
    ages_study = survey.run(spark, str(path), "age", "cv", 2)
    assert {r.metric for r in ages_study.report.collect()} >= {"accuracy", "f1"}


def test_linear_model_equals_the_normal_equations(spark):
    records = read_fixed_width(spark, fx.weather_files(spark, SMALL)).good.cache()
    points = [{"regParam": 0.0, "elasticNetParam": 0.0}]
    study = weather.linear_study(records, (1995, 1999), 2000, 2001, points=points)
    rows = splits.temporal_split(add_cyclical(records), "year", (1995, 1999), 2000, 2001)
    data = rows.select("split", weather.TARGET, *LINEAR_FEATURES).toPandas()
    design = lambda d: np.column_stack([np.ones(len(d)), d[LINEAR_FEATURES].to_numpy()])
    train = data[data.split == "train"]
    beta = np.linalg.lstsq(design(train), train[weather.TARGET], rcond=None)[0]
    for r in study.report.collect():
        part = data[data.split == r.split]
        err = part[weather.TARGET] - design(part) @ beta
        assert r.mse == pytest.approx(float((err**2).mean()), rel=1e-4)
        assert r.r2 > 0.95


def test_recommender_files_end_to_end(spark, tmp_path):
    rng = random.Random(3)
    facts = [f"{u} {rng.randrange(60)} {rng.randrange(1, 9)}" for u in range(40) for _ in range(30)]
    for name, lines in (("facts", facts), ("alias", ["59\t58", "\t3"]), ("names", [f"{i}\tname {i}" for i in range(50)])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = recommender.load(spark, str(tmp_path / "facts"), str(tmp_path / "alias"))
    assert rows.count() == 1200 and rows.filter("item = 59").count() == 0
    merged = recommender.load(spark, str(tmp_path / "facts"), str(tmp_path / "alias"), "sum")
    assert merged.count() == rows.select("user", "item").distinct().count()
    data = recommender.prepare(rows, ["user", "item", "rating"], 10, 20)
    assert data.train.count() + data.test.count() <= 1200
    found = recommender.baseline(data).first()
    assert found.n_users > 0 and 0.0 < found.exact < 1.0
    names = recommender.delimited.read_dimension(spark, str(tmp_path / "names")).good
    top = recommender.new_user_report(data, names, {"rank": 4, "regParam": 0.1, "alpha": 1.0}, fetch=30, keep=10)
    assert [r.rank for r in top.orderBy("rank").collect()] == list(range(1, 11))


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")


@pytest.mark.parametrize(
    "name", ["popular_macro_auc", "exclude_rated", "union_new_user", "binary_auc", "alias_merge", "top_n_report"]
)
def test_no_cross_joins_and_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Cartesian", "NestedLoop", "Python", "Pandas") if word in plan]


def test_filters_and_columns_reach_the_scan(spark):
    df = fx.table(spark, SMALL, "lineitem").filter(F.col("l_quantity") > 30).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,30.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_holdout_joins_lines_and_orders_once(spark, tmp_path, monkeypatch):
    """The passes of the fit and the scoring read stored rows."""
    spark.range(200).selectExpr(
        "id AS o_orderkey", "timestamp_ntz '1995-06-01 00:00:00' + make_interval(int(id % 7)) AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1000).selectExpr(
        "id % 200 AS l_orderkey", "double(id % 50) AS l_quantity", "double(id % 7) / 100 AS l_discount",
        "double(id % 50) * 30 + id % 11 AS l_extendedprice",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    scored, judge = [], catalog.metrics.regression_metrics_by
    monkeypatch.setattr(catalog.metrics, "regression_metrics_by", lambda df, *a: judge(scored.append(df) or df, *a))
    found = {r["split"]: r["n"] for r in catalog.ols_holdout(spark, str(tmp_path)).collect()}
    assert found == {"valid": 140, "test": 140}
    assert "Join" not in scored[0]._jdf.queryExecution().optimizedPlan().toString()
