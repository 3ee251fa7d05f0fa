"""Queries that fit models: whole grids over the whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyforge.operators import factors, topk, tuning
from tallyforge.operators.splits import synthetic_user
from tallyforge.plans import fixtures as fx, recommender, survey, weather
from tallyforge.session import shared_folder
from tallyforge.sources.fixed_width import read_fixed_width

LARGE = 1 << 40  # moves ids out of the int range
SEARCH_SECONDS = 240.0  # of one call of a query that searches; the next call goes on
SEARCH_PARTITIONS, SEARCH_ROWS = 16, 1 << 18  # of the rows these searches train on: so many, more above so many rows each
FITS, FITTED_ROWS = 4, 1 << 25  # factor models fitted side by side, at most, and the training rows they hold together
YEARS = {"train": (1995, 1999), "valid": 2000, "test": 2001}


def _survey_roles(label: str) -> tuple:
    return fx.SURVEY_LIKE_NUMERIC, fx.SURVEY_LIKE_CATEGORICAL, label, fx.ROW_KEYS


def _ledgers(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallyforge/searches"


def _search_partitions(spark: SparkSession, sf_dir: str) -> int:
    """``SEARCH_PARTITIONS``, or as many as keep a partition at ``SEARCH_ROWS`` line items.

    The number follows the table alone, as forests draw their samples per partition.
    """
    return max(SEARCH_PARTITIONS, -(-fx.table(spark, sf_dir, "lineitem").count() // SEARCH_ROWS))


def _staged(spark: SparkSession, sf_dir: str, study, **options) -> DataFrame:
    """The report of a study, or what its search has finished within SEARCH_SECONDS.

    The same query in the same shared folder goes on from there.  ``fits_done`` and
    ``fits_total`` are rows of every report; the others come once the search is whole.
    """
    partitions = _search_partitions(spark, sf_dir)
    try:
        found = study(ledger=_ledgers(spark), seconds=SEARCH_SECONDS, partitions=partitions, **options)
    except tuning.Unfinished as stopped:
        return _fits(spark, stopped.done, stopped.total)
    total = found.search.metrics.count()
    return found.report.unionByName(_fits(spark, total, total))


def _fits(spark: SparkSession, done: int, total: int) -> DataFrame:
    return spark.createDataFrame([("fits_done", float(done)), ("fits_total", float(total))], "metric string, value double")


def dt_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.survey_like(spark, sf_dir)
    return _staged(spark, sf_dir, partial(survey.tree_study, rows, *_survey_roles("answer"), parallelism=4))


def dt_tvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.survey_like(spark, sf_dir)
    return _staged(spark, sf_dir, partial(survey.tree_study, rows, *_survey_roles("answer"), search="tvs", parallelism=4))


def rf_multiclass_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.survey_like(spark, sf_dir)
    return _staged(spark, sf_dir, partial(survey.forest_study, rows, *_survey_roles("age_group"), parallelism=4))


def lr_tvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fixed_width(spark, fx.weather_files(spark, sf_dir)).good
    return weather.linear_study(records, **YEARS, parallelism=4).report


def rf_regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fixed_width(spark, fx.weather_files(spark, sf_dir)).good
    return weather.forest_study(records, **YEARS).report


def prepared(spark: SparkSession, sf_dir: str) -> recommender.Prepared:
    return recommender.prepare(fx.stored_interactions(spark, sf_dir), fx.FACT_KEYS, fx.MIN_ITEMS, fx.TOP, repeated=False)


def als_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return factors.recommend(factors.fit_als(data.train), data.test)


def als_list_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per held-out user the length of the list and how many scores are the product of the factors, in order."""
    data = prepared(spark, sf_dir)
    model = factors.fit_als(data.train)
    lists = factors.recommend(model, data.test)
    users, items = (
        f.select(F.col("id").cast("bigint").alias(name), F.col("features").alias(f"_{name}"))
        for f, name in ((model.userFactors, "user"), (model.itemFactors, "item"))
    )
    product = F.aggregate(F.zip_with("_user", "_item", lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda t, x: t + x)
    same = F.abs(product - F.col("score")) < 1e-4
    return lists.join(users, "user").join(items, "item").groupBy("user").agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("item").alias("n_different"), F.count_if(same).alias("n_products")
    )


def dense_als_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists for users with ids beyond int and items with text ids: per user their length and the known items on them."""
    data = prepared(spark, sf_dir)
    train, test = (
        rows.select((F.col("user") + LARGE).alias("user"), F.concat(F.lit("part "), "item").alias("item"), "rating")
        for rows in (data.train, data.test)
    )
    lists = factors.recommend_keyed(factors.fit_als_keyed(train), test)
    known = train.select("item").distinct()
    return lists.join(known, "item").groupBy("user").agg(F.countDistinct("item").alias("n_items"))


def topk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per held-out user the lists by blocks of norms against those of all scores: lengths, and scores that agree."""
    data = prepared(spark, sf_dir)
    model = factors.fit_als(data.train)
    best = Window.partitionBy("user").orderBy(F.col("score").desc(), "item")
    mine, theirs = (
        lists.withColumn("place", F.row_number().over(best)).select("user", "place", F.col("score").alias(name))
        for lists, name in ((topk.top_k(model, data.test, 50, user_block=64, item_block=256), "a"), (topk.all_scored(model, data.test, factors.LIST_LENGTH), "b"))
    )
    both = mine.join(theirs, ["user", "place"], "full")
    return both.groupBy("user").agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.abs(F.col("a") - F.col("b")) < 1e-5).alias("n_same"))


def new_user_fold_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations for the synthetic user from the factors that the stored items give that user."""
    data = prepared(spark, sf_dir)
    return factors.recommend_folded(factors.fit_als(data.train), synthetic_user(data.facts), 25)


def new_user_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new user's id, the length of the list and how many rated items are on it."""
    data = prepared(spark, sf_dir)
    found = factors.new_user_recommendations(data.facts, data.train, {"rank": 10, "regParam": 0.1, "alpha": 1.0})
    rated = synthetic_user(data.facts).select("item", F.lit(1).alias("_rated"))
    return found.join(rated, "item", "left").groupBy("user").agg(
        F.countDistinct("item").alias("n_items"), F.count("_rated").alias("n_rated")
    )


def als_test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return factors.held_out_metrics(factors.fit_als(data.train), data.test)


def als_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every grid point with its finished folds, mean metric and place; goes on where an earlier call was stopped."""
    data, points, folds = prepared(spark, sf_dir), tuning.ALS_GRID, 5
    # a fit of many rows fills the cores alone, and side by side each would hold its blocks and come late to its end
    parallelism = max(1, min(FITS, FITTED_ROWS // max(1, data.train.count())))
    options = {"parallelism": parallelism, "ledger": _ledgers(spark), "seconds": SEARCH_SECONDS}
    try:
        table, _, _ = factors.search_als(data.train, fx.FACT_KEYS, points, folds, **options)
    except tuning.Unfinished as stopped:
        return tuning.ledger_means(stopped.ledger, points, folds)
    counted = table.groupBy("point").agg(F.count("metric").alias("n_folds"))
    return tuning.ranked_points(table).join(counted, "point")


def new_user_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return recommender.new_user_report(
        data, fx.part_names(spark, sf_dir), {"rank": 10, "regParam": 0.1, "alpha": 1.0}
    )


QUERIES = {
    "dt_cv": dt_cv,
    "dt_tvs": dt_tvs,
    "rf_multiclass_cv": rf_multiclass_cv,
    "lr_tvs": lr_tvs,
    "rf_regress": rf_regress,
    "als_topk": als_topk,
    "als_list_check": als_list_check,
    "dense_als_check": dense_als_check,
    "topk_check": topk_check,
    "new_user_fold_in": new_user_fold_in,
    "new_user_check": new_user_check,
    "als_test_metrics": als_test_metrics,
    "als_search": als_search,
    "new_user_top25": new_user_top25,
}
