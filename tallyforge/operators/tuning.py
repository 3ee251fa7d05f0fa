"""Parameter search: preparation fitted once per fold, the estimator per grid point."""

from __future__ import annotations

import itertools
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor, wait
from typing import Any, NamedTuple, Protocol

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyforge.functions.hashing import bucket
from tallyforge.operators.ledger import Ledger, described, point_key
from tallyforge.operators.splits import assign_folds

Point = dict[str, Any]
PARTITIONS = 64  # of the rows a search trains on; forests draw their samples per partition, so it is fixed


class Judge(Protocol):
    """How a search turns a fitted model into the metrics of grid points."""

    larger_is_better: bool

    def families(self, points: list[Point]) -> list[list[int]]:
        """Numbers of the points that one fit serves; the first of each is fitted."""

    def metrics(self, model, rows: DataFrame, points: list[Point]) -> list[float]:
        """The metrics of those points on held-out rows."""


class OneByOne:
    """A fit for every point, judged by an evaluator."""

    def __init__(self, evaluator: Evaluator):
        self.evaluator, self.larger_is_better = evaluator, evaluator.isLargerBetter()

    def families(self, points: list[Point]) -> list[list[int]]:
        return [[i] for i in range(len(points))]

    def metrics(self, model, rows: DataFrame, points: list[Point]) -> list[float]:
        return [float(self.evaluator.evaluate(model.transform(rows)))]

    def __repr__(self) -> str:
        return f"OneByOne({described(self.evaluator)})"


class Unfinished(Exception):
    """The time of a search is over; ``ledger`` has what is finished of its ``total`` metrics."""

    def __init__(self, ledger: Ledger | None, done: int, total: int):
        super().__init__(f"{done} of {total} metrics of the search are finished")
        self.ledger, self.done, self.total = ledger, done, total


class Search(NamedTuple):
    metrics: DataFrame  # (point, fold, metric) and one column per parameter
    best: Point
    best_metric: float
    model: PipelineModel


def grid(**values: Iterable) -> list[Point]:
    """All combinations of the given values, the last name varying fastest."""
    return [dict(zip(values, combo)) for combo in itertools.product(*values.values())]


# The parameter grids of the analyses.
TREE_GRID = grid(impurity=["entropy", "gini"], maxDepth=[6, 12, 24], maxBins=[20, 50, 100])
FOREST_GRID = grid(
    impurity=["entropy", "gini"], maxDepth=[6, 12, 24], maxBins=[20, 50, 100], numTrees=[5, 10, 20]
)
LINEAR_GRID = grid(regParam=[0.0, 0.01, 0.1], elasticNetParam=[0.0, 0.5, 1.0])
ALS_GRID = grid(rank=[10, 25, 50], regParam=[1.0, 0.1, 0.01], alpha=[1.0, 10.0, 100.0])


def same_linear_model(point: Point) -> Point:
    """Without a penalty its kind does not matter."""
    return {**point, "elasticNetParam": 0.0} if point.get("regParam") == 0.0 else point


def first_equals(points: list[Point], canonical: Callable[[Point], Point] | None) -> list[int]:
    """For every point, the number of the first point that gives the same model."""
    canonical = canonical or (lambda p: p)
    keys = [tuple(sorted(canonical(p).items())) for p in points]
    return [keys.index(k) for k in keys]


def binary_auc_evaluator(score: str = "rawPrediction") -> Evaluator:
    """ROC AUC on ``rawPrediction`` or ``probability``, which rank a tree's leaves differently."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=score, metricName="areaUnderROC")


def accuracy_evaluator() -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")


def rmse_evaluator(label: str) -> Evaluator:
    return RegressionEvaluator(labelCol=label, metricName="rmse")


def cross_validate(
    train: DataFrame,
    keys: list[str],
    prepare: list,
    estimator: Estimator,
    points: list[Point],
    evaluator: Evaluator | Judge,
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 2,
    canonical: Callable[[Point], Point] | None = None,
    partitions: int = PARTITIONS,
    ledger: str | None = None,
    seconds: float | None = None,
) -> Search:
    """k-fold search; the winner is fitted again on all of ``train``.

    With ``ledger``, a folder that all machines share, every finished metric is recorded
    there, and a search of the same rows and settings begins with what it finds: a lost
    driver or a time limit costs the running fits only.  After ``seconds`` the running
    fits are cancelled and ``Unfinished`` is raised.
    """
    numbered = assign_folds(spread(train, keys, partitions), keys, folds, seed)
    cuts = [(k, F.col("fold") != k) for k in range(folds)]
    settings = ("cv", keys, folds, seed, partitions)
    return _search(numbered, cuts, prepare, estimator, points, evaluator, parallelism, canonical, settings, ledger, seconds)


def train_validate(
    train: DataFrame,
    keys: list[str],
    prepare: list,
    estimator: Estimator,
    points: list[Point],
    evaluator: Evaluator | Judge,
    train_percent: int = 80,
    seed: int = 42,
    parallelism: int = 2,
    canonical: Callable[[Point], Point] | None = None,
    partitions: int = PARTITIONS,
    ledger: str | None = None,
    seconds: float | None = None,
    in_train: Column | None = None,
) -> Search:
    """Search on one train/validation cut; the winner is fitted again on all of ``train``.

    ``in_train`` is the condition of the cut, for example on a year; by default
    ``train_percent`` of the rows by the hash of their keys.  ``ledger`` and ``seconds``
    as in ``cross_validate``.
    """
    cut = bucket("validation", seed, 100, *keys) < train_percent if in_train is None else in_train
    settings = ("tvs", keys, train_percent, seed, partitions, str(cut))
    return _search(
        spread(train, keys, partitions), [(0, cut)], prepare, estimator, points, evaluator, parallelism, canonical,
        settings, ledger, seconds,
    )


def _search(train, cuts, prepare, estimator, points, evaluator, parallelism, canonical, settings, folder, seconds) -> Search:
    judge = OneByOne(evaluator) if isinstance(evaluator, Evaluator) else evaluator
    with kept(train):
        ledger = None
        if folder:
            stages = [described(s) for s in [*prepare, estimator]]
            ledger = Ledger.of(train, *settings, stages, repr(judge), folder=folder)
        until = None if seconds is None else time.monotonic() + seconds
        return _search_stored(train, cuts, prepare, estimator, points, judge, parallelism, canonical, ledger, until)


def _search_stored(train, cuts, prepare, estimator, points, judge, parallelism, canonical, ledger, until) -> Search:
    spark, first = train.sparkSession, first_equals(points, canonical)
    distinct = sorted(set(first))
    families = [[distinct[i] for i in family] for family in judge.families([points[i] for i in distinct])]
    known = ledger.finished() if ledger else {}
    wanted = [estimator.getFeaturesCol(), estimator.getLabelCol()]
    total = len(cuts) * len(distinct)

    def stop() -> Unfinished:
        mine = {point_key(points[i]) for i in distinct}
        return Unfinished(ledger, sum(key in mine for key, _ in known), total)

    for fold, in_train in cuts:
        left = [[i for i in family if (point_key(points[i]), fold) not in known] for family in families]
        left = [family for family in left if family]
        if not left:
            continue
        fitted = Pipeline(stages=prepare).fit(train.filter(in_train))
        fit_rows = fitted.transform(train.filter(in_train)).select(*wanted)
        check_rows = fitted.transform(train.filter(~in_train)).select(*wanted)
        with kept(fit_rows), kept(check_rows):

            def score(family: list[int]) -> None:
                of_family = [points[i] for i in family]
                model = estimator.copy(_param_map(estimator, of_family[0])).fit(fit_rows)
                for point, metric in zip(of_family, judge.metrics(model, check_rows, of_family)):
                    if ledger:
                        ledger.add(point, fold, metric)
                    known[point_key(point), fold] = metric

            if not run_until(spark, score, left, parallelism, until):
                raise stop()

    rows = [(i, fold, float(known[point_key(points[first[i]]), fold]), *p.values()) for fold, _ in cuts for i, p in enumerate(points)]
    metrics = metrics_table(spark, rows, points)
    number, value = best_point(metrics, judge.larger_is_better)
    winner = estimator.copy(_param_map(estimator, points[number]))
    found: list = []

    def refit(_: int) -> None:
        prepared = Pipeline(stages=prepare).fit(train)
        with kept(prepared.transform(train).select(*wanted)) as fit_rows:
            found.append(PipelineModel([*prepared.stages, winner.fit(fit_rows)]))

    if not run_until(spark, refit, [0], 1, until):
        raise stop()
    return Search(metrics, points[number], value, found[0])


def spread(train: DataFrame, keys: list[str], partitions: int = PARTITIONS) -> DataFrame:
    """Even partitions by row key, in key order: one shuffle for the many passes of the fits.

    Tree fits sample rows by their place.  The number of partitions is an argument
    and neither the session's settings nor adaptive execution change it, so the same
    rows give the same trees on any cluster; raise it for large inputs, and keep it.
    """
    return train.repartition(partitions, *keys).sortWithinPartitions(*keys)


def metrics_table(spark: SparkSession, rows: list[tuple], points: list[Point]) -> DataFrame:
    """One row per grid point and fold."""
    return spark.createDataFrame(rows, ["point", "fold", "metric", *points[0]])


def mean_metrics(metrics: DataFrame) -> DataFrame:
    """Mean metric of every grid point over its folds, with its parameters."""
    params = [c for c in metrics.columns if c not in ("point", "fold", "metric")]
    return metrics.groupBy("point", *params).agg(F.avg("metric").alias("mean_metric"))


def best_point(metrics: DataFrame, larger_is_better: bool = True) -> tuple[int, float]:
    """The point with the best mean metric; among equals the first of the grid."""
    mean = F.col("mean_metric")
    row = mean_metrics(metrics).orderBy(mean.desc() if larger_is_better else mean, "point").first()
    return row["point"], row["mean_metric"]


def ranked_points(metrics: DataFrame, larger_is_better: bool = True) -> DataFrame:
    """Grid points by mean metric, best first; the grid is short."""
    mean = F.col("mean_metric")
    order = Window.partitionBy().orderBy(mean.desc() if larger_is_better else mean, "point")
    return mean_metrics(metrics).withColumn("place", F.row_number().over(order))


def ledger_means(ledger: Ledger, points: list[Point], folds: int, larger_is_better: bool = True) -> DataFrame:
    """Every grid point with its finished folds, their mean metric and, once all are there, its place.

    What a search has so far: ``(point, parameters, n_folds, mean_metric, place)``.
    """
    spark = ledger.spark
    names = list(points[0])
    numbered = spark.createDataFrame([(i, point_key(p), *p.values()) for i, p in enumerate(points)], ["point", "key", *names])
    found = ledger.table().groupBy(F.col("point").alias("key")).agg(F.count("metric").alias("n_folds"), F.avg("metric").alias("mean_metric"))
    rows = numbered.join(found, "key", "left").drop("key").withColumn("n_folds", F.coalesce("n_folds", F.lit(0).cast("bigint")))
    mean = F.col("mean_metric")
    order = Window.partitionBy("n_folds").orderBy(mean.desc() if larger_is_better else mean, "point")  # the grid is short
    return rows.withColumn("place", F.when(F.col("n_folds") == folds, F.row_number().over(order)))


def parameter_rows(spark: SparkSession, point: Point) -> DataFrame:
    """A grid point as ``(param, value)`` rows, for writing next to a report."""
    return spark.createDataFrame([(k, str(v)) for k, v in point.items()], "param string, value string")


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted model, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _param_map(estimator: Estimator, point: Point) -> dict:
    return {estimator.getParam(name): value for name, value in point.items()}


def run_until(session: SparkSession, task: Callable, items: list, parallelism: int, until: float | None = None) -> bool:
    """Run Spark jobs from a few driver threads at a time; whether all came to their end.

    At ``until`` (of ``time.monotonic``) no further item is begun and the jobs of the
    running ones are cancelled, by a tag that only these threads bear.  The first error
    of an item, if any, is raised.
    """
    context, tag, over = session.sparkContext, f"until-{uuid.uuid4().hex}", []
    context.addJobTag(tag)
    try:
        target = inheritable_thread_target(session)(lambda item: None if over else (task(item), True)[1])
    finally:
        context.removeJobTag(tag)
    with ThreadPoolExecutor(max(1, min(parallelism, len(items)))) as pool:
        running = [pool.submit(target, item) for item in items]
        left = None if until is None else max(0.0, until - time.monotonic())
        open_ones = wait(running, timeout=left, return_when="FIRST_EXCEPTION").not_done
        failed = any(f.done() and f.exception() for f in running)
        if open_ones:
            over.append(True)
        while open_ones:  # also jobs that a fit begins between two of its own
            context.cancelJobsWithTag(tag)
            open_ones = wait(open_ones, timeout=0.25).not_done
    if failed:
        raise next(f.exception() for f in running if f.exception())
    return not over and all(f.result() for f in running)


def map_threads(session: SparkSession, task: Callable, items: list, parallelism: int) -> list:
    """Results of Spark jobs that a few driver threads run, in order."""
    found = {}
    run_until(session, lambda i: found.__setitem__(i, task(items[i])), list(range(len(items))), parallelism)
    return [found[i] for i in range(len(items))]


class kept:
    """Keep a DataFrame in memory and on disk, or at another level, for the length of a ``with`` block."""

    def __init__(self, df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self.df, self.level = df, level

    def __enter__(self) -> DataFrame:
        return self.df.persist(self.level)

    def __exit__(self, *_) -> None:
        self.df.unpersist()
