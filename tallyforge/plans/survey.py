"""Tuned tree classifiers over a survey table: yes/no label or many classes.

    python -m tallyforge.plans.survey FILE.csv --task binary --search cv --report-out DIR
"""

from __future__ import annotations

import argparse
import time
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators import metrics, tuning
from tallyforge.operators.features import index_mapping, tabular_stages
from tallyforge.operators.splits import hash_split
from tallyforge.operators.tree_depths import DepthAuc
from tallyforge.session import allow_checkpoints
from tallyforge.sources import survey as source


GROWTH_MB = 1024  # of an executor's memory per running task


class Study(NamedTuple):
    search: tuning.Search
    scored: DataFrame  # label, prediction, score of the test rows
    report: DataFrame  # (metric, value)


def binary_report(scored: DataFrame) -> DataFrame:
    """Confusion counts, rates and curve areas as ``(metric, value)`` rows."""
    rates = metrics.metric_rows(metrics.binary_rates(scored))
    areas = metrics.binary_auc(scored).select("roc_auc", "pr_auc")
    return rates.unionByName(metrics.metric_rows(areas))


def tree_study(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    label: str,
    keys: list[str],
    points: list[dict] = tuning.TREE_GRID,
    search: str = "cv",
    folds: int = 5,
    train_percent: int = 80,
    seed: int = 42,
    parallelism: int = 2,
    select_by: str = "rawPrediction",
    **options,
) -> Study:
    """Decision tree for a two-valued label, tuned by ROC AUC and judged on held-out rows.

    One tree is fitted for all depths of a grid (tree_depths); ``options`` go to the search:
    partitions, ledger, seconds.
    """
    train, test = _split(df, keys, train_percent, seed)
    stages = tabular_stages(numeric, categorical, label)
    tree = DecisionTreeClassifier(
        labelCol="label", featuresCol="features", seed=seed, **_growth(df.sparkSession, points)
    )
    judge = DepthAuc(select_by)
    if search == "cv":
        found = tuning.cross_validate(
            train, keys, stages, tree, points, judge, folds, seed, parallelism, **options
        )
    else:
        found = tuning.train_validate(
            train, keys, stages, tree, points, judge, train_percent, seed, parallelism, **options
        )
    scored = found.model.transform(test).select(
        "label", "prediction", vector_to_array("probability")[1].alias("score")
    )
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    return Study(found, scored, binary_report(scored))


def forest_study(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    label: str,
    keys: list[str],
    points: list[dict] = tuning.FOREST_GRID,
    folds: int = 5,
    train_percent: int = 80,
    seed: int = 42,
    parallelism: int = 2,
    **options,
) -> Study:
    """Random forest for a label of many classes, tuned by accuracy; ``options`` go to the search.

    A forest draws features node by node as it grows, so every depth is a fit of its own.
    """
    train, test = _split(df, keys, train_percent, seed)
    stages = tabular_stages(numeric, categorical, label)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", featureSubsetStrategy="auto", seed=seed,
        **_growth(df.sparkSession, points),
    )
    found = tuning.cross_validate(
        train, keys, stages, forest, points, tuning.accuracy_evaluator(), folds, seed, parallelism, **options
    )
    scored = found.model.transform(test).select("label", "prediction")
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    return Study(found, scored, metrics.metric_rows(metrics.multiclass_metrics(scored)))


def _growth(spark: SparkSession, points: list[dict]) -> dict:
    """How trees are grown.

    More nodes are split per pass over the rows (up to ``GROWTH_MB`` in every running
    task; it also orders the nodes, and with it a forest's draws of features, so it is
    a constant); for deep trees every row keeps its node, so that it need not walk down
    the tree again for each level.
    """
    deep = max(p.get("maxDepth", 5) for p in points) > 12
    if deep:
        allow_checkpoints(spark)
    return {"maxMemoryInMB": GROWTH_MB, "cacheNodeIds": deep, "checkpointInterval": 10}


def _split(df: DataFrame, keys: list[str], percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    split = hash_split(df, keys, percent, seed)
    return split.filter("split = 'train'").drop("split"), split.filter("split = 'test'").drop("split")


def run(spark: SparkSession, path: str, task: str, search: str, parallelism: int, **options) -> Study:
    """One of the two survey analyses over a CSV file; rows are keyed by their whole content."""
    df = source.read_csv(spark, path)
    label = source.SURVEY_YES_NO_LABEL if task == "binary" else source.SURVEY_AGE_LABEL
    roles = (source.SURVEY_NUMERIC, source.survey_categorical(label), label, df.columns)
    if task == "binary":
        return tree_study(df, *roles, search=search, parallelism=parallelism, **options)
    return forest_study(df, *roles, parallelism=parallelism, **options)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("path")
    parser.add_argument("--task", choices=["binary", "age"], default="binary")
    parser.add_argument("--search", choices=["cv", "tvs"], default="cv")
    parser.add_argument("--parallelism", type=int, default=2)
    parser.add_argument("--partitions", type=int, default=tuning.PARTITIONS)
    parser.add_argument("--ledger", help="folder of finished fits; the same command goes on from there")
    parser.add_argument("--seconds", type=float, help="end the search after that time; needs --ledger to go on later")
    parser.add_argument("--model-out")
    parser.add_argument("--report-out")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("survey").getOrCreate()
    start = time.time()
    options = {"partitions": args.partitions, "ledger": args.ledger, "seconds": args.seconds}
    try:
        study = run(spark, args.path, args.task, args.search, args.parallelism, **options)
    except tuning.Unfinished as stopped:
        spark.stop()
        raise SystemExit(str(stopped)) from None
    trained = time.time() - start
    print("best parameters:", study.search.best)
    study.report.show(truncate=False)
    if args.task == "age":
        indexers = [m for m in study.search.model.stages if isinstance(m, StringIndexerModel)]
        index_mapping(spark, indexers[-1]).show(truncate=False)
        metrics.confusion_counts(study.scored).orderBy("label", "prediction").show(200)
    if args.report_out:
        best = tuning.parameter_rows(spark, study.search.best)
        best.write.mode("overwrite").parquet(f"{args.report_out}/parameters")
        study.report.write.mode("overwrite").parquet(f"{args.report_out}/metrics")
    if args.model_out:
        tuning.save_model(study.search.model, args.model_out)
    print(f"training seconds: {trained:.3f}  total seconds: {time.time() - start:.3f}")
    spark.stop()


if __name__ == "__main__":
    main()
