"""Temperature regression over fixed-width records, judged on later years.

    python -m tallyforge.plans.weather 'records*' --model linear
"""

from __future__ import annotations

import argparse
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators import metrics, tuning
from tallyforge.operators.features import (
    FOREST_FEATURES,
    LINEAR_FEATURES,
    add_cyclical,
    assembled_stages,
    scaled_stages,
)
from tallyforge.operators.splits import temporal_split
from tallyforge.sources.fixed_width import WEATHER_LAYOUT, read_fixed_width

TARGET = "airTemperature"
# The years of training, validation and test.
TRAIN_YEARS, VALID_YEAR, TEST_YEAR = (1949, 2023), 2024, 2025


class Study(NamedTuple):
    model: PipelineModel
    report: DataFrame  # one row per split: n, mse, rmse, mae, r2
    metrics: DataFrame | None  # grid metrics of a search


def linear_study(
    records: DataFrame,
    train: tuple[int, int] = TRAIN_YEARS,
    valid: int = VALID_YEAR,
    test: int = TEST_YEAR,
    points: list[dict] = tuning.LINEAR_GRID,
    keys: list[str] | None = None,
    seed: int = 42,
    parallelism: int = 2,
    inner_last: int | None = None,
) -> Study:
    """Elastic-net linear regression on scaled features with cyclic month and hour.

    The search inside the training years cuts at random by key or, with ``inner_last``,
    fits on the years up to that one and judges points on the later training years.
    """
    keys = keys or [f.name for f in WEATHER_LAYOUT]
    rows = temporal_split(add_cyclical(records), "year", train, valid, test)
    found = tuning.train_validate(
        rows.filter("split = 'train'"), keys, scaled_stages(LINEAR_FEATURES),
        LinearRegression(featuresCol="features", labelCol=TARGET, maxIter=100),
        points, tuning.rmse_evaluator(TARGET), 80, seed, parallelism,
        canonical=tuning.same_linear_model,
        in_train=None if inner_last is None else F.col("year") <= inner_last,
    )
    return Study(found.model, _report(found.model, rows), found.metrics)


def forest_study(
    records: DataFrame,
    train: tuple[int, int] = TRAIN_YEARS,
    valid: int = VALID_YEAR,
    test: int = TEST_YEAR,
    seed: int = 42,
) -> Study:
    """Random forest with fixed parameters on the plain features."""
    rows = temporal_split(records, "year", train, valid, test)
    # The parameters of the forest.
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=TARGET, numTrees=10, featureSubsetStrategy="auto",
        maxDepth=8, maxBins=32, subsamplingRate=0.7, seed=seed,
    )
    keys = [f.name for f in WEATHER_LAYOUT]
    with tuning.kept(tuning.spread(rows.filter("split = 'train'"), keys)) as train_rows:
        model = Pipeline(stages=[*assembled_stages(FOREST_FEATURES), forest]).fit(train_rows)
    return Study(model, _report(model, rows), None)


def _report(model: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(rows.filter("split <> 'train'"))
    return metrics.regression_metrics_by(scored, ["split"], TARGET)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("path")
    parser.add_argument("--model", choices=["linear", "forest"], default="linear")
    parser.add_argument("--on-error", choices=["drop", "fail"], default="fail")
    parser.add_argument("--model-out")
    parser.add_argument("--report-out")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("weather").getOrCreate()
    records = read_fixed_width(spark, args.path, on_error=args.on_error).good
    study = linear_study(records) if args.model == "linear" else forest_study(records)
    study.report.select("split", *[F.round(c, 4).alias(c) for c in ("mse", "rmse", "mae", "r2")]).show()
    if args.report_out:
        study.report.write.mode("overwrite").parquet(args.report_out)
    if args.model_out:
        tuning.save_model(study.model, args.model_out)
    spark.stop()


if __name__ == "__main__":
    main()
