"""A search's ledger: one row for every finished fit, in the folder that all machines share."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Any

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.session import shared_folder

FORMAT = 1  # part of every fingerprint; raise it when a change of the code changes metrics
SCHEMA = "point string, fold int, metric double"


def fingerprint(rows: DataFrame, *settings: Any) -> str:
    """Digest of the rows, in any order and partitioning, and of the settings of a search.

    One pass: the row count and the sums of two hashes of all columns.  NULLs are hashed
    by their place, so a value that moves to another column changes the digest.
    """
    columns = sorted(rows.columns)
    nulls = F.concat_ws("", *[F.col(c).isNull().cast("int") for c in columns])
    sums = [
        F.sum(F.xxhash64(F.lit(salt), *columns, nulls).cast("decimal(20,0)")).cast("string").alias(f"h{salt}")
        for salt in (1, 2)
    ]
    totals = rows.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    text = json.dumps([FORMAT, columns, list(totals), settings], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def described(stage: Any) -> Any:
    """The class of a stage and the parameters set on it, without what differs between equal stages."""
    if isinstance(stage, Pipeline):
        return [described(s) for s in stage.getStages()]
    return [type(stage).__name__, sorted((p.name, repr(v)) for p, v in stage._paramMap.items())]


def point_key(point: dict) -> str:
    """A grid point as text; it names the point also when the grid around it changes."""
    return json.dumps(point, sort_keys=True)


class Ledger:
    """Metrics of finished fits by (point, fold).

    Every fit is a small table of its own, written once and seen as a whole or not at all,
    so fits of several threads or drivers never touch the same files, and a driver that is
    lost leaves nothing half written behind that would be read.  ``finished`` reads what is
    there; with a search it grows by its number of fits.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def of(cls, rows: DataFrame, *settings: Any, folder: str | None = None) -> Ledger:
        """The ledger of one search: the same rows and settings find it again in any application."""
        spark = rows.sparkSession
        folder = folder or f"{shared_folder(spark)}/tallyforge/searches"
        return cls(spark, f"{folder.rstrip('/')}/{fingerprint(rows, *settings)}")

    def add(self, point: dict, fold: int, metric: float) -> None:
        row = self.spark.createDataFrame([(point_key(point), int(fold), float(metric))], SCHEMA)
        row.coalesce(1).write.parquet(f"{self.path}/fit-{uuid.uuid4().hex}")

    def table(self) -> DataFrame:
        """``(point, fold, metric)``, one row for each of them however often it was recorded."""
        if not self._written():
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/fit-*").groupBy("point", "fold").agg(F.max("metric").alias("metric"))

    def finished(self) -> dict[tuple[str, int], float]:
        return {(r["point"], r["fold"]): r["metric"] for r in self.table().collect()}  # a row for each fit

    def _written(self) -> bool:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/fit-*/part-*")
        found = pattern.getFileSystem(conf).globStatus(pattern)
        return found is not None and len(found) > 0
