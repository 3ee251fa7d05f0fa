"""Intermediate tables in the folder that the session names for checkpoints."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import intermediate_path


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write once to the shared folder and read back: (table, its path).

    The lineage ends here, so nothing above is computed again when executors are
    lost.  zstd keeps the copy small.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that no later step reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the session runs on its own machine.

    On a cluster the package comes with --py-files or is installed; a folder that is not
    there is passed over.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BUCKETS = 1 << 21  # of a prefilter: 8 bytes each, whatever the number of keys


def key_buckets(keys: DataFrame, key: str) -> DataFrame:
    """(bucket): the buckets that hold a key, BUCKETS rows at most, so safe to broadcast."""
    return keys.select(bucket_of(F.col(key)).alias("bucket")).distinct()


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def in_buckets(rows: DataFrame, key: str, buckets: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose key falls into one of the buckets, or into none: a join that moves no row.

    An exact join can follow that shuffles only what is left.  With more keys than buckets it
    leaves out less, never a row too many.
    """
    return rows.join(F.broadcast(buckets), bucket_of(F.col(key)) == buckets["bucket"], "left_semi" if inside else "left_anti")
