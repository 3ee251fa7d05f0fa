"""Session helpers: the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the session names it.

    Only a session in local mode that names none gets a folder of its own; on a
    cluster a machine-local folder would not be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tallyforge-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def allow_checkpoints(spark: SparkSession) -> None:
    """Let ML estimators cut their lineage in the shared folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def intermediate_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/tallyforge/{label}-{uuid.uuid4().hex}"


def write_intermediate(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back, which cuts the lineage.

    What was computed (partition numbers, say) stays as written even when
    executors are lost later.  The files stay until the folder is cleaned, like
    Spark's own checkpoints.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, label)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)
