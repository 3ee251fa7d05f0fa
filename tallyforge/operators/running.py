"""Running totals down a total order without a single-task window.

Rows are range-partitioned by the full order, the partition numbers are written
with the rows (so they cannot change when an executor is lost), and the totals
of the earlier partitions are added to the totals within each one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.session import write_intermediate


def range_numbered(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows with a stored ``_part``: ascending ranges of the given order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order)
    return write_intermediate(ranged.withColumn("_part", F.spark_partition_id()), label)


def running_totals(
    df: DataFrame, order: list[Column], sums: list[str], label: str = "running", by: list[str] | None = None
) -> DataFrame:
    """Add ``run_<name>`` for every summed column, the row itself included.

    ``order`` must be a total order over the rows.  With ``by`` every group has totals of
    its own; groups of any size share the ranges.
    """
    by = by or []
    stored = range_numbered(df, [*map(F.col, by), *order], label)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part", *by)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select("_part", *by, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums])
    )
    local = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = [(F.sum(c).over(local) + F.col(f"_b_{c}")).alias(f"run_{c}") for c in sums]
    # one offset row per range partition: the size is the partition count; groups add as many rows again
    small = offsets if by else F.broadcast(offsets)
    return stored.join(small, ["_part", *by]).select(*df.columns, *totals)
