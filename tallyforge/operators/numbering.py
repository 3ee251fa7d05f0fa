"""Numbers for values, as tables: dense ids and category indices without labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyforge.operators.running import running_totals
from tallyforge.session import write_intermediate


def dense_ids(df: DataFrame, column: str, name: str = "dense") -> DataFrame:
    """``(column, name)``: every distinct value with its place from 0 in ascending order, stored.

    The numbers have no gaps and follow from the values alone, whatever their type.  Ranges
    of values are numbered apart and shifted by the sizes of those before, so no task sees all
    of them.  The table maps both ways.  A NULL has no number.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    counted = running_totals(values.withColumn("_one", F.lit(1)), [F.col(column)], ["_one"], "dense-ids")
    return write_intermediate(counted.select(column, (F.col("run__one") - 1).cast("bigint").alias(name)), "dense-ids")


def replace_ids(df: DataFrame, ids: DataFrame, column: str, name: str = "dense") -> DataFrame:
    """``column`` of ``df`` as its number in ``ids``; rows with values that have none are left out."""
    known = ids.select(F.col(column).alias("_value"), F.col(name).alias("_number"))
    joined = df.join(known, F.col(column) == F.col("_value"))
    return joined.select(*[F.col("_number").alias(c) if c == column else F.col(c) for c in df.columns])


def original_ids(df: DataFrame, ids: DataFrame, column: str, name: str = "dense") -> DataFrame:
    """The reverse of ``replace_ids``."""
    known = ids.select(F.col(column).alias("_value"), F.col(name).alias("_number"))
    joined = df.join(known, F.col(column) == F.col("_number"))
    return joined.select(*[F.col("_value").alias(c) if c == column else F.col(c) for c in df.columns])


def category_table(df: DataFrame, column: str) -> DataFrame:
    """``(value, index, n)`` of a text column, most frequent first, equal counts by value; stored.

    What a fitted string indexer keeps as an array on the driver, for any number of levels:
    counts are ranged by frequency and numbered range by range.  NULLs have no level.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("value")]
    placed = running_totals(counts.withColumn("_one", F.lit(1)), order, ["_one"], "levels")
    return write_intermediate(placed.select("value", (F.col("run__one") - 1).cast("double").alias("index"), "n"), "levels")


def index_by_table(df: DataFrame, column: str, levels: DataFrame, output: str) -> DataFrame:
    """Add the index of a category; values without a level and NULL share the one after the last.

    The most frequent value joins against one row of ``levels``; adaptive execution splits
    such a key on the side of ``df``.
    """
    known = levels.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
    joined = df.join(known, F.col(column).cast("string") == F.col("_value"), "left")
    return joined.select(*df.columns, F.coalesce("_index", F.lit(float(levels.count()))).alias(output))
