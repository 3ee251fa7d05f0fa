"""Repeatable splits, folds, samples and the synthetic user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyforge.functions.hashing import bucket, salted_md5
from tallyforge.operators.skew import RANGE_ROWS, hash_ranks


def hash_split(df: DataFrame, keys: list[str], train_percent: int = 80, seed: int = 42) -> DataFrame:
    """Add ``split`` (``train``/``test``), fixed by the row's key alone."""
    in_train = bucket("split", seed, 100, *keys) < train_percent
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Spark's own sampling split; depends on the layout of the input."""
    return df.randomSplit(weights, seed)


def temporal_split(
    df: DataFrame, year: str, train: tuple[int, int], valid: int, test: int
) -> DataFrame:
    """Add ``split`` by year; rows of other years are left out."""
    when = F.col(year)
    split = (
        F.when(when.between(*train), "train").when(when == valid, "valid").when(when == test, "test")
    )
    return df.withColumn("split", split).filter(F.col("split").isNotNull())


def user_split(
    df: DataFrame,
    keys: list[str],
    share: float = 0.8,
    seed: int = 42,
    sizes: DataFrame | None = None,
    range_rows: int = RANGE_ROWS,
    repeated: bool = True,
) -> DataFrame:
    """Add ``split``: of each user's rows in random order the first ``share`` train.

    Every user keeps at least one training row.  ``keys`` order a user's rows;
    ``repeated=False`` says that no row repeats.  ``sizes`` are the users' row counts ``(user, _rows)`` where already known.
    """
    order = salted_md5("user-split", seed, *keys)
    ranked = hash_ranks(df, ["user"], order, keys, sizes, range_rows, repeated)
    cut = F.greatest(F.lit(1), F.floor(F.col("group_rows") * F.lit(share)))
    split = F.when(F.col("rank") <= cut, "train").otherwise("test")
    return ranked.select(*df.columns, split.alias("split"))


def assign_folds(df: DataFrame, keys: list[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in ``[0, k)`` by key; needs no shuffle."""
    return df.withColumn("fold", bucket("fold", seed, k, *keys))


def sample_ids(df: DataFrame, column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` distinct ids in a repeatable random order, with ``position`` from 1."""
    ids = df.select(column).distinct().withColumn("_digest", salted_md5("sample", seed, column))
    chosen = ids.orderBy("_digest", column).limit(n)
    position = F.row_number().over(Window.partitionBy().orderBy("_digest", column))  # n rows
    return chosen.select(column, position.alias("position"))


def next_user(facts: DataFrame) -> DataFrame:
    """One row: the largest user id plus one."""
    return facts.agg((F.max("user") + 1).alias("user"))


def synthetic_user(
    facts: DataFrame, n: int = 8, seed: int = 42, top: int = 5000, step: int = 300
) -> DataFrame:
    """Ratings of a new user for ``n`` sampled items: ``top``, ``top - step``, ..."""
    rating = F.lit(top) - (F.col("position") - 1) * F.lit(step)
    return sample_ids(facts, "item", n, seed).select(
        next_user(facts).scalar().alias("user"), "item", rating.cast("double").alias("rating")
    )
