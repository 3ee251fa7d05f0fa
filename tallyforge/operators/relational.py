"""Joins, filters and aggregates over interactions ``(user, item, rating)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyforge.functions.scalar import unknown_label


def resolve_alias(facts: DataFrame, alias: DataFrame, item: str = "item") -> DataFrame:
    """Replace an item by its alias target, one hop only.

    A repeated alias key resolves to its largest target.
    """
    one_each = alias.groupBy("bad_id").agg(F.max("good_id").alias("good_id"))
    joined = facts.join(one_each, facts[item] == one_each["bad_id"], "left")
    resolved = F.coalesce(F.col("good_id"), F.col(item)).alias(item)
    return joined.select(*[resolved if c == item else F.col(c) for c in facts.columns])


def merge_ratings(facts: DataFrame) -> DataFrame:
    """Sum the ratings of repeated ``(user, item)`` pairs."""
    return facts.groupBy("user", "item").agg(F.sum("rating").alias("rating"))


def with_names(df: DataFrame, names: DataFrame, item: str = "item") -> DataFrame:
    """Add ``name``; an item without one reads ``Unknown(id)``."""
    one_each = names.groupBy(F.col("item").alias("_named")).agg(F.max("name").alias("_name"))
    joined = df.join(one_each, df[item] == F.col("_named"), "left")
    return joined.select(*df.columns, unknown_label(F.col("_name"), F.col(item)).alias("name"))


def active_users(facts: DataFrame, min_items: int) -> DataFrame:
    """Users with at least ``min_items`` distinct items, with their item and row counts."""
    per_user = facts.groupBy("user").agg(
        F.countDistinct("item").alias("n_items"), F.count(F.lit(1)).alias("n_rows")
    )
    return per_user.filter(F.col("n_items") >= min_items)


def keep_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of the given users."""
    return df.join(users, "user", "left_semi")


def exclude_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose ``(user, item)`` is not among ``pairs``."""
    return df.join(pairs, ["user", "item"], "left_anti")


def pairs(facts: DataFrame) -> DataFrame:
    """Distinct ``(user, item)`` pairs."""
    return facts.select("user", "item").distinct()


def item_sets(facts: DataFrame, width: int = 1024) -> DataFrame:
    """Every user's item set as sorted arrays, one per range of ``width`` item ids.

    A range holds at most ``width`` different ids, so no array grows with the data.
    """
    chunk = F.expr(f"(item - pmod(item, {width}L)) div {width}L").alias("chunk")
    return facts.groupBy("user", chunk).agg(F.sort_array(F.collect_set("item")).alias("items"))


def item_totals(facts: DataFrame) -> DataFrame:
    """Total rating per item."""
    return facts.groupBy("item").agg(F.sum("rating").alias("total"))


def most_popular(facts: DataFrame, n: int) -> DataFrame:
    """The ``n`` items with the largest totals, ties by item, with their ``rank``."""
    order = [F.col("total").desc(), F.col("item")]
    top = item_totals(facts).orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(*order)))
