"""Ranked lists ``(user, item, score)`` judged against held-out ``(user, item)`` pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.functions.scalar import safe_ratio
from tallyforge.operators.relational import pairs
from tallyforge.operators.running import range_numbered


def same_list(users: DataFrame, top: DataFrame) -> DataFrame:
    """Give every user the same short list ``(item, total, rank)``.

    The list travels as one value of a scalar subquery: no join takes place.
    """
    ordered = F.sort_array(F.collect_list(F.struct("rank", "item", "total")))
    return (
        users.select("user", top.agg(ordered).scalar().alias("_list"))
        .select("user", F.explode_outer("_list").alias("_entry"))
        .select(
            "user",
            F.col("_entry.item").alias("item"),
            F.col("_entry.total").alias("score"),
            F.col("_entry.rank").alias("rank"),
        )
    )


def label_lists(lists: DataFrame, held_out: DataFrame) -> DataFrame:
    """Add ``label`` 1.0 where the pair is held out, else 0.0."""
    marked = pairs(held_out).withColumn("_hit", F.lit(1.0))
    labelled = lists.join(marked, ["user", "item"], "left")
    return labelled.withColumn("label", F.coalesce("_hit", F.lit(0.0))).drop("_hit")


def _areas(above: Column, last: Column) -> list[Column]:
    """Both AUC definitions from ``hits``, ``misses`` and two sums.

    ``above`` is the number of hits above a miss, summed over the misses, and
    ``last`` the hits above the last miss.  ``exact`` is the share of ordered
    (hit, miss) pairs; ``stepwise`` walks down the list and takes at each miss
    the mean of the hit counts there and at the miss before.  Both are 0.5 for a
    list without hits or without misses.
    """
    hits, misses = F.col("hits"), F.col("misses")
    pairs_ = hits.cast("double") * misses

    def guarded(numerator: Column) -> Column:
        return F.when((hits > 0) & (misses > 0), numerator / pairs_).otherwise(F.lit(0.5))

    return [guarded(above - last / 2).alias("stepwise"), guarded(above).alias("exact")]


def list_auc(labelled: DataFrame) -> DataFrame:
    """Stepwise and exact AUC of every user's list; lists are short (top k), ties go by item."""
    order = Window.partitionBy("user").orderBy(F.col("score").desc(), "item")
    miss = F.col("label") == 0
    per_user = (
        labelled.withColumn("_rank", F.row_number().over(order).cast("bigint"))
        .groupBy("user")
        .agg(
            F.count_if(~miss).alias("hits"),
            F.count_if(miss).alias("misses"),
            F.sum(F.when(miss, F.col("_rank"))).alias("_sum"),
            F.max(F.when(miss, F.col("_rank"))).alias("_last"),
        )
    )
    misses = F.col("misses")
    above = F.col("_sum") - misses * (misses + 1) / 2
    return per_user.select("user", "hits", "misses", *_areas(above, F.col("_last") - misses))


def shared_list_auc(held_out: DataFrame, top: DataFrame) -> DataFrame:
    """``list_auc`` of one short list ``(item, rank)`` given to every user, from its hits only.

    Emits no row per user and listed item: the held-out pairs meet the listed
    items in a broadcast join.  Users without a hit are absent.
    """
    listed = F.broadcast(top.select("item", F.col("rank").cast("bigint").alias("_rank")))
    found = held_out.select("user", "item").join(listed, "item").distinct()
    mine = Window.partitionBy("user")
    misses_above = F.col("_rank") - F.row_number().over(mine.orderBy("_rank"))
    size = top.agg(F.count(F.lit(1))).scalar()
    placed = found.select(
        "user",
        misses_above.alias("_misses_above"),
        F.count(F.lit(1)).over(mine).alias("hits"),
        size.alias("_size"),
    ).withColumn("misses", F.col("_size") - F.col("hits"))
    misses, misses_above = F.col("misses"), F.col("_misses_above")
    per_user = placed.groupBy("user", "hits", "misses").agg(
        F.sum(misses - misses_above).alias("_above"),
        F.count_if(misses_above < misses).alias("_last"),
    )
    return per_user.select("user", "hits", "misses", *_areas(F.col("_above"), F.col("_last")))


def pooled_auc(labelled: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stepwise and exact AUC of all users' lists in one ranking, ties by user then item.

    The ranking is cut into stored ranges; each range is ranked on its own and
    the range totals are put together afterwards.
    """
    by = by or []
    order = [F.col("score").desc(), F.col("user"), F.col("item")]
    columns = [*by, "user", "item", "score", "label"]
    stored = range_numbered(labelled.select(*columns), [*[F.col(c) for c in by], *order], "pooled")
    miss = F.col("label") == 0
    local = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order)).cast("bigint")
    ranges = (
        stored.withColumn("_rank", local)
        .groupBy(*by, "_part")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(miss).alias("_misses"),
            F.sum(F.when(miss, F.col("_rank"))).alias("_sum"),
            F.max(F.when(miss, F.col("_rank"))).alias("_last"),
        )
    )
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    whole = (
        ranges.withColumn("_before", before)
        .groupBy(*by)
        .agg(
            F.sum(F.col("_rows") - F.col("_misses")).alias("hits"),
            F.sum("_misses").alias("misses"),
            F.sum(F.col("_sum").cast("decimal(38,0)") + F.col("_before") * F.col("_misses")).alias("_sum"),
            F.max(F.col("_last") + F.col("_before")).alias("_last"),
        )
    )
    misses = F.col("misses")
    below = misses.cast("decimal(38,0)") * (misses + 1) / 2
    above = (F.col("_sum") - below).cast("double")
    return whole.select(*by, "hits", "misses", *_areas(above, F.col("_last") - misses))


def rank_metrics(per_user: DataFrame, held_out: DataFrame) -> DataFrame:
    """Add precision, recall and the Jaccard overlap of list and held-out set.

    ``per_user`` is the result of ``list_auc``: its hits and misses are the true
    and false positives.
    """
    sizes = held_out.groupBy("user").agg(F.countDistinct("item").alias("held_out"))
    tp, fp = F.col("hits"), F.col("misses")
    fn = F.coalesce(F.col("held_out"), F.lit(0).cast("bigint")) - tp
    return per_user.join(sizes, "user", "left").select(
        *per_user.columns,
        fn.alias("unlisted"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp, tp + fp + fn).alias("jaccard"),
    )


def eligible(per_user: DataFrame) -> DataFrame:
    """Users whose list has both a hit and a miss."""
    return per_user.filter((F.col("hits") > 0) & (F.col("misses") > 0))


def macro_auc(per_user: DataFrame, empty: float | None = None) -> DataFrame:
    """Mean AUC of the eligible users and how many they are; ``empty`` if there are none."""

    def mean(column: str) -> Column:
        value = F.avg(column)
        return (value if empty is None else F.coalesce(value, F.lit(float(empty)))).alias(column)

    return eligible(per_user).agg(
        F.count(F.lit(1)).alias("n_users"), mean("stepwise"), mean("exact")
    )


def macro_rank_metrics(labelled: DataFrame, held_out: DataFrame) -> DataFrame:
    """Means over eligible users of AUC, precision, recall and Jaccard; NULL without any."""
    judged = rank_metrics(eligible(list_auc(labelled)), held_out)
    means = [F.avg(c).alias(c) for c in ("stepwise", "exact", "precision", "recall", "jaccard")]
    return judged.agg(F.count(F.lit(1)).alias("n_users"), *means)
