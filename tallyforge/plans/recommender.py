"""Implicit-feedback recommender with a most-popular baseline.

    python -m tallyforge.plans.recommender FACTS --names NAMES --aliases ALIASES
"""

from __future__ import annotations

import argparse
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyforge.functions.scalar import rank_line
from tallyforge.operators import factors, metrics, ranking, relational as rel, splits, tuning
from tallyforge.sources import delimited
from tallyforge.session import write_intermediate


class Prepared(NamedTuple):
    facts: DataFrame
    train: DataFrame
    test: DataFrame
    popular: DataFrame


def prepare(
    facts: DataFrame, keys: list[str], min_items: int, top: int, seed: int = 42, repeated: bool = True
) -> Prepared:
    """Active users' rows split per user, and the most popular items of all users.

    ``facts`` is read several times and should be stored or persisted.  What is
    used more than once later is written: the active users, the split rows (by
    side, so that a reader of one side does not scan the other) and the top list.
    """
    active = write_intermediate(rel.active_users(facts, min_items), "active-users")
    sizes = active.select("user", F.col("n_rows").alias("_rows"))
    split = splits.user_split(rel.keep_users(facts, active), keys, seed=seed, sizes=sizes, repeated=repeated)
    split = write_intermediate(split, "user-split", partition_by="split")
    train = split.filter("split = 'train'").drop("split")
    test = split.filter("split = 'test'").drop("split")
    return Prepared(facts, train, test, write_intermediate(rel.most_popular(facts, top), "popular"))


def baseline(data: Prepared) -> DataFrame:
    """Macro AUC of the most-popular list; 0.0 without an eligible user."""
    return ranking.macro_auc(ranking.shared_list_auc(data.test, data.popular), empty=0.0)


def new_user_report(data: Prepared, names: DataFrame, point: dict, **options) -> DataFrame:
    """Top recommendations of a synthetic user with names and printable lines."""
    found = factors.new_user_recommendations(data.facts, data.train, point, **options)
    order = Window.partitionBy().orderBy(F.col("score").desc(), "item")  # a few rows
    ranked = rel.with_names(found.withColumn("rank", F.row_number().over(order)), names)
    line = rank_line(F.col("rank"), F.col("name"), F.col("item"), F.col("score"))
    return ranked.withColumn("line", line)


def load(spark: SparkSession, facts: str, aliases: str, merge: str = "none", on_error: str = "fail") -> DataFrame:
    """Facts with aliases resolved; ``merge='sum'`` adds up repeated pairs."""
    rows = delimited.read_facts(spark, facts, on_error).good
    rows = rel.resolve_alias(rows, delimited.read_alias(spark, aliases, on_error).good)
    return rel.merge_ratings(rows) if merge == "sum" else rows


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("facts")
    parser.add_argument("--names", required=True)
    parser.add_argument("--aliases", required=True)
    parser.add_argument("--min-items", type=int, default=100)
    parser.add_argument("--top", type=int, default=50)
    parser.add_argument("--folds", type=int, default=5)
    parser.add_argument("--merge", choices=["none", "sum"], default="none")
    parser.add_argument("--parallelism", type=int, default=1)
    parser.add_argument("--blocks", type=int, default=factors.BLOCKS)
    parser.add_argument("--ledger", help="folder of finished fits; the same command goes on from there")
    parser.add_argument("--seconds", type=float, help="end the search after that time; needs --ledger to go on later")
    for option, name in (("ranks", "rank"), ("lambdas", "regParam"), ("alphas", "alpha")):
        values = list(dict.fromkeys(point[name] for point in tuning.ALS_GRID))
        parser.add_argument(f"--{option}", nargs="+", type=type(values[0]), default=values)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("recommender").getOrCreate()
    facts = load(spark, args.facts, args.aliases, args.merge).persist(StorageLevel.MEMORY_AND_DISK)
    keys = ["user", "item", "rating"]
    data = prepare(facts, keys, args.min_items, args.top)
    print("most popular:")
    baseline(data).show()
    points = tuning.grid(rank=args.ranks, regParam=args.lambdas, alpha=args.alphas)
    try:
        table, best, model = factors.search_als(
            data.train, keys, points, args.folds, k=args.top, parallelism=args.parallelism, blocks=args.blocks,
            ledger=args.ledger, seconds=args.seconds,
        )
    except tuning.Unfinished as stopped:
        spark.stop()
        raise SystemExit(str(stopped)) from None
    tuning.ranked_points(table).show(truncate=False)
    print("best parameters:", best)
    metrics.metric_rows(factors.held_out_metrics(model, data.test, args.top)).show()
    names = delimited.read_dimension(spark, args.names).good
    new_user_report(data, names, best, blocks=args.blocks).orderBy("rank").select("line").show(25, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
