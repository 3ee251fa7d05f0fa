import pytest
from pyspark.sql import functions as F

from tallyforge.functions.hashing import salted_md5
from tallyforge.operators import splits
from tallyforge.operators.relational import item_sets, resolve_alias
from tallyforge.operators.running import running_totals
from tallyforge.operators.skew import cut_groups, group_sizes, hash_ranks


@pytest.fixture(scope="module")
def facts(spark):
    """One user holds a third of the rows; the last users have a single row."""
    n = 3000
    user = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") < 2900, F.col("id") % 40 + 1).otherwise(F.col("id"))
    return spark.range(n).select(
        user.cast("bigint").alias("user"), (F.col("id") % 700).alias("item"),
        F.lit(1.0).alias("rating"), F.col("id").alias("key"),
    )


def as_rows(df):
    return sorted(map(tuple, df.collect()))


def test_cut_groups_give_the_same_ranks(facts):
    order = salted_md5("t", 1, "key")
    plain = hash_ranks(facts, ["user"], order, ["key"])
    cut = hash_ranks(facts, ["user"], order, ["key"], range_rows=20, repeated=False)
    assert cut_groups(group_sizes(facts, ["user"]), ["user"], 20).agg(F.max("_ranges")).first()[0] == 50
    assert as_rows(plain) == as_rows(cut)
    assert [r["rank"] for r in cut.filter("user = 0").orderBy("rank").collect()] == list(range(1, 1001))


def test_any_number_of_groups_is_cut(spark):
    rows = spark.range(20_000).select((F.col("id") % 5000).alias("user"), F.col("id").alias("key"))
    hot = cut_groups(group_sizes(rows, ["user"]), ["user"], range_rows=2)
    assert hot.agg(F.count("*"), F.min("_ranges"), F.max("_ranges")).first() == (5000, 2, 2)
    order = salted_md5("t", 1, "key")
    ranked = hash_ranks(rows, ["user"], order, ["key"], range_rows=2)
    assert as_rows(ranked) == as_rows(hash_ranks(rows, ["user"], order, ["key"]))


def test_equal_rows_of_one_user_are_ranked_without_gaps(spark):
    rows = spark.range(30_000).select(F.lit(7).alias("user"), (F.col("id") % 3).alias("item"))
    ranked = hash_ranks(rows, ["user"], salted_md5("t", 1, "item"), ["item"], range_rows=500)
    found = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 30_001))
    assert {r["group_rows"] for r in found} == {30_000}
    assert all(sum(r["item"] == i for r in found) == 10_000 for i in range(3))


def test_user_split(facts):
    split = splits.user_split(facts, ["key"])
    per_user = split.groupBy("user").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("train")
    ).collect()
    assert all(r.train == max(1, int(r.n * 0.8)) for r in per_user)
    assert as_rows(split) == as_rows(splits.user_split(facts.repartition(7), ["key"], range_rows=20))
    assert split.count() == facts.count()


def test_hash_split_ignores_layout_and_folds_are_independent(facts):
    a = splits.assign_folds(splits.hash_split(facts, ["key"]), ["key"])
    b = splits.assign_folds(splits.hash_split(facts.repartition(3), ["key"]), ["key"])
    assert as_rows(a) == as_rows(b)
    counts = {(r.split, r.fold): r["count"] for r in a.groupBy("split", "fold").count().collect()}
    assert len(counts) == 10
    for fold in range(5):
        share = counts["train", fold] / (counts["train", fold] + counts["test", fold])
        assert 0.74 < share < 0.86


def test_synthetic_user(facts):
    rows = splits.synthetic_user(facts, 8).orderBy(F.col("rating").desc()).collect()
    assert [r.rating for r in rows] == [5000.0 - 300 * i for i in range(8)]
    assert {r.user for r in rows} == {3000} and len({r.item for r in rows}) == 8


def test_random_split_option(facts):
    a, b = splits.random_split(facts, [0.8, 0.2])
    assert a.count() + b.count() == facts.count()


def test_alias_is_one_hop_and_repeats_take_the_largest(spark):
    facts = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (1, 9, 1.0)], "user long, item long, rating double")
    alias = spark.createDataFrame([(1, 2), (2, 3), (2, 4)], "bad_id long, good_id long")
    assert sorted(r.item for r in resolve_alias(facts, alias).collect()) == [2, 4, 9]


def test_item_sets_hold_every_pair_once(facts):
    sets = item_sets(facts, width=64)
    assert sets.agg(F.max(F.size("items"))).first()[0] <= 64
    again = sets.select("user", F.explode("items").alias("item"))
    assert as_rows(again) == as_rows(facts.select("user", "item").distinct())


def test_running_totals(spark):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    got = {r.id: r.run_v for r in running_totals(rows, [F.col("id").desc()], ["v"]).collect()}
    total = 0
    for i in range(999, -1, -1):
        total += i % 7
        assert got[i] == total
