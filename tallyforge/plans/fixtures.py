"""Inputs of the analyses derived from the order tables.

The tables hold no survey, weather or listening data, so their rows are given
those shapes here: interactions (user, item, rating), records in the text
formats, and labelled rows for the classifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.functions.hashing import bucket
from tallyforge.sources.survey import SURVEY_COLUMNS
from tallyforge.session import intermediate_path, write_intermediate

ROW_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FACT_KEYS = ["order", "item", "supplier", "line"]
MIN_ITEMS = 40
TOP = 50

SURVEY_LIKE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SURVEY_LIKE_CATEGORICAL = [
    "l_returnflag", "l_linestatus", "o_orderstatus", "p_brand", "p_type", "c_mktsegment"
]
VALUES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user, item, rating)`` with the key of the line."""
    return ordered_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("rating"),
        F.col("l_orderkey").alias("order"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_linenumber").alias("line"),
    )


def stored_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interactions written once, for queries that read them several times."""
    return write_intermediate(interactions(spark, sf_dir), "facts")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts point to the first part of their brand and type, those to the first of the brand.

    Every fifth size has no alias; those of one size have a second, smaller target.
    """
    part = table(spark, sf_dir, "part")
    kinds = part.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("first"))
    brands = kinds.groupBy("p_brand").agg(F.min("first").alias("brand_first"))
    known = part.join(kinds, ["p_brand", "p_type"]).join(brands, "p_brand")
    target = F.when(F.col("p_partkey") == F.col("first"), F.col("brand_first")).otherwise(F.col("first"))
    one = known.filter("p_size % 5 <> 0").select(F.col("p_partkey").alias("bad_id"), target.alias("good_id"), "p_size")
    second = one.filter("p_size = 7").withColumn("good_id", F.lit(0).cast(one.schema["good_id"].dataType))
    return one.unionByName(second)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a yes/no ``answer`` that depends on the quantity and noise."""
    noise = bucket("noise", 42, 30, *ROW_KEYS)
    answer = F.when(F.col("l_quantity") + noise > 45, "Yes").otherwise("No")
    return table(spark, sf_dir, "lineitem").withColumn("answer", answer)


def survey_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled line items with order, part and customer attributes."""
    rows = labelled(spark, sf_dir)
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    customer = table(spark, sf_dir, "customer")
    age = F.least(F.lit(12), F.floor((F.col("l_quantity") + bucket("noise13", 42, 12, *ROW_KEYS)) / 4))
    return (
        rows.join(orders, rows.l_orderkey == orders.o_orderkey)
        .join(part, F.col("l_partkey") == part.p_partkey)
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .select(
            *ROW_KEYS, *SURVEY_LIKE_NUMERIC, *SURVEY_LIKE_CATEGORICAL, "answer",
            F.format_string("group %02d", age.cast("int")).alias("age_group"),
        )
    )


def survey_files(spark: SparkSession, sf_dir: str) -> str:
    """CSV files with header in the survey's columns; some numbers are missing, one text needs quotes."""
    values = {
        "HeartDisease": F.col("answer"), "BMI": F.col("l_quantity"), "Smoking": F.col("l_returnflag"),
        "PhysicalHealth": F.col("l_linenumber"), "AgeCategory": F.col("l_linestatus"),
        "MentalHealth": F.when(F.col("l_tax") != 0.08, F.col("l_discount")), "SleepTime": F.col("l_tax"),
        "Race": F.when(F.col("l_quantity") > 25, 'a, "b"').otherwise("c"),
    }
    path = intermediate_path(spark, "survey")
    rows = labelled(spark, sf_dir).select(*[values.get(c, F.lit("No")).alias(c) for c in SURVEY_COLUMNS])
    rows.write.option("header", True).csv(path)
    return path


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label, a rule's prediction and two scores."""
    return labelled(spark, sf_dir).select(
        *ROW_KEYS,
        F.when(F.col("answer") == "Yes", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_quantity") > 30, 1.0).otherwise(0.0).alias("prediction"),
        F.col("l_quantity").alias("coarse_score"),
        F.col("l_extendedprice").alias("fine_score"),
    )


def judged_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with one of 13 classes and a rule's prediction of it."""
    quantity = F.col("l_quantity")
    label = F.least(F.lit(12), F.floor((quantity + bucket("noise13", 42, 12, *ROW_KEYS)) / 4))
    guess = F.least(F.lit(13), F.floor((quantity + 6) / 4))
    return table(spark, sf_dir, "lineitem").select(
        label.cast("double").alias("label"), guess.cast("double").alias("prediction")
    )


def write_lines(lines: DataFrame, label: str) -> str:
    """Write lines as text files and give a glob that matches them."""
    path = intermediate_path(lines.sparkSession, label)
    lines.write.text(path)
    return f"{path}/part-*"


def weather_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The integers that go into a record, and which records are damaged."""
    whole = lambda e: e.cast("int")
    month = F.month("o_orderdate")
    return ordered_lines(spark, sf_dir).select(
        *ROW_KEYS,
        F.year("o_orderdate").alias("year"),
        month.alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
        whole(F.pmod(F.col("l_linenumber") * 3, F.lit(24))).alias("hour"),
        whole(F.pmod("l_partkey", F.lit(180_001)) - 90_000).alias("latitude"),
        whole(F.pmod("l_suppkey", F.lit(360_001)) - 180_000).alias("longitude"),
        whole(F.pmod("o_custkey", F.lit(1000)) - 100).alias("elevation"),
        whole(F.pmod("o_custkey", F.lit(360))).alias("direction"),
        whole(F.col("l_quantity") * 7).alias("speed"),
        whole(F.pmod(F.floor("l_extendedprice"), F.lit(22_001))).alias("ceiling"),
        whole(F.floor("l_extendedprice")).alias("distance"),
        whole(F.col("l_linenumber") * 10 - 35).alias("dew"),
        whole(F.col("l_quantity") * 4 - 12 * F.abs(month - 7) + F.pmod("o_custkey", F.lit(10))).alias("air"),
        (F.col("l_discount") == 0).alias("no_air"),
        (F.col("l_quantity") == 50).alias("bad_year"),
        (F.col("l_tax") == 0.08).alias("cut_short"),
    )


def weather_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of fixed-width records, some without temperature, cut short or with a bad year."""

    def digits(name: str, width: int) -> Column:
        return F.lpad(F.col(name).cast("string"), width, "0")

    def signed(name: str, width: int) -> Column:
        sign = F.when(F.col(name) < 0, "-").otherwise("+")
        return F.concat(sign, F.lpad(F.abs(name).cast("string"), width - 1, "0"))

    record = F.concat(
        F.lit("0" * 15),
        F.when(F.col("bad_year"), F.lit("19x5")).otherwise(digits("year", 4)),
        digits("month", 2), digits("day", 2), digits("hour", 2),
        F.lit("004"),
        signed("latitude", 6), signed("longitude", 7),
        F.lit("FM-15"),
        signed("elevation", 5),
        F.lit("99999V020"),
        digits("direction", 3),
        F.lit("1N"),
        digits("speed", 4),
        F.lit("1"),
        digits("ceiling", 5),
        F.lit("1CN"),
        digits("distance", 6),
        F.lit("1N9"),
        F.when(F.col("no_air"), F.lit("+9999")).otherwise(signed("air", 5)),
        F.lit("1"),
        signed("dew", 5),
        F.lit("1"),
    )
    line = F.when(F.col("cut_short"), F.substring(record, 1, 95)).otherwise(record)
    return write_lines(weather_numbers(spark, sf_dir).select(line.alias("value")), "weather")


def fact_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of ``user item count`` lines, some with two tokens, a bad count or a trailing blank."""
    triple = F.concat_ws(" ", "o_custkey", "l_partkey", F.col("l_quantity").cast("int"))
    line = (
        F.when(F.col("l_tax") == 0.08, F.concat_ws(" ", "o_custkey", "l_partkey"))
        .when(F.col("l_quantity") == 50, F.concat(triple, F.lit("x")))
        .when(F.col("l_discount") == 0, F.concat(triple, F.lit(" ")))
        .otherwise(triple)
    )
    return write_lines(ordered_lines(spark, sf_dir).select(line.alias("value")), "facts")


def dimension_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of ``id<TAB>name`` lines with missing tabs, bad ids, blank names and second tabs."""
    key, name, size = F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_size")
    line = (
        F.when(size == 1, F.concat(key, F.lit(" "), name))
        .when(size == 2, F.concat(F.lit("x"), key, F.lit("\t"), name))
        .when(size == 3, F.concat(key, F.lit("\t   ")))
        .when(size == 4, F.concat(key, F.lit("\t"), name, F.lit("\t"), F.col("p_brand")))
        .otherwise(F.concat(key, F.lit("\t "), name, F.lit(" ")))
    )
    return write_lines(table(spark, sf_dir, "part").select(line.alias("value")), "names")


def alias_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of ``bad<TAB>good`` lines, some without the first or the second id."""
    bad = F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("bad_id").cast("string"))
    good = F.when(F.col("p_size") == 2, F.lit("")).otherwise(F.col("good_id").cast("string"))
    lines = aliases(spark, sf_dir).select(F.concat(bad, F.lit("\t"), good).alias("value"))
    return write_lines(lines, "aliases")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles rounded for comparison with another engine."""
    changed = {c: F.round(c, digits) for c in columns}
    return df.withColumns(changed)


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the parts above size 10; smaller parts have none."""
    named: Column = F.col("p_size") > 10
    return table(spark, sf_dir, "part").filter(named).select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("name")
    )
