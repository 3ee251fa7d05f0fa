"""Delimited line formats of the listening data: names, aliases and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.functions.scalar import strict_int, trim_control
from tallyforge.sources.parsed import Parsed, split_by_reason


def parse_dimension(lines: DataFrame) -> Parsed:
    """``id<TAB>name`` lines, lenient: a line without tab or integer id is refused.

    The name is everything after the first tab, trimmed; an all-blank name is
    kept as empty text.
    """
    cut = lines.withColumn("_parts", F.split("value", "\t", 2))
    cut = cut.withColumn("_id", strict_int(F.get("_parts", F.lit(0))))
    reason = F.when(F.size("_parts") < 2, F.lit("no tab")).when(F.col("_id").isNull(), F.lit("bad id"))
    fields = {"item": F.col("_id"), "name": trim_control(F.get("_parts", F.lit(1)))}
    return split_by_reason(cut, reason, fields, "drop", ("_parts", "_id"))


def parse_alias(lines: DataFrame, on_error: str = "drop") -> Parsed:
    """``bad_id<TAB>good_id`` lines; a line with an empty first token is left out."""
    cut = lines.withColumn("_tokens", F.split("value", "\t", -1)).filter(~F.col("value").startswith("\t") & (F.col("value") != ""))
    cut = cut.withColumns({name: strict_int(F.get("_tokens", F.lit(i))) for i, name in enumerate(("_bad", "_good"))})
    reason = F.when(F.col("_bad").isNull(), F.lit("bad alias id")).when(
        F.col("_good").isNull(), F.lit("bad target id")
    )
    fields = {"bad_id": F.col("_bad"), "good_id": F.col("_good")}
    return split_by_reason(cut, reason, fields, on_error, ("_tokens", "_bad", "_good"))


def parse_facts(lines: DataFrame, on_error: str = "drop") -> Parsed:
    """``user item count`` lines, exactly three integers between single blanks."""
    labels = ("user", "item", "count")
    cut = lines.withColumn("_tokens", F.split(F.rtrim("value"), " ", -1))
    cut = cut.withColumns({f"_{label}": strict_int(F.get("_tokens", F.lit(i))) for i, label in enumerate(labels)})
    reason = F.when(F.size("_tokens") != 3, F.lit("not three tokens"))
    for label in labels:
        reason = reason.when(F.col(f"_{label}").isNull(), F.lit(f"bad {label}"))
    fields = {"user": F.col("_user"), "item": F.col("_item"), "rating": F.col("_count").cast("double")}
    return split_by_reason(cut, reason, fields, on_error, ("_tokens", *(f"_{label}" for label in labels)))


def read_dimension(spark: SparkSession, path: str) -> Parsed:
    return parse_dimension(spark.read.text(path))


def read_alias(spark: SparkSession, path: str, on_error: str = "drop") -> Parsed:
    return parse_alias(spark.read.text(path), on_error)


def read_facts(spark: SparkSession, path: str, on_error: str = "drop") -> Parsed:
    return parse_facts(spark.read.text(path), on_error)
