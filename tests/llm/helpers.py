"""Rows that every operator has to cope with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: dict[int | None, str | None] | list[tuple[int | None, str | None]]) -> DataFrame:
    pairs = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOC)


def with_clashing_columns(docs: DataFrame) -> DataFrame:
    """Columns of names that operators use themselves, and two of the same name but for case."""
    out = docs
    for name in ("_key", "_text", "_row", "score", "spans", "id", "kept", "group", "component_id", "sequence_id", "Start"):
        out = out.selectExpr("*", f"'clash' AS `{name}`")
    return out
