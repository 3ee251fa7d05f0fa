"""Exact dedup: 128-bit content hash, stable id kept, bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of docs: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are.  Rows are grouped by the md5 of the text
    and, below it, by the text itself: the grouping compares the bytes, so texts that
    only share a hash never meet.  Copies collapse in the map-side aggregation, so a
    text that a third of all rows share costs a row per task.  The scan then looks up
    its group by (md5, sha256), a join of short rows that adaptive execution splits.

    keep: "smallest" or "largest" id of the group stays.

    Null text counts as empty; empty texts are equal.  A null id is never kept while
    its group has another id.  Rows that repeat an id and a text all carry kept = true
    (drop_exact_copies leaves one).  An empty table gives an empty one.  Other columns
    are not read, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    pick = F.min if keep == "smallest" else F.max
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    groups = (
        rows.groupBy(_md5(F.col("_text")).alias("_hash"), "_text")
        .agg(pick("_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(F.col("_hash").alias("_group_hash"), F.sha2("_text", 256).alias("_group_sha"), "keep_id", "group_size")
    )
    hashed = rows.select("_id", _md5(F.col("_text")).alias("_hash"), F.sha2("_text", 256).alias("text_sha256"))
    same = (F.col("_hash") == F.col("_group_hash")) & (F.col("text_sha256") == F.col("_group_sha"))
    return hashed.join(groups, same).select(
        F.col("_id").alias(key),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per distinct text: the one exact_groups keeps, with all its columns.

    Grouped in the same way, by hash and bytes; the other columns travel with the key, so
    no join follows.  Null ids come after all others; of rows that repeat the kept id one
    stays.  Columns may have any names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    key_name, text_name = (names[docs.columns.index(c)] for c in (key, text))
    others = [c for c in names if c != text_name]
    row = F.struct(*others, F.col(text_name).isNull().alias("_null"))
    missing = F.col(key_name).isNull()
    first = F.min_by(row, F.struct(missing, key_name)) if keep == "smallest" else F.max_by(row, F.struct(~missing, key_name))
    body = F.coalesce(F.col(text_name), F.lit(""))
    kept = plain.groupBy(_md5(body).alias("_hash"), body.alias("_text")).agg(first.alias("_row"))
    columns = [F.when(~F.col("_row._null"), F.col("_text")) if c == text_name else F.col(f"_row.{c}") for c in names]
    return kept.select(*(column.alias(c) for column, c in zip(columns, names))).toDF(*docs.columns)


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text))
