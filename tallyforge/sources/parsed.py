"""Result of a line parser: the good rows and the refused lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Parsed(NamedTuple):
    good: DataFrame
    rejects: DataFrame  # (value, reason)


def split_by_reason(
    lines: DataFrame, reason: Column, fields: dict[str, Column], on_error: str, helpers: tuple[str, ...] = ()
) -> Parsed:
    """Divide lines by a reason column that is NULL for good lines.

    ``on_error='drop'`` keeps refused lines apart; ``'fail'`` ends the job at
    the first one.  ``helpers`` are columns that only reason and fields need.
    All is computed once per line: a filter on the reason stays above the
    generator and is not pushed below, where it would repeat the parsing.
    """
    if on_error not in ("drop", "fail"):
        raise ValueError("on_error is 'drop' or 'fail'")
    carried = [c for c in lines.columns if c != "value" and c not in helpers]
    row = F.struct("value", reason.alias("_reason"), *carried, *[e.alias(n) for n, e in fields.items()])
    checked = lines.select(F.inline(F.array(row)))
    rejects = checked.filter("_reason IS NOT NULL").select("value", F.col("_reason").alias("reason"))
    accepted = F.col("_reason").isNull()
    if on_error == "fail":
        complaint = F.concat(F.lit("refused line ("), F.col("_reason"), F.lit("): "), F.col("value"))
        accepted = F.when(accepted, F.lit(True)).otherwise(
            F.raise_error(complaint).cast("boolean")
        )
    good = checked.filter(accepted).select(*carried, *fields)
    return Parsed(good, rejects)
