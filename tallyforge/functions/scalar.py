"""Small scalar expressions: guarded casts, guarded division, encodings, labels."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def strict_int(text: Column, dtype: str = "int") -> Column:
    """Integer text with optional sign; anything else, outer blanks included, is NULL.

    The cast alone would let blanks pass, so both ends are looked at first.
    """
    ends = F.left(text, F.lit(1)).between("+", "9") & F.right(text, F.lit(1)).between("0", "9")
    return F.when(ends, text.try_cast(dtype))


def strict_double(text: Column) -> Column:
    """Decimal text; anything else is NULL."""
    return text.try_cast("double")


def trim_control(text: Column) -> Column:
    """Strip every character up to and including the blank from both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0.0 when the denominator is not positive."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def cyclical(col: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value that wraps after ``period``."""
    angle = col.cast("double") * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def unknown_label(name: Column, key: Column) -> Column:
    """The name, or ``Unknown(key)`` where there is none."""
    return F.coalesce(name, F.concat(F.lit("Unknown("), key.cast("string"), F.lit(")")))


def rank_line(rank: Column, name: Column, key: Column, score: Column) -> Column:
    """One printable line of a ranked report; for display only."""
    return F.format_string("%2d. %s (item=%d, score=%.4f)", rank, name, key, score)
