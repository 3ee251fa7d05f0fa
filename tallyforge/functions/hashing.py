"""Salted, layout-independent hash expressions.

Every split, fold, noise term and random order draws from its own salt, so that
two of them over the same key are independent.  md5 is used because any SQL
engine can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def salted_md5(purpose: str, seed: int, *keys: str | Column) -> Column:
    """Hex md5 of ``purpose|seed|key|key...``; a NULL key counts as empty text."""
    parts = [F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), *parts))


def hash32(purpose: str, seed: int, *keys: str | Column) -> Column:
    """The first 32 bits of the salted md5 as a non-negative bigint."""
    return hex32(salted_md5(purpose, seed, *keys))


def hex32(digest: Column) -> Column:
    """The first eight hex digits of a digest as a bigint."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def bucket(purpose: str, seed: int, n: int, *keys: str | Column) -> Column:
    """Integer in ``[0, n)``."""
    return F.pmod(hash32(purpose, seed, *keys), F.lit(n)).cast("int")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
