"""Ranks inside groups of any size.

A plain window sorts each group in one task.  One group may hold a third of all
rows, so big groups are cut into ranges of their (uniform) hash order first and
the sizes of the earlier ranges are added to the rank within a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.functions.hashing import hex32

RANGE_ROWS = 1_000_000  # of a group that one task ranks


def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, _rows)``: rows per group, counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def cut_groups(sizes: DataFrame, keys: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(keys, _rows, _ranges)`` of the groups above ``range_rows``: a range for each ``range_rows`` of them.

    Any number of groups and ranges: both follow from the rows alone.
    """
    ranges = F.ceil(F.col("_rows") / F.lit(range_rows)).cast("bigint")
    return sizes.filter(F.col("_rows") > range_rows).withColumn("_ranges", ranges)


def hash_ranks(
    df: DataFrame,
    keys: list[str],
    digest: Column,
    ties: list[str],
    sizes: DataFrame | None = None,
    range_rows: int = RANGE_ROWS,
    repeated: bool = True,
) -> DataFrame:
    """Add ``rank`` (1-based, by ``digest`` then ``ties``) and ``group_rows`` per group.

    Equal rows share a digest and no range could part them, so they are counted
    first, ranked as one and written out again at the end; ``repeated=False`` says
    that there are none.  Reads ``df`` up to three times (group sizes unless given,
    sizes of the cut ranges, ranks): hand in a stored table rather than a long
    computation.  No side of a join is broadcast by order; Spark goes by its size.
    """
    columns = df.columns
    copies = F.count(F.lit(1)) if repeated else F.lit(1)
    rows = df.groupBy(*columns).agg(copies.alias("_copies")) if repeated else df.withColumn("_copies", copies)
    sizes = group_sizes(df, keys) if sizes is None else sizes
    hot = cut_groups(sizes, keys, range_rows)
    # the hash is uniform, so equal slices of its value range hold about equal numbers of different rows
    slice_no = F.shiftright(hex32(F.col("_digest")) * F.col("_ranges"), 32)

    hashed = rows.withColumn("_digest", digest)
    range_sizes = (
        rows.join(hot, keys)  # only the big groups' rows are hashed here
        .withColumn("_digest", digest)
        .groupBy(*keys, slice_no.alias("_range"))
        .agg(F.sum("_copies").alias("_n"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = range_sizes.select(*keys, "_range", F.sum("_n").over(earlier).alias("_offset"))

    cut = (
        hashed.join(hot, keys, "left")
        .withColumn("_range", F.coalesce(slice_no, F.lit(0)).cast("bigint"))
        .join(offsets, [*keys, "_range"], "left")
        # an input already placed by key would otherwise keep a big group in one task
        .repartition(*[F.col(k) for k in keys], F.col("_range"))
    )
    part = Window.partitionBy(*keys, "_range")
    before = F.coalesce(
        F.sum("_copies").over(part.orderBy("_digest", *ties).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    whole = F.coalesce(F.col("_rows"), F.sum("_copies").over(part)).cast("bigint")
    ranked = cut.select(
        *columns,
        "_copies",
        (before + F.coalesce(F.col("_offset"), F.lit(0)) + 1).cast("bigint").alias("rank"),
        whole.alias("group_rows"),
    )
    if not repeated:
        return ranked.drop("_copies")
    # copies are written out in steps, so that no array grows with their number
    step = F.lit(4096)
    outer = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(_copies - 1) div 4096")))
    stepped = ranked.withColumn("_step", outer)
    inner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col("_copies") - F.col("_step") * step, step) - 1))
    return stepped.withColumn("_copy", inner).select(
        *columns, (F.col("rank") + F.col("_step") * step + F.col("_copy")).alias("rank"), "group_rows"
    )
