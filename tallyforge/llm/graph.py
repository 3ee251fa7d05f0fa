"""Connected components of links, with nothing on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.scratch import drop, store


def components(links: DataFrame, label: str = "components") -> tuple[DataFrame, str]:
    """(node, component) of every node of links (u, v), and the path of that stored table.

    component is the smallest node reachable.  Large-star and small-star steps take turns
    until every node has one link, to a root: in a large star the larger neighbours of a
    node move to its smallest one, in a small star a node and its smaller neighbours do.
    Rounds grow with the logarithm of the longest path, not with the size of a component;
    smallest neighbours are aggregated map-side, and a node with many links is only a
    skewed join, which adaptive execution splits.  Every round is stored, so lost
    executors cost at most one.  Links may repeat, and may join a node to itself; those
    with a null end are left out.
    """
    spark = links.sparkSession
    loops = links.dropna().select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    nodes, nodes_path = store(loops.distinct(), f"{label}-links")
    stars, path = nodes.filter("u <> v"), None
    while not _settled(stars):
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v")
        smaller = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smaller.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).select(
            F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")
        )
        next_stars, next_path = store(small.filter("u <> v").distinct(), f"{label}-stars")
        if path:
            drop(spark, path)
        stars, path = next_stars, next_path
    alone = nodes.filter("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    moved = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    result, result_path = store(alone.union(roots).union(moved).groupBy("node").agg(F.min("component").alias("component")), label)
    drop(spark, nodes_path, *([path] if path else []))
    return result, result_path


def _settled(stars: DataFrame) -> bool:
    """Whether every node that has a link (u, v) has one alone, and none leads to it."""
    out, into = (F.struct(F.col(c).alias("node"), F.lit(n).alias("out")) for c, n in (("u", 1), ("v", 0)))
    ends = stars.select(F.explode(F.array(out, into)).alias("e"))
    degrees = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.count("*").alias("n"))
    return degrees.filter("out > 1 OR (out = 1 AND n > 1)").isEmpty()
