"""Every smaller depth of a fitted decision tree, read off the one deep tree.

A tree fitted to depth d is the deeper tree of the same rows, impurity and bins cut at
depth d: which splits a node gets does not depend on how deep the tree may grow, and a
single tree draws no features.  Spark merges sibling leaves that predict the same class,
so the cut tree is merged again in the same way.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.operators.metrics import binary_auc_by
from tallyforge.session import intermediate_path


def node_table(model: DecisionTreeClassificationModel) -> DataFrame:
    """The nodes of a model, in preorder from 0: ``id, leftChild, rightChild, prediction, impurityStats``."""
    spark = SparkSession.active()
    path = intermediate_path(spark, "tree")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("id", "leftChild", "rightChild", "prediction", "impurityStats")


def leaf_owners(left: np.ndarray, right: np.ndarray, prediction: np.ndarray, depths: list[int]) -> dict[int, np.ndarray]:
    """For every depth, the node that a leaf's rows end in when the tree is cut there; leaves in preorder.

    The arrays hold the whole tree, which the driver has as the model already.
    """
    n = len(left)
    parent, level = np.full(n, -1), np.zeros(n, dtype=int)
    for v in range(n):  # parents come before their children
        for child in (left[v], right[v]):
            if child >= 0:
                parent[child], level[child] = v, level[v] + 1
    leaves = np.flatnonzero(left < 0)
    owners = {}
    for depth in depths:
        ends = (left < 0) | (level >= depth)
        for v in range(n - 1, -1, -1):
            if not ends[v]:
                a, b = left[v], right[v]
                ends[v] = ends[a] and ends[b] and prediction[a] == prediction[b]
        owner = np.full(n, -1)
        for v in range(n):
            above = owner[parent[v]] if v else -1
            owner[v] = above if above >= 0 else v if ends[v] else -1
        owners[depth] = owner[leaves]
    return owners


def depth_tallies(model: DecisionTreeClassificationModel, rows: DataFrame, depths: list[int], label: str = "label") -> DataFrame:
    """``(depth, prediction, stats, label, n)``: what the tree cut at each depth says of the rows.

    ``stats`` are the class weights of the end node.  The rows are read once and counted by
    leaf and label; all that follows has a row for each leaf and depth at most.
    """
    spark = rows.sparkSession
    nodes = node_table(model)
    tree = nodes.select("id", "leftChild", "rightChild", "prediction").orderBy("id").toPandas()
    columns = (tree[c].to_numpy() for c in ("leftChild", "rightChild", "prediction"))
    ends = [
        (leaf, depth, int(node))
        for depth, owners in leaf_owners(*columns, depths).items()
        for leaf, node in enumerate(owners)
    ]
    ends = spark.createDataFrame(ends, "leaf int, depth int, node int").join(
        nodes.select(F.col("id").alias("node"), "prediction", F.col("impurityStats").alias("stats")), "node"
    )
    by_leaf = model.copy().setLeafCol("_leaf").transform(rows).groupBy(F.col("_leaf").cast("int").alias("leaf"), F.col(label).alias("label"))
    counts = by_leaf.agg(F.count(F.lit(1)).alias("n"))
    return counts.join(ends, "leaf").groupBy("depth", "node", "prediction", "stats", "label").agg(F.sum("n").alias("n")).drop("node")


def tree_score(select_by: str) -> Column:
    """The score of class 1 in ``stats``: its weight in the leaf (``rawPrediction``) or its share (``probability``)."""
    weight = F.col("stats")[1]
    return weight if select_by == "rawPrediction" else weight / F.aggregate("stats", F.lit(0.0), lambda t, x: t + x)


class DepthAuc:
    """Judge of a search: one fit for all depths of a grid, ROC AUC over the exact scores."""

    larger_is_better = True

    def __init__(self, select_by: str = "rawPrediction"):
        self.select_by = select_by

    def families(self, points: list[dict]) -> list[list[int]]:
        """Numbers of the points that share a tree, the deepest first."""
        groups: dict[tuple, list[int]] = {}
        for i, point in enumerate(points):
            groups.setdefault(tuple(sorted((k, v) for k, v in point.items() if k != "maxDepth")), []).append(i)
        return [sorted(g, key=lambda i: -points[i]["maxDepth"]) for g in groups.values()]

    def metrics(self, model: DecisionTreeClassificationModel, rows: DataFrame, points: list[dict]) -> list[float]:
        depths = sorted({p["maxDepth"] for p in points})
        scored = depth_tallies(model, rows, depths).withColumn("score", tree_score(self.select_by))
        areas = {r["depth"]: r["roc_auc"] for r in binary_auc_by(scored, ["depth"], weight="n").collect()}  # one row a depth
        return [float(areas[p["maxDepth"]]) for p in points]

    def __repr__(self) -> str:
        return f"DepthAuc({self.select_by})"
