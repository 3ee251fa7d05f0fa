"""Hard-negative mining: exact top lists by bounds along a spanning tree of anchors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.scratch import drop, reach_package, store

ANCHORS = 256  # of a block; they share a spanning tree
ROWS = 4096  # of a block of candidates
WIDE = 0.25  # of a block's candidates in the window: above it all are scored at once

BLOCK = "size int, block long, low long, high long, row array<long>, id binary, label binary, v binary"


def mine(
    vectors: DataFrame,
    anchors,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchors is a condition on the columns of vectors.  Components become floor(scale * x);
    a score is the inner product of those, higher first, ties by smaller key.  The positives
    of an anchor are its first n_positives other rows of the same label; for each of them the
    first n_negatives rows of other labels with low * positive <= 100 * negative <= high *
    positive are returned, rank from 1.  Fewer if there are fewer.

    Anchors in blocks of ANCHORS meet all rows in blocks of ROWS.  The anchors of a block
    are joined by a minimum spanning tree of their distances.  Against a block of rows the
    root is scored; a child's score of a row lies within the edge's length times the row's
    norm of its parent's score (or of the bounds that the parent itself has), and only rows
    whose bounds overlap what the child still looks for are scored, exactly.  Positives are
    sought where blocks share labels; their scores then give the windows of the second
    pass.  Lists of blocks are merged by ranks per anchor, cut to their length before the
    shuffle.  No block and no list grows with the input; the pairs of blocks do, as anchors
    times rows.

    Rows with a null key, label or vector, or a null or non-finite component take no part.
    Only rows of equal length have a score; empty vectors score 0.  Rows that repeat a key
    are rows of their own, each an anchor if the key is one; ties that are left go by the row's
    place.  Scores are exact below 2^53.  Other columns are not read.  An empty table gives an
    empty one.
    """
    spark = vectors.sparkSession
    reach_package(spark)
    source = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"), anchors.alias("anchor")
    ).filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    checked = source.mapInArrow(partial(_scaled, scale=scale), "id long, label long, size int, anchor boolean, v binary")
    checked, checked_path = store(checked.withColumn("row", F.monotonically_increasing_id()), "scaled")

    def blocks(rows: DataFrame, name: str, most: int) -> tuple[DataFrame, str]:
        # ranges of label and place: a label that holds a third of all rows is many blocks
        ranged = rows.select("row", "id", "label", "size", "v").repartitionByRange("size", "label", "row").sortWithinPartitions("size", "label", "row")
        return store(ranged.mapInArrow(partial(_cut, most=most), BLOCK), name)

    asked, asked_path = blocks(checked.filter("anchor"), "anchor-blocks", ANCHORS)
    others, others_path = blocks(checked, "row-blocks", ROWS)

    near = _pairs(asked, others, (F.col("low") <= F.col("high_b")) & (F.col("low_b") <= F.col("high")))
    listed = _met(asked, others, near).mapInArrow(
        partial(_positives, most=n_positives), "anchor long, anchor_id long, id long, row long, score double"
    )
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    listed = listed.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n_positives)
    positives, positives_path = store(listed.select("anchor", "anchor_id", "place", F.col("id").alias("positive_id"), "score"), "positives")

    wanted = positives.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("scores")
    )  # n_positives numbers a row
    apart = _pairs(asked, others, ~((F.col("low") == F.col("high")) & (F.col("low_b") == F.col("high_b")) & (F.col("low") == F.col("low_b"))))
    placed = asked.select("size", "block", F.posexplode("row").alias("at", "anchor"))
    windows = placed.join(wanted, "anchor").groupBy("size", "block").agg(F.collect_list(F.struct("at", "scores")).alias("windows"))
    found = _met(asked, others, apart, windows).mapInArrow(
        partial(_negatives, most=n_negatives, low=low, high=high), "anchor long, place int, id long, row long, score double"
    )
    hardest = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id", "row")
    found = found.withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= n_negatives)
    found = found.select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").cast("long").alias("negative_score"))
    result = found.join(positives, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").cast("long").alias("positive_score"), "negative_score"
    )
    result, _ = store(result, "hard-negatives")
    drop(spark, checked_path, asked_path, others_path, positives_path)
    return result


def _pairs(asked: DataFrame, others: DataFrame, where) -> DataFrame:
    """(size, a, b): blocks that meet.  A row for each pair of blocks, without what they hold."""
    left = asked.select("size", F.col("block").alias("a"), "low", "high")
    right = others.select("size", F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    return left.join(right, "size").filter(where).select("size", "a", "b")


def _met(asked: DataFrame, others: DataFrame, pairs: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """A row for each pair with what both blocks hold; the anchors' windows beside them."""
    left = asked.select(F.col("block").alias("a"), *(F.col(c).alias(f"{c}_a") for c in ("row", "id", "label", "v")))
    if windows is not None:
        left = left.join(windows.select(F.col("block").alias("a"), "windows"), "a")
    right = others.select(F.col("block").alias("b"), "row", "id", "label", "v")
    return pairs.join(left, "a").join(right, "b")


def _scaled(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, sizes, packed = [], [], []
        for i, v in enumerate(batch.column(2).to_pylist()):
            if any(x is None for x in v):
                continue
            x = np.floor(scale * np.array(v, np.float64))
            if np.isfinite(x).all():
                keep.append(i)
                sizes.append(len(x))
                packed.append((x + 0.0).astype("<f8").tobytes())
        kept = batch.take(pa.array(keep, pa.int64()))
        columns = [kept.column(0), kept.column(1), pa.array(sizes, pa.int32()), kept.column(3), pa.array(packed, pa.binary())]
        yield pa.record_batch(columns, ["id", "label", "size", "anchor", "v"])


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Up to `most` consecutive rows of one size as one row; low and high are its labels' bounds."""
    from pyspark import TaskContext

    number, held = TaskContext.get().partitionId() << 33, []

    def packed() -> pa.RecordBatch:
        numbers = {c: np.array([r[c] for r in held], "<i8") for c in ("row", "id", "label")}
        values = [held[0]["size"], number, int(numbers["label"].min()), int(numbers["label"].max())]
        values += [numbers["row"], numbers["id"].tobytes(), numbers["label"].tobytes(), b"".join(r["v"] for r in held)]
        kinds = [pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64()), *[pa.binary()] * 3]
        names = ["size", "block", "low", "high", "row", "id", "label", "v"]
        return pa.record_batch([pa.array([x], k) for x, k in zip(values, kinds)], names)

    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["size"] != held[0]["size"] or len(held) == most):
                yield packed()
                number, held = number + 1, []
            held.append(row)
    if held:
        yield packed()


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's tree of all points by distance: (order, parent of each, length of the edge to it); the first is the root."""
    n = len(points)
    order, parent, length = [0], np.zeros(n, np.int64), np.zeros(n)
    reach, via = np.linalg.norm(points - points[0], axis=1), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    open_[0] = False
    while open_.any():
        i = int(np.flatnonzero(open_)[np.argmin(reach[open_])])
        order.append(i)
        open_[i], parent[i], length[i] = False, via[i], reach[i]
        away = np.linalg.norm(points - points[i], axis=1)
        closer = open_ & (away < reach)
        reach[closer], via[closer] = away[closer], i
    return np.array(order), parent, length


class TreeScores:
    """Scores of anchors against rows, as few as the bounds along the tree allow.

    `visit` takes a function from bounds (low, high) of all rows to the rows that are still
    wanted, and gives their exact scores.  What was not scored keeps its bounds, which
    widen by edge times norm at each step down.
    """

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        self.anchors, self.rows = anchors, rows
        self.norms = np.linalg.norm(rows, axis=1)
        self.order, self.parent, self.length = spanning_tree(anchors)
        self.children = np.bincount(self.parent[self.order[1:]], minlength=len(anchors))
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0  # products computed

    def visit(self, i: int, want) -> tuple[np.ndarray, np.ndarray]:
        """Rows that anchor i wants, and their scores; anchors come in `order`."""
        anchor = self.anchors[i]
        if i == self.order[0]:
            low = high = self.rows @ anchor
            wanted = want(low, high)
            self.scored += len(self.rows)
            exact = low[wanted]
        else:
            up_low, up_high = self.bounds[self.parent[i]]
            # rounding: products of integers are exact, lengths and norms are not
            reach = self.norms * (self.length[i] * (1 + 1e-12)) + 1e-6
            low, high = up_low - reach, up_high + reach
            wanted = want(low, high)
            if len(wanted) > WIDE * len(self.rows):
                low = high = self.rows @ anchor
                self.scored += len(self.rows)
                exact = low[wanted]
            else:
                exact = self.rows[wanted] @ anchor
                self.scored += len(wanted)
                low[wanted] = high[wanted] = exact
        if self.children[i]:
            self.bounds[i] = (low, high)
        if i != self.order[0]:
            p = self.parent[i]
            self.children[p] -= 1
            if not self.children[p]:
                del self.bounds[p]
        return wanted, exact


def _unpacked(pair: dict) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    numbers = {c: np.frombuffer(pair[c], "<i8") for c in ("id_a", "label_a", "id", "label")}
    numbers |= {c: np.array(pair[c], "<i8") for c in ("row_a", "row")}
    vectors = (np.frombuffer(pair[c], "<f8").reshape(-1, pair["size"]) if pair["size"] else np.zeros((len(numbers[n]), 0)) for c, n in (("v_a", "row_a"), ("v", "row")))
    return numbers, *vectors


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most`: higher scores, then smaller ids and rows."""
    if len(scores) > 4 * most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((rows[at], ids[at], -scores[at]))[:most]]


def _record(columns: dict[str, list[np.ndarray]], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    joined = [pa.array(np.concatenate(columns[c]) if columns[c] else [], k) for c, k in kinds.items()]
    return pa.record_batch(joined, list(kinds))


def _positives(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    kinds = {"anchor": pa.int64(), "anchor_id": pa.int64(), "id": pa.int64(), "row": pa.int64(), "score": pa.float64()}
    for pair in _each(batches):
        n, anchors, rows = _unpacked(pair)
        tree, out = TreeScores(anchors, rows), {c: [] for c in kinds}
        for i in tree.order:
            same = np.flatnonzero((n["label"] == n["label_a"][i]) & (n["row"] != n["row_a"][i]))

            def want(low, high, same=same):
                if len(same) <= most:
                    return same
                # the most-th best lower bound: what cannot reach it is not among the first
                least = np.partition(low[same], len(same) - most)[len(same) - most]
                return same[high[same] >= least]

            wanted, scores = tree.visit(int(i), want)
            best = _first(scores, n["id"][wanted], n["row"][wanted], most)
            at = wanted[best]
            for c, x in (("anchor", n["row_a"][i]), ("anchor_id", n["id_a"][i])):
                out[c].append(np.full(len(at), x))
            for c, x in (("id", n["id"][at]), ("row", n["row"][at]), ("score", scores[best])):
                out[c].append(x)
        yield _record(out, kinds)


def _negatives(batches: Iterator[pa.RecordBatch], most: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    kinds = {"anchor": pa.int64(), "place": pa.int32(), "id": pa.int64(), "row": pa.int64(), "score": pa.float64()}
    for pair in _each(batches):
        n, anchors, rows = _unpacked(pair)
        windows = {w["at"]: np.array(w["scores"]) for w in pair["windows"]}
        tree, out = TreeScores(anchors, rows), {c: [] for c in kinds}
        for i in tree.order:
            positives = windows.get(int(i), np.empty(0))
            open_ = positives[low * positives <= high * positives]  # a negative positive score has no window
            other = np.flatnonzero(n["label"] != n["label_a"][i])

            def want(below, above, other=other, open_=open_):
                if not len(open_):
                    return other[:0]
                inside = (100 * above[other] >= low * open_.min()) & (100 * below[other] <= high * open_.max())
                return other[inside]

            wanted, scores = tree.visit(int(i), want)
            for place, p in enumerate(positives, 1):
                within = np.flatnonzero((low * p <= 100 * scores) & (100 * scores <= high * p))
                at = within[_first(scores[within], n["id"][wanted[within]], n["row"][wanted[within]], most)]
                out["anchor"].append(np.full(len(at), n["row_a"][i]))
                out["place"].append(np.full(len(at), place))
                out["id"].append(n["id"][wanted[at]])
                out["row"].append(n["row"][wanted[at]])
                out["score"].append(scores[at])
        yield _record(out, kinds)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


ORACLE = """
    WITH taken AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
        FROM taken a JOIN taken b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT anchor_id, id, score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    QUALIFY rank <= 10
"""
