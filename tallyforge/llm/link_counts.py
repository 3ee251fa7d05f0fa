"""Exact links of sets in the Jaccard metric: recursive Voronoi regions with windows, counted row by row."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.local_union import Union
from tallyforge.llm.metric_join import LIMIT, LIMIT_BYTES, PIVOTS, SLACK, Space, _batches
from tallyforge.llm.scratch import drop, store

ROWS = "group long, id long, payload binary, weight long, away long, inner boolean"
FOUND = "id long, root long, n long"
LEVELS = 60  # bits of `away`; regions shrink by a quarter a level, so 60 levels are 10^7 times the limit


def link_counts(rows: DataFrame, num: int, den: int, limit: int = LIMIT, label: str = "links") -> tuple[DataFrame, list[str]]:
    """(id, root, n): rows of one id add up to the weight of all it links to; (id, root) connect its class.

    rows: group long, id long, payload binary (sorted 64-bit elements), weight long.  Two rows of
    a group link when den * common >= num * union, that is at a distance of at most tau.

    A group of up to `limit` rows and LIMIT_BYTES is compared in one task.  A larger one is
    parted: of some PIVOTS rows by hash those stay pivots that are more than 4 tau apart.  A row's
    home is the region of its nearest pivot, or the rest if that is farther than 1 - 2 tau.  Two
    rows that link differ by tau in every distance, so a row also visits each region before its own
    whose pivot is at most 2 tau farther than its nearest, and a row of the rest the regions whose
    pivot is within 1 - tau.  Every pair meets exactly once where not both are visitors; bit k of
    `away` marks a visitor of level k, and pairs with a common bit are passed over.  Regions that
    are still too large are parted again.

    A region with more than three quarters of its parent's rows is a ball that windows cannot
    part.  Rows within tau / 2 of its pivot all link to each other and are counted by sums; only the
    others meet the region's rows, in blocks of `limit`.  That is the one place where rows meet
    without a window before the shuffle: pairs of a ball, less those that are sure.

    Regions are named by a 64-bit hash of their path.  Rows that repeat an id in a group are one.
    """
    spark = rows.sparkSession
    todo = rows.select("group", "id", "payload", "weight", F.lit(0).cast("long").alias("away"), F.lit(False).alias("inner"))
    todo, done, paths = todo.withColumn("of", F.lit(1 << 60)), [], []
    for level in range(LEVELS + 1):
        sizes = todo.groupBy("group").agg(
            F.count("*").alias("size"), F.sum(F.octet_length("payload")).alias("bytes"), F.max("of").alias("_of")
        )
        blocks = F.greatest(F.ceil(F.col("size") / limit), F.ceil(F.col("bytes") / LIMIT_BYTES)).cast("int")
        stuck = F.lit(level == LEVELS) | (4 * F.col("size") > 3 * F.col("_of"))
        large, large_path = store(
            sizes.select("group", "size", blocks.alias("blocks"), stuck.alias("stuck")).filter("blocks > 1 AND size > 2"), f"{label}-large"
        )
        paths.append(large_path)
        if large.isEmpty():
            done.append(_compared(todo, num, den))
            break
        done.append(_compared(todo.join(large, "group", "left_anti"), num, den))
        many = todo.join(large, "group")
        if level == 0:
            many = many.dropDuplicates(["group", "id"])
        balls = large.filter("stuck")
        if not balls.isEmpty():
            done += _balls(todo.join(balls.select("group"), "group", "left_semi"), num, den, limit)
        parted, path = store(_parted(many.filter("NOT stuck").drop("of", "stuck"), num, den, level), f"{label}-regions")
        paths.append(path)
        todo = parted
    found, path = store(reduce(DataFrame.union, done), label)
    drop(spark, *paths)
    return found, [path]


def _parted(many: DataFrame, num: int, den: int, level: int) -> DataFrame:
    """The rows of large groups in the regions that they live in or visit; `of` is the size of their group."""
    many = many.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    chance = F.pmod(F.xxhash64("id", "group", F.lit("pivot")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    pivots = many.filter(chance * F.col("size") < PIVOTS).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = many.withColumn("home", F.lit(1)).unionByName(pivots.withColumn("home", F.lit(0)))
    both = both.select("group", "block", "home", "id", "payload", "weight", "away", "size")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group, _), held in _batches(batches, 2):
            home = np.array(held["home"]) == 1
            space = Space("sets", held["payload"], num, den)
            at, pivots = np.flatnonzero(home), _apart(space, np.flatnonzero(~home))
            region, row, visitor, inner = _regions(space, at, pivots)
            away = np.array(held["away"], np.int64)[at[row]]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(row), group), pa.int64()),
                    pa.array(region, pa.int32()),
                    pa.array(np.array(held["id"])[at[row]], pa.int64()),
                    pa.array([held["payload"][i] for i in at[row]], pa.binary()),
                    pa.array(np.array(held["weight"])[at[row]], pa.int64()),
                    pa.array(away | (visitor.astype(np.int64) << level), pa.int64()),
                    pa.array(inner & (away == 0), pa.bool_()),
                    pa.array(np.array(held["size"])[at[row]], pa.int64()),
                ],
                ["group", "region", "id", "payload", "weight", "away", "inner", "of"],
            )

    measured = both.repartition("group", "block").sortWithinPartitions("group", "block", "home", "id").mapInArrow(
        measure, "group long, region int, id long, payload binary, weight long, away long, inner boolean, of long"
    )
    return measured.select(F.xxhash64("group", "region").alias("group"), "id", "payload", "weight", "away", "inner", "of")


def _apart(space: Space, pivots: np.ndarray) -> np.ndarray:
    """Those of the pivots that are more than 4 tau from every one kept before."""
    kept: list[int] = []
    for p in pivots:
        if not kept or (space.near(int(p), np.array(kept))[0] > 4 * space.tau + SLACK).all():
            kept.append(int(p))
    return np.array(kept, dtype=np.int64)


def _regions(space: Space, at: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, ...]:
    """(region, position in at, whether a visitor, whether within tau / 2 of the pivot) of all copies."""
    n, k, tau = len(at), len(pivots), space.tau
    away = np.full((n, k + 1), 1 - 2 * tau)  # the last column stands for the rest
    for i, p in enumerate(pivots):
        away[:, i] = space.near(int(p), at)[0]
    home = away.argmin(axis=1)
    nearest = away[np.arange(n), home]
    reach = np.where(home == k, 1 - tau, nearest + 2 * tau) + SLACK
    visits = (away[:, :k] <= reach[:, None]) & (np.arange(k) < home[:, None])
    row, region = np.nonzero(visits)
    inner = (home < k) & (nearest <= tau / 2 - SLACK)
    return (
        np.append(home, region),
        np.append(np.arange(n), row),
        np.append(np.zeros(n, bool), np.ones(len(row), bool)),
        np.append(inner, np.zeros(len(row), bool)),
    )


def _compared(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Groups that fit a task."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _batches(batches, 1):
            first = np.unique(np.array(held["id"]), return_index=True)[1]
            if len(first) > 1:
                yield _counted({c: [held[c][i] for i in first] for c in ("id", "payload", "weight", "away")}, None, num, den)

    rows = rows.select("group", "id", "payload", "weight", "away")
    return rows.repartition("group").sortWithinPartitions("group", "id").mapInArrow(compare, FOUND)


def _balls(rows: DataFrame, num: int, den: int, limit: int) -> list[DataFrame]:
    """Groups that no window parts: sums of the inner rows, blocks of the others against all."""
    by_group = rows.groupBy("group").agg(
        *(
            F.greatest(
                F.ceil(F.sum(F.when(side, 1).otherwise(0)) / limit),
                F.ceil(F.sum(F.when(side, F.octet_length("payload")).otherwise(0)) / LIMIT_BYTES),
            ).cast("int").alias(name)
            for side, name in ((F.col("inner"), "ins"), (~F.col("inner"), "outs"))
        ),
        F.sum(F.when(F.col("inner"), F.col("weight"))).alias("sum"),
        F.min(F.when(F.col("inner"), F.col("id"))).alias("least"),
    )
    rows = rows.join(by_group, "group")
    sure = rows.filter("inner").select("id", F.col("least").alias("root"), (F.col("sum") - F.col("weight")).alias("n"))

    part = F.when(F.col("inner"), F.pmod(F.xxhash64("id"), F.col("ins"))).otherwise(F.col("ins") + F.pmod(F.xxhash64("id"), F.col("outs")))
    placed = rows.withColumn("block", part.cast("int"))
    last = F.col("ins") + F.col("outs") - 1
    others = F.sequence(F.when(F.col("inner"), F.col("ins")).otherwise(F.lit(0)), last)
    meet = placed.filter("outs > 0").withColumn("other", F.explode(others))
    meet = meet.select(
        "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") < F.col("other")).alias("first"), "id", "payload", "weight", "away",
    )

    def confront(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), held in _batches(batches, 3):
            yield _counted(held, None if low == high else np.array(held["first"]), num, den)

    met = meet.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "id").mapInArrow(confront, FOUND)
    return [sure, met]


def _counted(held: dict[str, list], side: np.ndarray | None, num: int, den: int) -> pa.RecordBatch:
    """Links among the rows, or between the two sides, of pairs that are not both visitors of a level.

    The distances to a few rows decide most pairs: their differences from below, their sums
    from above; what is left is compared.
    """
    ids, weight, away = (np.array(held[c], dtype=np.int64) for c in ("id", "weight", "away"))
    space, n = Space("sets", held["payload"], num, den), len(ids)
    covered, table = np.zeros(n, bool), []
    while len(table) < PIVOTS and not covered.all():
        p = int(np.argmin(covered))
        distance, linked = space.near(p, space.all)
        linked[p] = True
        covered |= linked
        table.append(distance)
    table = np.array(table)
    union, total = Union(n), np.zeros(n, np.int64)
    for x in range(n - 1):
        rest = space.all[x + 1 :]
        rest = rest[(away[rest] & away[x]) == 0] if side is None else rest[(side[rest] != side[x]) & ((away[rest] & away[x]) == 0)]
        if not len(rest):
            continue
        rest = rest[(np.abs(table[:, rest] - table[:, x, None]) <= space.tau + SLACK).all(axis=0)]
        sure = ((table[:, rest] + table[:, x, None]) <= space.tau - SLACK).any(axis=0)
        open_ = rest[~sure]
        linked = np.append(rest[sure], open_[space.near(x, open_)[1]]) if len(open_) else rest
        total[x] += weight[linked].sum()
        total[linked] += weight[x]
        union.join(np.full(len(linked), x), linked)
    some = total > 0
    return pa.record_batch(
        [pa.array(ids[some], pa.int64()), pa.array(ids[union.roots()[some]], pa.int64()), pa.array(total[some], pa.int64())], ["id", "root", "n"]
    )
