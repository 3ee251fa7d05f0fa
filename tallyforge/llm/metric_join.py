"""Similarity classes in a Jaccard space: pivots, Voronoi regions, triangle-inequality windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.local_union import Union
from tallyforge.llm.scratch import drop, store

LIMIT = 2000  # rows of a group that one task compares
LIMIT_BYTES = 1 << 24  # and bytes of their sets
PIVOTS = 16  # of a larger group
SLACK = 1e-6  # of windows, against rounding


class Sets:
    """Sets of 64-bit elements, as sorted arrays."""

    def __init__(self, payloads: list[bytes]):
        rows = [np.frombuffer(p, "<u8") for p in payloads]
        self.sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.codes = np.unique(np.concatenate(rows), return_inverse=True)[1] if rows else np.empty(0, int)
        self.marked = np.zeros(int(self.codes.max(initial=-1)) + 1, dtype=np.int32)

    def common(self, i: int, rows: np.ndarray) -> np.ndarray:
        """Elements that set i shares with each of the sets in rows (ascending)."""
        if not len(rows):
            return np.empty(0, np.int64)
        own = self.codes[self.ends[i] - self.sizes[i] : self.ends[i]]
        self.marked[own] = 1
        if len(rows) == len(self.sizes):
            hits = self.marked[self.codes]
            out = np.add.reduceat(hits, self.ends - self.sizes)
        else:
            hits = self.marked[np.concatenate([self.codes[self.ends[r] - self.sizes[r] : self.ends[r]] for r in rows])]
            out = np.add.reduceat(hits, np.cumsum(self.sizes[rows]) - self.sizes[rows])
        self.marked[own] = 0
        return out.astype(np.int64)


class Folded:
    """Sets folded into bins: counts of elements by hash.

    Counts of two sets overlap at least as much as the sets do, and one minus overlap by
    union of counts is again a metric (the Jaccard distance of multisets).  So what is
    close as sets is close here, and the same windows hold.
    """

    def __init__(self, payloads: list[bytes], kind: str):
        self.counts = np.frombuffer(b"".join(payloads), kind).reshape(len(payloads), -1)
        self.sizes = self.counts.sum(axis=1, dtype=np.int64)

    def common(self, i: int, rows: np.ndarray) -> np.ndarray:
        counts = self.counts if len(rows) == len(self.sizes) else self.counts[rows]
        return np.minimum(counts, self.counts[i]).sum(axis=1, dtype=np.int64)


def kernel(kind: str, payloads: list[bytes]):
    return Sets(payloads) if kind == "sets" else Folded(payloads, kind)


class Space:
    """Rows of a group with their distances; links need den * common >= num * union."""

    def __init__(self, kind: str, payloads: list[bytes], num: int, den: int):
        self.rows, self.num, self.den = kernel(kind, payloads), num, den
        self.tau = 1 - num / den
        self.all = np.arange(len(payloads))

    def near(self, i: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances from row i to rows, and which of them link."""
        common = self.rows.common(i, rows)
        union = self.rows.sizes[i] + self.rows.sizes[rows] - common
        return 1 - common / np.maximum(union, 1), self.den * common >= self.num * union

    def classes(self) -> np.ndarray:
        """The first row of every row's class of links.

        Pivots are taken until every row is one or links to one (its Voronoi region).
        Two rows of different classes can only link if their distances to every pivot
        differ by at most tau: those are compared, row by row.
        """
        n = len(self.all)
        union, covered, pivots, table = Union(n), np.zeros(n, bool), [], []
        while not covered.all():
            p = int(np.argmin(covered))
            distance, linked = self.near(p, self.all)
            linked[p] = True
            union.join(np.full(int(linked.sum()), p), np.flatnonzero(linked))
            covered |= linked
            pivots.append(p)
            table.append(distance.astype(np.float32))
        others = np.setdiff1d(self.all, pivots)
        if len(others) > 1 and len(np.unique(union.roots()[others])) > 1:
            table = np.array(table)
            for k, x in enumerate(others):
                root = union.roots()
                rest = others[k + 1 :][root[others[k + 1 :]] != root[x]]
                if len(rest):
                    rest = rest[(np.abs(table[:, rest] - table[:, x, None]) <= self.tau + SLACK).all(axis=0)]
                if len(rest):
                    linked = rest[self.near(int(x), rest)[1]]
                    union.join(np.full(len(linked), x), linked)
        return union.roots()


def links_within(
    rows: DataFrame, kind: str, num: int, den: int, limit: int = LIMIT, label: str = "links"
) -> tuple[DataFrame, list[str]]:
    """Links (u, v) that connect exactly the rows connected by links inside the groups, and stored paths.

    rows: group long, id long, payload binary; kind: "sets" or the number type of folded
    counts.  A group of up to `limit` rows and LIMIT_BYTES is one task's work
    (Space.classes).  A larger one is split: some PIVOTS rows by hash are pivots, every row learns its distances to
    them and links to those it reaches.  The rows linked to the pivot with most links, or
    to a pivot that links to that one, are one class already; the others, the boundary,
    meet all rows of the group in blocks of `limit`, boundary against home, and compare
    where the windows around all pivots allow a link.  Nothing is cut off: a group that
    holds a third of all rows is many blocks.  Rows of one id in a group are one row.
    """
    u_v = "u long, v long"

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(kind, num, den)
        for _, ids, payloads in _runs(batches, 1):
            if len(ids) == 2:
                yield from pairs.add(ids, payloads)
            elif len(ids) > 2:
                root = Space(kind, payloads, num, den).classes()
                moved = np.flatnonzero(root != np.arange(len(ids)))
                if len(moved):
                    yield _links(np.array(ids)[moved], np.array(ids)[root[moved]])
        yield from pairs.flush()

    sizes = rows.groupBy("group").agg(F.count("*").alias("size"), F.sum(F.octet_length("payload")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("size") / limit), F.ceil(F.col("bytes") / LIMIT_BYTES)).cast("int")
    sizes, sizes_path = store(sizes.select("group", "size", blocks.alias("blocks")).filter("blocks > 1 AND size > 2"), f"{label}-large")
    if sizes.isEmpty():
        drop(rows.sparkSession, sizes_path)
        found = rows.repartition("group").sortWithinPartitions("group", "id").mapInArrow(small, u_v)
        found, path = store(found.distinct(), label)
        return found, [path]
    few = rows.join(sizes, "group", "left_anti").repartition("group").sortWithinPartitions("group", "id").mapInArrow(small, u_v)

    many = rows.join(sizes, "group").dropDuplicates(["group", "id"])
    many = many.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    chance = F.pmod(F.xxhash64("id", F.lit("pivot")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    pivots = many.filter(chance * F.col("size") < PIVOTS).select("group", "id", "payload", "blocks")
    spread = pivots.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    marked = many.select("group", "block", F.lit(1).alias("home"), "id", "payload").union(
        spread.select("group", "block", F.lit(0).alias("home"), "id", "payload")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group, block), rows_of in _batches(batches, 2):
            yield from _measured(group, block, rows_of, kind, num, den)

    measured, measured_path = store(
        marked.repartition("group", "block").sortWithinPartitions("group", "block", "home", "id").mapInArrow(
            measure, "group long, block int, id long, payload binary, distances binary, linked array<long>"
        ),
        f"{label}-measured",
    )
    to_pivots = measured.select(F.col("id").alias("u"), F.explode("linked").alias("v"))
    reached = measured.select("group", "id", F.explode("linked").alias("pivot"))
    centre = reached.groupBy("group", "pivot").count().groupBy("group").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("centre"))
    sure = reached.join(centre, "group").filter(F.col("id") == F.col("centre")).select("group", "pivot").union(centre.select("group", F.col("centre").alias("pivot"))).distinct()
    core = reached.join(sure, ["group", "pivot"], "left_semi").select("group", "id").distinct()
    edge = measured.join(core, ["group", "id"], "left_anti").join(sizes, "group")
    meet = edge.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meet = meet.select("group", F.col("block").alias("from"), "to", F.lit(0).alias("home"), "id", "payload", "distances")
    wanted = meet.select("group", "from", "to").distinct()
    homes = measured.withColumnRenamed("block", "to").join(wanted, ["group", "to"])
    homes = homes.select("group", "from", "to", F.lit(1).alias("home"), "id", "payload", "distances")

    def confront(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows_of in _batches(batches, 3):
            yield from _confronted(rows_of, kind, num, den)

    across = (
        meet.union(homes)
        .repartition("group", "from", "to")
        .sortWithinPartitions("group", "from", "to", "home", "id")
        .mapInArrow(confront, u_v)
    )
    found, path = store(few.union(to_pivots).union(across).filter("u <> v").distinct(), label)
    drop(rows.sparkSession, measured_path, sizes_path)
    return found, [path]


def _measured(group, block, rows_of, kind, num, den) -> Iterator[pa.RecordBatch]:
    home = np.array(rows_of["home"]) == 1
    space = Space(kind, rows_of["payload"], num, den)
    ids, at, pivots = np.array(rows_of["id"]), np.flatnonzero(home), np.flatnonzero(~home)
    table, linked = np.zeros((len(at), len(pivots)), np.float32), np.zeros((len(at), len(pivots)), bool)
    for k, p in enumerate(pivots):
        table[:, k], linked[:, k] = space.near(int(p), at)
    n = len(at)
    yield pa.record_batch(
        [
            pa.array([group] * n, pa.int64()),
            pa.array([block] * n, pa.int32()),
            pa.array(ids[at], pa.int64()),
            pa.array([rows_of["payload"][i] for i in at], pa.binary()),
            pa.array([t.tobytes() for t in table], pa.binary()),
            pa.array([ids[pivots[row]].tolist() for row in linked], pa.list_(pa.int64())),
        ],
        ["group", "block", "id", "payload", "distances", "linked"],
    )


def _confronted(rows_of, kind, num, den) -> Iterator[pa.RecordBatch]:
    home = np.array(rows_of["home"]) == 1
    space, ids = Space(kind, rows_of["payload"], num, den), np.array(rows_of["id"])
    table = np.array([np.frombuffer(d, np.float32) for d in rows_of["distances"]])
    at, union = np.flatnonzero(home), Union(len(ids))
    for x in np.flatnonzero(~home):
        root = union.roots()
        rest = at[(root[at] != root[x]) & (ids[at] != ids[x])]
        rest = rest[(np.abs(table[rest] - table[x]) <= space.tau + SLACK).all(axis=1)]
        if len(rest):
            linked = rest[space.near(int(x), rest)[1]]
            union.join(np.full(len(linked), x), linked)
    root = union.roots()
    moved = np.flatnonzero(ids != ids[root])
    yield _links(ids[moved], ids[root[moved]])


class _Pairs:
    """Groups of two rows, gathered and compared many at once."""

    def __init__(self, kind: str, num: int, den: int):
        self.kind, self.num, self.den = kind, num, den
        self.ids: list[int] = []
        self.payloads: list[bytes] = []
        self.bytes = 0

    def add(self, ids, payloads) -> Iterator[pa.RecordBatch]:
        self.ids += ids
        self.payloads += payloads
        self.bytes += sum(map(len, payloads))
        if self.bytes > 1 << 24:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.ids:
            ids = np.array(self.ids).reshape(-1, 2)
            if self.kind == "sets":
                sets = [np.frombuffer(p, "<u8") for p in self.payloads]
                common = np.array([len(np.intersect1d(a, b, True)) for a, b in zip(sets[::2], sets[1::2])])
                sizes = np.array([len(s) for s in sets]).reshape(-1, 2)
            else:
                counts = np.frombuffer(b"".join(self.payloads), self.kind).reshape(len(ids), 2, -1)
                common = np.minimum(counts[:, 0], counts[:, 1]).sum(axis=1, dtype=np.int64)
                sizes = counts.sum(axis=2, dtype=np.int64)
            linked = self.den * common >= self.num * (sizes.sum(axis=1) - common)
            yield _links(ids[linked, 0], ids[linked, 1])
        self.ids, self.payloads, self.bytes = [], [], 0


def _links(u, v) -> pa.RecordBatch:
    return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _batches(batches, keys: int) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of equal leading key columns, gathered from sorted batches."""
    at, held = None, None
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        names = list(columns)
        key_of = list(zip(*(columns[c] for c in names[:keys])))
        start = 0
        for i in range(1, len(key_of) + 1):
            if i < len(key_of) and key_of[i] == key_of[start]:
                continue
            if key_of[start] != at:
                if held is not None:
                    yield at, held
                at, held = key_of[start], {c: [] for c in names}
            for c in names:
                held[c] += columns[c][start:i]
            start = i
    if held is not None:
        yield at, held


def _runs(batches, keys: int) -> Iterator[tuple[tuple, list[int], list[bytes]]]:
    """(key, ids, payloads) of each group; rows that repeat an id are left out."""
    for key, held in _batches(batches, keys):
        ids, payloads = held["id"], held["payload"]
        if len(set(ids)) < len(ids):
            first = {x: p for x, p in zip(reversed(ids), reversed(payloads))}
            ids, payloads = list(first), list(first.values())
        yield key, ids, payloads
