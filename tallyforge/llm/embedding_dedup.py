"""Embedding near-dedup: exact cosine links by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.graph import components
from tallyforge.llm.local_union import Union
from tallyforge.llm.scratch import drop, store
from tallyforge.llm.vector_sums import vector_sums

TILE = 2048  # vectors of a tile
STEPS = (8, 16, 32)  # leading dimensions after which a pair may be given up
ROWS = 256  # vectors compared with a tile at once
SLACK = 1e-6  # of bounds, against rounding; the last word is always the cosine in double precision


def near_duplicates(
    vectors: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", label: str = "label", tile: int = TILE
) -> DataFrame:
    """One row per row of vectors: key, n_links, component_id, kept.

    Rows link when their labels are equal and the cosine, in double precision, is at least
    threshold; n_links counts the rows linked to a row, component_id is the smallest key
    reachable by links and kept marks the row that bears it.

    Equal vectors of a label are one vector with a count.  The vectors are turned into the
    basis of the eigenvectors of their second moments (the rotation keeps cosines), sorted
    by label and first coordinate and cut into tiles, wherever a label is large.  Two tiles
    meet unless their first coordinates are further apart than the threshold allows.  A
    pair of tiles adds up products of leading dimensions and gives a pair up once the
    partial product and the product of the norms of what is left cannot reach the
    threshold; what survives gets its cosine from the vectors as they came.  A pair of
    tiles returns the number of links of each vector and a spanning forest of its links,
    so a group of any size costs rows in proportion to its tiles, not to its links.

    Null labels, and vectors that are null, zero, empty or hold a null or a non-finite
    component, link with nothing: 0 links, their own key, kept.  Vectors of different
    lengths never link.  Rows that repeat a key are rows of their own that share its
    component.  A null key takes part in n_links; it bears no component unless its
    equal vectors have a key.  An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector].dataType.elementType
    kind = np.dtype("<f4") if isinstance(element, T.FloatType) else np.dtype("<f8")
    source = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    label_type = source.schema["label"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_packed(v, kind) for v in batch.column(2).to_pylist()]
            yield pa.record_batch([*batch.columns[:2], pa.array(packed, pa.binary())], ["id", "label", "v"])

    checked, checked_path = store(source.mapInArrow(check, f"id long, label {label_type}, v binary"), "vectors")
    usable = checked.filter("label IS NOT NULL AND v IS NOT NULL")
    distinct, distinct_path = store(
        usable.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("n")).withColumn("rep", F.monotonically_increasing_id()),
        "distinct-vectors",
    )
    bases = _bases(distinct, kind)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [float(_unit(x := np.frombuffer(v, kind)) @ bases[len(x)][:, 0]) for v in batch.column(1).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(first, pa.float64())], ["label", "v", "n", "rep", "z"])

    placed = distinct.select("label", "v", "n", "rep").mapInArrow(place, f"label {label_type}, v binary, n long, rep long, z double")
    placed = placed.withColumn("size", F.length("v")).repartitionByRange("label", "size", "z").sortWithinPartitions("label", "size", "z")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tiles(batches, tile)

    tiles, tiles_path = store(
        placed.mapInArrow(cut, f"label {label_type}, size int, tile long, low double, high double, v binary, n binary, rep binary"),
        "tiles",
    )
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK  # of first coordinates of linked unit vectors
    a = tiles.select("label", "size", F.col("tile").alias("a"), "low", "high")
    b = tiles.select("label", "size", F.col("tile").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    pairs = a.join(b, ["label", "size"]).filter(
        (F.col("a") <= F.col("b")) & (F.col("low_b") <= F.col("high") + reach) & (F.col("low") <= F.col("high_b") + reach)
    )
    left = tiles.select(F.col("tile").alias("a"), F.col("size"), F.col("v").alias("va"), F.col("n").alias("na"), F.col("rep").alias("ra"))
    right = tiles.select(F.col("tile").alias("b"), F.col("v").alias("vb"), F.col("n").alias("nb"), F.col("rep").alias("rb"))
    work = pairs.select("a", "b").join(left, "a").join(right, "b").select("size", "va", "na", "ra", "vb", "nb", "rb", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _compare(batch.slice(i, 1).to_pylist()[0], kind, bases, threshold)

    links, links_path = store(work.mapInArrow(compare, "u long, v long, n long"), "links")
    counts = links.filter("n > 0").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n_other"))
    classes, classes_path = components(links.filter("n = 0").select("u", "v"), "vector-classes")
    joined = (
        distinct.join(counts, "rep", "left")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("class", F.coalesce("component", "rep"))
    )
    joined, joined_path = store(
        joined.select("label", "v", "class", "id", (F.col("n") - 1 + F.coalesce("n_other", F.lit(0))).alias("n_links")), "counted"
    )
    smallest = joined.groupBy("class").agg(F.min("id").alias("smallest"))
    known = joined.select(F.col("label").alias("_label"), F.md5("v").alias("_md5"), F.col("v").alias("_v"), "n_links", "class").join(smallest, "class")
    rows = checked.withColumn("_hash", F.md5("v"))
    result = rows.join(
        known,
        (F.col("label") == F.col("_label")) & (F.col("_hash") == F.col("_md5")) & (F.col("v") == F.col("_v")),
        "left",
    ).select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("smallest", "id").alias("component_id"),
    )
    result, _ = store(result.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))), "near-vectors")
    drop(spark, checked_path, distinct_path, tiles_path, links_path, classes_path, joined_path)
    return result


def _packed(v, kind) -> bytes | None:
    if not v or any(x is None for x in v):
        return None
    x = np.array(v, dtype=kind) + kind.type(0)  # -0.0 and 0.0 are one value
    return x.tobytes() if np.isfinite(x).all() and x.any() else None


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max()  # squares of very large or small components stay finite
    return x / np.linalg.norm(x)


def _bases(distinct: DataFrame, kind) -> dict[int, np.ndarray]:
    """Eigenvectors, largest eigenvalue first, of the second moments of all unit vectors of each length."""

    def moments(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for size in {len(v) for v in rows}:
                x = np.array([_unit(np.frombuffer(v, kind)) for v in rows if len(v) == size])
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + x.T @ x
        return {d: m.reshape(-1) for d, m in sums.items()}

    total = {d: m.reshape(d, d) for d, m in vector_sums(distinct.select("v"), moments, np.float64).items()}
    return {d: np.linalg.eigh(m)[1][:, ::-1] for d, m in total.items()}


def _tiles(batches, tile: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one label and length, up to `tile` of them, as one row."""
    from pyspark import TaskContext

    number, rows, at = TaskContext.get().partitionId() << 33, [], None

    def packed() -> pa.RecordBatch:
        label, size = at
        z = [r["z"] for r in rows]
        n, rep = (np.array([r[c] for r in rows], "<i8").tobytes() for c in ("n", "rep"))
        columns = [[label], [size], [number], [min(z)], [max(z)], [b"".join(r["v"] for r in rows)], [n], [rep]]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["label", "size", "tile", "low", "high", "v", "n", "rep"]
    for batch in batches:
        kinds = [batch.schema.field("label").type, pa.int32(), pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 3]
        for row in batch.to_pylist():
            here = (row["label"], row["size"])
            if rows and (here != at or len(rows) == tile):
                yield packed()
                number, rows = number + 1, []
            at = here
            rows.append(row)
    if rows:
        yield packed()


def _compare(pair: dict, kind, bases, threshold: float) -> pa.RecordBatch:
    """Links of two tiles: rows (u, u, rows linked to u), and (u, v, 0) of a spanning forest."""
    d = pair["size"] // kind.itemsize
    same = pair["a"] == pair["b"]
    x, y = (np.array([_unit(v) for v in np.frombuffer(pair[c], kind).reshape(-1, d)]) for c in ("va", "vb"))
    nx, ny = np.frombuffer(pair["na"], "<i8"), np.frombuffer(pair["nb"], "<i8")
    rx, ry = np.frombuffer(pair["ra"], "<i8"), np.frombuffer(pair["rb"], "<i8")
    px, py = x @ bases[d], y @ bases[d]
    steps = [s for s in STEPS if s < d]
    left_x, left_y = ({s: np.sqrt(np.maximum(1 - (p[:, :s] ** 2).sum(axis=1), 0)) for s in steps} for p in (px, py))
    counts_x, counts_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    union = Union(len(x) + len(y))
    if same:
        union.join(np.arange(len(x)), np.arange(len(x)) + len(x))
    for at in range(0, len(x), ROWS):
        block = slice(at, at + ROWS)
        i, j = _survivors(px[block], py, {s: v[block] for s, v in left_x.items()}, left_y, steps, threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        linked = np.concatenate(
            [np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]) >= threshold for k in range(0, len(i), 65536)] or [np.empty(0, bool)]
        )
        i, j = i[linked], j[linked]
        counts_x += np.bincount(i, ny[j], len(x)).astype(np.int64)
        (counts_x if same else counts_y)[:] += np.bincount(j, nx[i], len(y)).astype(np.int64)
        union.join(i, j + len(x))
    reps = np.concatenate([rx, ry])
    root = union.roots()
    tree = np.flatnonzero((root != np.arange(len(reps))) & (reps != reps[root]))
    u = np.concatenate([rx[counts_x > 0], ry[counts_y > 0], reps[tree]])
    v = np.concatenate([rx[counts_x > 0], ry[counts_y > 0], reps[root[tree]]])
    n = np.concatenate([counts_x[counts_x > 0], counts_y[counts_y > 0], np.zeros(len(tree), np.int64)])
    return pa.record_batch([pa.array(c, pa.int64()) for c in (u, v, n)], ["u", "v", "n"])


def _survivors(px, py, left_x, left_y, steps, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose leading products, with the most that the rest can add, reach the threshold."""
    if not steps:
        return tuple(np.indices((len(px), len(py))).reshape(2, -1))
    s = steps[0]
    i, j = np.nonzero(px[:, :s] @ py[:, :s].T + np.outer(left_x[s], left_y[s]) >= threshold - SLACK)
    partial = None
    for before, s in zip(steps, steps[1:]):
        if partial is None:
            partial = np.einsum("ij,ij->i", px[i, :before], py[j, :before])
        partial = partial + np.einsum("ij,ij->i", px[i, before:s], py[j, before:s])
        stay = partial + left_x[s][i] * left_y[s][j] >= threshold - SLACK
        i, j, partial = i[stay], j[stay], partial[stay]
    return i, j
