"""N-gram Jaccard join: an exact metric-space join of shingle sets, and its classes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.graph import components
from tallyforge.llm.link_counts import link_counts
from tallyforge.llm.metric_join import LIMIT, links_within
from tallyforge.llm.scratch import drop, in_buckets, key_buckets, reach_package, store
from tallyforge.llm.shingles import Shingler

ORDER_BITS = 19  # shingles are ranked by their rarest word; words are counted in 2 ** ORDER_BITS buckets
CHUNKS = 64  # parts of the count vector that are added up apart
BINS, FINE = 128, 2048  # of a folded set, and of one folded less


def similarity_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 3,
    num: int = 90,
    den: int = 100,
    limit: int = LIMIT,
    links: bool = False,
) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id; with links=True also n_links.

    Two rows link when den * |A & B| >= num * |A | B| for their sets of distinct
    `size`-word shingles (see Shingler); component_id is the smallest key reachable, n_links
    the number of other rows with a key that a row links to (equal sets are told apart by
    count alone; null for rows without a key).

    1. Equal sets are one point with its smallest key.
    2. Singletons {s} are the first pivots.  A set is at distance 1 - 1/|A| from the
       singletons of its own shingles and at 1 from all others, so its nearest pivots tie;
       the shingle with the word that is rarest in the corpus breaks the tie and names its
       region.  Sets
       within the threshold share at least num/den of the larger one's shingles, so a set
       is replicated to the regions of its first |A| - ceil(num/den |A|) + 1 shingles in
       that order, and any two that link meet in the region of their first common one.
       (Document pivots can't make this first cut: unrelated texts are all at distance 1.)
    3. In every region metric_join works on the folded sets, whose distance is a metric
       below the Jaccard distance: pivots, Voronoi regions, windows, blocks for regions
       that are too large for a task.  The classes it leaves are candidates;
       in each of them the same is done once more with finer folds, which part long texts.
    4. In every class metric_join works on the sets themselves, read again from the texts;
       link_counts does where links are asked for: recursive regions of the nearest pivot,
       with windows of twice the threshold, verify every link once.
    The counts behind the order cover all rows; they decide how fast the join is, not what
    it finds.  Copies and near copies of any number cost a region each, never all pairs.

    Null and empty texts, and texts of white space, have 0 shingles and are their own
    component.  A set all of whose rows have a null key has a null component.  Rows that
    repeat a key are rows of their own.  Other columns are not read.  An empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    reach_package(spark)
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    order = spark.sparkContext.broadcast(_corpus_counts(source))  # 2 ** ORDER_BITS numbers

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            rows = []
            for one in batch.column(1).to_pylist():
                s, rank = shingler.with_ranks(one, order.value)
                n = len(s)
                home = n - -(-num * n // den) + 1 if n else 0
                folded, fine = (
                    np.bincount((s & np.uint64(bins - 1)).astype(np.int64), minlength=bins).astype("<u2" if n < 1 << 16 else "<u4").tobytes()
                    for bins in (BINS, FINE)
                )
                rows.append((n, _digest(s), s[np.lexsort((s, rank))[:home]].astype("<u8").tobytes(), folded, fine))
            n, *binaries = zip(*rows) if rows else [()] * 5
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), *(pa.array(c, pa.binary()) for c in binaries)],
                ["id", "n", "digest", "regions", "folded", "fine"],
            )

    described, described_path = store(source.mapInArrow(describe, "id long, n long, digest binary, regions binary, folded binary, fine binary"), "sets")
    points = (
        described.filter("n > 0")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.count("id").alias("weight"), F.max("n").alias("n"), *(F.min(c).alias(c) for c in ("regions", "folded", "fine")))
        .filter("id IS NOT NULL")
        .withColumn("point", F.monotonically_increasing_id())
    )
    points, points_path = store(points, "points")
    widest = points.agg(F.max("n")).first()[0] or 0
    kind = "<u2" if widest < 1 << 16 else "<u4"

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions = [np.frombuffer(r, "<i8") for r in batch.column(1).to_pylist()]
            if regions:
                ids = np.repeat(batch.column(0).to_numpy(), [len(r) for r in regions])
                yield pa.record_batch([pa.array(np.concatenate(regions)), pa.array(ids)], ["group", "id"])

    homes = points.select("point", "regions").mapInArrow(explode, "group long, id long").repartition("group").sortWithinPartitions("group")
    shared, shared_path = store(homes.mapInArrow(_not_alone, "group long, id long"), "regions")
    folded, fine = (points.select(F.col("point").alias("id"), "n", c) for c in ("folded", "fine"))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            counts = [f if (n >= 1 << 16) == (kind == "<u4") else np.frombuffer(f, "<u2").astype("<u4").tobytes() for n, f in rows]
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.binary())], ["id", "payload"])

    folded = folded.mapInArrow(widen, "id long, payload binary")
    in_regions, in_regions_path = store(shared.join(folded, "id").select("group", "id", "payload"), "folded")
    near, near_paths = links_within(in_regions, kind, num, den, limit, "candidates")
    candidates, candidates_path = components(near, "candidate-classes")
    drop(spark, shared_path, in_regions_path, *near_paths)
    member = candidates.select(F.col("node").alias("id"), F.col("component").alias("group"))
    in_classes, in_classes_path = store(
        member.join(fine.mapInArrow(widen, "id long, payload binary"), "id").select("group", "id", "payload"), "fine"
    )
    nearer, nearer_paths = links_within(in_classes, kind, num, den, limit, "nearer")
    drop(spark, candidates_path)
    candidates, candidates_path = components(nearer, "nearer-classes")
    drop(spark, in_classes_path, *nearer_paths)

    wanted = points.join(candidates, F.col("point") == F.col("node")).select(F.col("component").alias("group"), "point", F.col("id").alias("_id"), "digest", "weight")
    wanted, wanted_path = store(wanted, "wanted")  # few rows, without texts
    # only texts that may be wanted are shuffled
    texts = in_buckets(source, "id", key_buckets(wanted, "_id")).join(wanted, F.col("id") == F.col("_id")).select("group", "point", "digest", "text", "weight")

    def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            sets = [shingler(one) for one in batch.column(3).to_pylist()]
            own = [_digest(s) == d for s, d in zip(sets, batch.column(2).to_pylist())]  # not another row of the key
            sets = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
            read = [batch.column(0), batch.column(1), sets, batch.column(4)]
            yield pa.record_batch(read, ["group", "id", "payload", "weight"]).filter(pa.array(own, pa.bool_()))

    sets, sets_path = store(texts.mapInArrow(reread, "group long, id long, payload binary, weight long"), "candidate-sets")
    if links:
        counted, links_paths = link_counts(sets, num, den, limit, "links")
        found = counted.filter("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    else:
        found, links_paths = links_within(sets.drop("weight"), "sets", num, den, limit, "links")
    classes, classes_path = components(found, "classes")

    named = points.select("point", "digest", "id", "weight").join(classes, F.col("point") == F.col("node"), "left")
    named = named.select("point", "digest", "id", "weight", F.coalesce("component", "point").alias("class"))
    smallest = named.groupBy("class").agg(F.min("id").alias("smallest"))
    named = named.join(smallest, "class")
    if links:
        by_point = counted.groupBy(F.col("id").alias("_point")).agg(F.sum("n").alias("n"))
        named = named.join(by_point, F.col("point") == F.col("_point"), "left")
        named = named.withColumn("n_links", F.col("weight") - 1 + F.coalesce("n", F.lit(0)))
    known = named.select(F.col("digest").alias("_digest"), "smallest", *(["n_links"] if links else []))
    result = described.select("id", "n", "digest").join(known, F.col("digest") == F.col("_digest"), "left")
    result, _ = store(
        result.select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("smallest")).alias("component_id"),
            *([F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links")] if links else []),
        ),
        "similar",
    )
    drop(spark, described_path, points_path, candidates_path, wanted_path, sets_path, classes_path, *links_paths)
    return result


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def _corpus_counts(source: DataFrame) -> np.ndarray:
    """Words by bucket, over all rows; added up in the tasks and by chunk of the vector."""
    width = (1 << ORDER_BITS) // CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(1), np.zeros(1 << ORDER_BITS, dtype=np.int64)
        for batch in batches:
            for one in batch.column(0).to_pylist():
                np.add.at(total, (shingler.codes(one) >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1)
        parts = [p.tobytes() for p in total.reshape(CHUNKS, width)]
        yield pa.record_batch([pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                totals[chunk] = totals.get(chunk, 0) + np.frombuffer(counts, np.int64)
        yield pa.record_batch(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["chunk", "counts"]
        )

    counted = source.select("text").mapInArrow(count, "chunk int, counts binary").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    total = np.zeros((CHUNKS, width), dtype=np.int64)
    for row in counted.collect():  # CHUNKS rows
        total[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    return total.reshape(-1)


def _not_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted batches whose group has another row; one row is held back between batches."""
    kept = None  # the last row so far, and whether its group has another before it
    for batch in batches:
        group, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(group):
            continue
        paired = False
        if kept:
            group, ids, paired = np.append(kept[0], group), np.append(kept[1], ids), kept[2]
        same = group[1:] == group[:-1]
        shared = np.append(paired, same) | np.append(same, False)
        kept = (group[-1], ids[-1], bool(shared[-1]))
        out = shared[:-1]
        yield pa.record_batch([pa.array(group[:-1][out]), pa.array(ids[:-1][out])], ["group", "id"])
    if kept and kept[2]:
        yield pa.record_batch([pa.array([kept[0]]), pa.array([kept[1]])], ["group", "id"])


def keep_one_of_each(docs: DataFrame, classes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of docs that bear the smallest key of their class; rows with a null key stay.

    Keys that go are put into buckets first: rows in other buckets stay where they are, and
    only the rest is shuffled to be compared with the keys themselves.
    """
    kept = F.max(F.col(key) == F.col("component_id"))
    gone = classes.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_gone")).agg(kept.alias("_kept")).filter("NOT _kept").select("_gone")
    gone, _ = store(gone, "gone")
    buckets = key_buckets(gone, "_gone")
    doubtful = in_buckets(docs, key, buckets).join(gone, docs[key] == gone["_gone"], "left_anti")
    return in_buckets(docs, key, buckets, inside=False).unionByName(doubtful)
