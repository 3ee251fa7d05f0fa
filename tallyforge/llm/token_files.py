"""Token files: ids of documents, Huffman-coded in independent blocks, in ascending id order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import tokens
from tallyforge.llm.huffman import Codebook, code_lengths
from tallyforge.llm.scratch import drop, store

BLOCK, EVERY = 8192, 256  # ids of an independent block, ids between two checkpoints
AT_ONCE = 1 << 19  # ids coded in one numpy pass


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    vocabulary: int = 50257,
    key: str = "doc_id",
    text: str = "text",
    end: int = 0,
    max_bits: int = 20,
    engine: str = "ranks",
) -> None:
    """Encode every text, append `end`, and write the ids under path.

    path/codebook has a row per used id (symbol, length): canonical code lengths of at
    most max_bits from the counts over all rows.  path/shards has a row per document,
    documents in ascending key order within a shard and from shard to shard: doc_id,
    shard, start_in_shard, n_tokens, payload (blocks of BLOCK ids, each on its own byte)
    and checkpoints (little-endian uint64 bit offsets in the payload, every EVERY ids),
    so a reader can begin at any checkpoint.  Spark's committer writes the files, so a
    lost executor leaves no half of one.

    Texts are tokenized once; their ids are stored as two or four bytes until they are
    coded.  Null text counts as empty, an empty document is its end id.  Null keys come
    first; rows that repeat a key stand side by side, in the order of their coded bytes.
    Other columns are not read.  An empty table writes an empty codebook.
    """
    spark = docs.sparkSession
    width = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer, engine)
        for batch in batches:
            ids = [tokens.ids_with_end(encode, t, end) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array([x.astype(width).tobytes() for x in ids], pa.binary())], ["doc_id", "ids"]
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(ids, width), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["symbol", "n"])

    coded, coded_path = store(source.mapInArrow(tokenize, "doc_id long, ids binary"), "ids")
    counted = coded.select("ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in counted.collect():  # at most a row per id of the vocabulary
        counts[row["symbol"]] = row["n"]
    lengths = code_lengths(counts, max_bits)
    book = [(int(s), int(lengths[s])) for s in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "symbol int, length int").coalesce(1).write.parquet(f"{path}/codebook")

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebook = Codebook(lengths)
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), [np.frombuffer(x, width) for x in batch.column(1).to_pylist()]
            for a, b in _runs([len(x) for x in rows], AT_ONCE):
                sizes = np.array([len(x) for x in rows[a:b]])
                payloads, offsets = codebook.encode(np.concatenate(rows[a:b]).astype(np.int64), sizes, BLOCK, EVERY)
                yield pa.record_batch(
                    [
                        pa.array(keys[a:b], pa.int64()),
                        pa.array(sizes),
                        pa.array(payloads, pa.binary()),
                        pa.array([x.astype("<u8").tobytes() for x in offsets], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "payload", "checkpoints"],
                )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            yield pa.record_batch(
                [batch.column(0), pa.array(np.full(len(sizes), shard, np.int32)), pa.array(starts), *batch.columns[1:]],
                ["doc_id", "shard", "start_in_shard", "n_tokens", "payload", "checkpoints"],
            )

    packed = "n_tokens long, payload binary, checkpoints binary"
    (
        coded.mapInArrow(encode_batches, f"doc_id long, {packed}")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "payload")
        .mapInArrow(number, f"doc_id long, shard int, start_in_shard long, {packed}")
        .write.option("compression", "none")
        .parquet(f"{path}/shards")
    )
    drop(spark, coded_path)


def read_codebook(spark: SparkSession, path: str, vocabulary: int = 50257) -> np.ndarray:
    lengths = np.zeros(vocabulary, dtype=np.uint8)
    for row in spark.read.parquet(f"{path}/codebook").collect():  # at most a row per id of the vocabulary
        lengths[row["symbol"]] = row["length"]
    return lengths


def read_token_files(spark: SparkSession, path: str, vocabulary: int = 50257) -> DataFrame:
    """Decode the files under path: doc_id, start, n_tokens, ids (little-endian uint32)."""
    return _decoded(spark, path, vocabulary, "ids binary", pa.binary(), lambda ids: ids.astype("<u4").tobytes())


def read_checksums(spark: SparkSession, path: str, vocabulary: int = 50257) -> DataFrame:
    """Decode the files under path: doc_id, start, n_tokens, ids_crc32; the ids stay in the tasks."""
    return _decoded(spark, path, vocabulary, "ids_crc32 long", pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _decoded(spark, path, vocabulary, field, kind, of) -> DataFrame:
    lengths = read_codebook(spark, path, vocabulary)
    name = field.split()[0]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebook = Codebook(lengths)
        for batch in batches:
            sizes = batch.column(3).to_numpy()
            payloads = batch.column(4).to_pylist()
            offsets = [np.frombuffer(x, "<u8") for x in batch.column(5).to_pylist()]
            out = []
            for a, b in _runs(sizes, AT_ONCE):
                ids = codebook.decode(payloads[a:b], offsets[a:b], sizes[a:b], EVERY)
                ends = np.cumsum(sizes[a:b])
                out += [of(ids[e - n : e]) for e, n in zip(ends, sizes[a:b])]
            yield pa.record_batch([*batch.columns[:4], pa.array(out, kind)], ["doc_id", "shard", "start_in_shard", "n_tokens", name])

    shards = spark.read.parquet(f"{path}/shards")
    totals = shards.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # a row per shard
    bases = totals.select(
        "shard", F.expr("coalesce(sum(n) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("base")
    )
    rows = shards.mapInArrow(decode, f"doc_id long, shard int, start_in_shard long, n_tokens long, {field}")
    return rows.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("start_in_shard")).alias("start"), "n_tokens", name)


def _runs(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about `limit` ids together; a longer row stands alone."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)
