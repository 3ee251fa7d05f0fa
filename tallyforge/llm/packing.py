"""Sum-of-squares packing of token sequences into windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import tokens
from tallyforge.llm.scratch import store

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, part int"


class SumOfSquares:
    """Online packing into windows of `size` tokens.

    counts[level] is the number of open windows filled to `level`.  An item of s tokens
    goes where the sum of the squared counts grows least: opening a window, filling one
    to the brim (it then leaves the array) or lifting one from h to h + s.  Ties take
    the fullest window.  Each level keeps its windows as a stack.
    """

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size, dtype=np.int64)  # level 0 stands for a new window
        self.open: list[list[list]] = [[] for _ in range(size)]

    def place(self, item, s: int) -> list | None:
        """Put the item of s <= size tokens into a window; the window if it is now full."""
        if s == self.size:
            return [item]
        top = self.size - s  # the highest level with room; from there a window is full and leaves the array
        change = -2 * self.counts[: top + 1]
        change[:top] += 2 * self.counts[s:] + 1
        change[1:] += 1
        change[1:][self.counts[1 : top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(change[::-1]))
        window = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
        window.append(item)
        if level + s == self.size:
            return window
        self.open[level + s].append(window)
        self.counts[level + s] += 1
        return None

    def rest(self) -> list[list]:
        return [w for level in reversed(self.open) for w in level]


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = 2048, end: int = 1, engine: str = "ranks"
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of docs becomes its token ids and `end`.  What exceeds whole windows of
    `size` is cut off the end of the document into full windows of their own; the rest
    is one item, packed whole by SumOfSquares as the rows arrive.  At the end of a task
    the contents of its open windows are laid one after another and cut anew into full
    windows; the tail, shorter than a window, goes into sequences whose lengths are
    powers of two.  So nothing needs padding, and only the last windows of a task cut
    short documents.  A task holds its open windows only (the level array keeps them
    few), never its input.

    Tasks follow the scan's splits; sequence ids run through tasks without gaps.  The
    pieces are stored once, so ids don't change when executors are lost.

    Null and empty texts hold the end id alone.  Null keys and repeated rows are packed
    like any row.  Other columns are not read.  An empty table gives an empty one.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from _pack_task(batches, tokens.encoder(tokenizer, engine), size, end, TaskContext.get().partitionId())

    pieces, _ = store(source.mapInArrow(pack, PIECES), "pieces")
    totals = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("n"))  # a row per task
    bases = totals.select(
        "part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("base")
    )
    return pieces.join(F.broadcast(bases), "part").select(
        F.col("doc_id").alias(key),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("sequence") + F.col("base")).alias("sequence_id"),
        "offset",
    )


def _pack_task(batches, encode, size: int, end: int, part: int) -> Iterator[pa.RecordBatch]:
    packer, sequence = SumOfSquares(size), 0
    for batch in batches:
        rows: list[tuple] = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = tokens.ids_with_end(encode, text, end)
            n = len(ids)
            whole = n - n % size
            items = [(doc, at, ids[at : at + size], n) for at in range(0, whole, size)]
            if whole < n:
                items.append((doc, whole, ids[whole:].copy(), n))
            for item in items:
                if full := packer.place(item, len(item[2])):
                    rows += _window(full, sequence, part)
                    sequence += 1
        yield _rows(rows)
    rows = []
    for window in _cut_anew(packer.rest(), size):
        rows += _window(window, sequence, part)
        sequence += 1
    yield _rows(rows)


def _cut_anew(windows: list[list], size: int) -> Iterator[list]:
    """The pieces of open windows, cut into full windows and a tail of powers of two."""
    pieces = [piece for window in windows for piece in window]
    left = sum(len(p[2]) for p in pieces)
    room, window = 0, []
    for doc, start, ids, n in pieces:
        at = 0
        while at < len(ids):
            if not room:
                room = size if left >= size else 1 << (left.bit_length() - 1)
            take = min(room, len(ids) - at)
            window.append((doc, start + at, ids[at : at + take], n))
            at, room, left = at + take, room - take, left - take
            if not room:
                yield window
                window = []


def _window(window: list, sequence: int, part: int) -> list[tuple]:
    rows, offset = [], 0
    for doc, start, ids, n in window:
        rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, sequence, offset, part))
        offset += len(ids)
    return rows


SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset")] + [("part", pa.int32())]
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(SCHEMA)
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)
