"""Sums of long vectors that tasks hold: added up on the executors, piece by piece."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE = 1 << 13  # numbers of a vector that are shuffled and added together
KEYED = ["name", "piece", "part"]


def vector_sums(
    rows: DataFrame, vectors: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]], kind: type = np.int64
) -> dict[int, np.ndarray]:
    """By name, the sum over all tasks of the vectors that each task makes of its rows.

    `vectors` sees a task's batches and gives named vectors; those of one name have one
    length.  Two stages whatever the number of tasks: pieces of a vector meet in one task
    each, and only the sums reach the driver.  A task without rows gives nothing.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, vector in vectors(batches).items():
            parts = [vector[at : at + PIECE].astype(kind).tobytes() for at in range(0, len(vector), PIECE)]
            yield packed([name] * len(parts), range(len(parts)), parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for name, piece, part in zip(*(column.to_pylist() for column in batch.columns)):
                totals[name, piece] = totals.get((name, piece), 0) + np.frombuffer(part, kind)
        yield packed([k[0] for k in totals], [k[1] for k in totals], [t.tobytes() for t in totals.values()])

    def packed(names, pieces, parts) -> pa.RecordBatch:
        return pa.record_batch([pa.array(names, pa.int32()), pa.array(pieces, pa.int32()), pa.array(parts, pa.binary())], KEYED)

    schema = "name int, piece int, part binary"
    found: dict[int, dict[int, np.ndarray]] = {}
    summed = rows.mapInArrow(cut, schema).repartition("name", "piece").mapInArrow(add, schema)
    for row in summed.collect():  # one vector of each name
        found.setdefault(row["name"], {})[row["piece"]] = np.frombuffer(row["part"], kind)
    return {name: np.concatenate([parts[i] for i in sorted(parts)]) for name, parts in found.items()}
