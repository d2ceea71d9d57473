"""A count sketch of fixed size: how often hashes of a table occur, never too low. One row of counters, so a count is
the sum over all values that share a counter. Every task adds up its own counters and Spark adds the tasks'."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Counters; 8 bytes each are the whole size of what is broadcast.
WIDTH = 1 << 18
CHUNKS = 64
FIELDS = "chunk int, counts binary"


class Counters:
    def __init__(self):
        self.counts = np.zeros(WIDTH, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        self.counts += np.bincount((hashes & np.uint64(WIDTH - 1)).astype(np.int64), minlength=WIDTH)

    def chunks(self) -> list[tuple[int, bytes]]:
        return [(i, c.tobytes()) for i, c in enumerate(np.split(self.counts.astype(np.int64), CHUNKS)) if c.any()]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sums.setdefault(chunk, np.zeros(WIDTH // CHUNKS, np.int64))
            own += np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                     ["chunk", "counts"])


def collected(chunks: DataFrame) -> np.ndarray:
    """All counters, on the driver: WIDTH of them, however many rows were counted. chunks: rows of FIELDS."""
    counts = np.zeros((CHUNKS, WIDTH // CHUNKS), np.int64)
    salted = chunks.withColumn("salt", (F.rand(7) * 8).cast("int")).repartition("chunk", "salt").select("chunk", "counts")
    for chunk, own in salted.mapInArrow(_summed, FIELDS).collect():
        counts[chunk] += np.frombuffer(own, np.int64)
    return counts.reshape(-1)
