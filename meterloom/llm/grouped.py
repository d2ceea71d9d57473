"""Groups of consecutive rows in a sorted partition's Arrow batches."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """The rows of each run of equal keys (not null) as one batch, whatever batches they came in. Only one group is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.zeros(batch.num_rows, bool)
        for key in keys:
            column = batch.column(key)
            cut[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        if held and any(held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in keys):
            yield _joined(held)
            held = []
        edges = [0, *np.flatnonzero(cut).tolist()]
        for start, stop in zip(edges[:-1], edges[1:]):
            yield _joined([*held, batch.slice(start, stop - start)])
            held = []
        held.append(batch.slice(edges[-1]))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
