"""Exact top-k search over an impact-ordered, score-at-a-time index.

Components are whole numbers, floor(SCALE * x). The index is cut into blocks of about BLOCK vectors, dealt by hash. Within
a block a posting is a vector's component; its impact is the power of two its magnitude lies in. Postings of one impact and
dimension are a segment. Segments are processed by descending impact, those of one impact as one product, which adds their
parts to the scores of all queries of a batch. After an impact, a vector's rest (the norm of its components still to come) times the query's norm bounds what can
follow. The k-th best lower bound proves which vectors can no longer be among the k; as soon as scoring the possible members
in full costs less than the segments left, they are scored exactly and the block is done. Nothing stops without that proof.

Queries go to the blocks in batches, a row each, behind the block's index; one index and Spark's Arrow batch of rows (64 MB)
are what a task holds. Each block returns its k best of each query, and the best of these are the result.

Vectors that are null or hold a null or a component that is not finite take no part, nor do rows without an id. Rows that
repeat an id and a vector count once. A shorter vector ends in zeros. Equal scores are ranked by the smaller id; a query is
not its own neighbour. Fewer than k candidates: all of them. Scores that may not fit a long raise an error. Empty tables
give empty results; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.session import settle

SCALE = 256
BLOCK = 4096
BATCH = 256
RESULT = "query_id long, vec_id long, score long"
_INDEX = "block int, ids binary, width int, impacts binary, dims binary, counts binary, positions binary, values binary, rests binary"


def whole(vectors: DataFrame) -> DataFrame:
    """vec_id and components v of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v")).distinct()


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.sort_by("vec_id")
    ids, rows = table.column("vec_id").to_numpy(), [np.asarray(r, np.int64) for r in table.column("v").to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return ids, out


def build(table: pa.Table) -> pa.Table:
    """The index row of a block: segments by descending impact, and every vector's rest after each impact."""
    block = table.column("block")[0].as_py()
    ids, matrix = _matrix(table)
    magnitude = np.abs(matrix)
    impact = np.where(magnitude > 0, np.floor(np.log2(np.maximum(magnitude, 1))).astype(np.int64), -1)
    at, dim = np.nonzero(matrix)
    order = np.lexsort((at, dim, -impact[at, dim]))
    at, dim = at[order], dim[order]
    own = impact[at, dim]
    starts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (dim[1:] != dim[:-1])])) if len(at) else np.zeros(0, np.int64)
    levels = sorted({int(x) for x in own}, reverse=True)
    rests = [np.sqrt((np.where(impact < level, matrix, 0).astype(np.float64) ** 2).sum(1)) for level in levels]
    row = [ids.tobytes(), matrix.shape[1], own[starts].tobytes(), dim[starts].tobytes(), np.diff(np.append(starts, len(at))).tobytes(),
           at.astype(np.int32).tobytes(), matrix[at, dim].tobytes(), np.array(rests, np.float64).tobytes()]
    return pa.Table.from_arrays([pa.array([x], t) for x, t in zip([block, *row], [
        pa.int32(), pa.binary(), pa.int32(), *[pa.binary()] * 6])], [c.split()[0] for c in _INDEX.split(", ")])


def _packed(table: pa.Table) -> pa.Table:
    ids, matrix = _matrix(table)
    return pa.Table.from_arrays([pa.array([table.column("batch")[0].as_py()], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                                 pa.array([matrix.shape[1]], pa.int32()), pa.array([matrix.tobytes()], pa.binary())],
                                ["batch", "q_ids", "q_width", "q_values"])


def opened(row: dict) -> dict:
    """A block's index row as arrays."""
    ids, positions = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["positions"], np.int32)
    impacts, dims, counts, values = (np.frombuffer(row[c], np.int64) for c in ("impacts", "dims", "counts", "values"))
    by_id = np.argsort(ids, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(ids[by_id]) != 0])) if len(ids) else np.zeros(0, np.int64)
    dims = np.repeat(dims, counts)
    dense = np.zeros((len(ids), row["width"]), np.int64)
    dense[positions, dims] = values
    levels = np.flatnonzero(np.concatenate([[True], impacts[1:] != impacts[:-1]])) if len(impacts) else np.zeros(0, np.int64)
    return {"ids": ids, "by_id": by_id, "heads": heads, "dense": dense, "positions": positions, "dims": dims, "values": values,
            "bounds": [*(np.cumsum(counts) - counts)[levels].tolist(), len(values)],
            "rests": np.frombuffer(row["rests"], np.float64).reshape(len(levels), len(ids))}


def search(index: dict, q_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the k best ids of each query in a block; an id that repeats has its best score."""
    ids, by_id, heads, dense = (index[c] for c in ("ids", "by_id", "heads", "dense"))
    positions, dims, values, bounds, rests = (index[c] for c in ("positions", "dims", "values", "bounds", "rests"))
    n, width = dense.shape
    if float(np.abs(values).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(width, queries.shape[1]) >= 2.0 ** 52:
        raise OverflowError("components too large to be added exactly")
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    queries = np.pad(queries[:, :width], ((0, 0), (0, max(0, width - queries.shape[1]))))
    across = queries.astype(np.float64)
    own = q_ids[:, None] == ids[None, :]
    scores = np.zeros((len(q_ids), n))

    def may_be(some: slice, rest: np.ndarray) -> np.ndarray:
        """Which vectors may be among the k best of these queries, if `rest` is what is still to come."""
        follow = norms[some, None] * rest[None, :] * (1 + 1e-9) + (1e-6 if rest.any() else 0)
        low = np.where(own[some], -np.inf, scores[some] - follow)
        if len(heads) < n:
            low = np.maximum.reduceat(low[:, by_id], heads, axis=1)
        return (scores[some] + follow >= np.partition(low, len(heads) - k, 1)[:, len(heads) - k, None]) & ~own[some]

    possible = ~own
    sample = slice(0, None, max(1, len(q_ids) // 16))
    for level, (first, last) in enumerate(zip(bounds, bounds[1:])):
        at, left = slice(first, last), len(values) - last
        rows, place = np.unique(positions[at], return_inverse=True)
        part = np.zeros((len(rows), width))
        part[place, dims[at]] = values[at]
        if len(rows) < n:
            scores[:, rows] += across @ part.T
        else:
            scores += across @ part.T
        # A few queries tell whether the bound may pay; what it decides is proven for all of them.
        if len(heads) - 1 <= k or left and may_be(sample, rests[level]).sum(1).mean() * width > left:
            continue
        possible = may_be(slice(None), rests[level])
        if possible.sum() * width <= left * len(q_ids):
            break
    q, at = np.nonzero(possible)
    exact = np.concatenate([(dense[at[i:i + 65536]] * queries[q[i:i + 65536]]).sum(1) for i in range(0, len(at), 65536)] or [np.zeros(0, np.int64)])
    order = np.lexsort((ids[at], -exact, q))
    at, q, exact = at[order], q[order], exact[order]
    again = np.unique(q * np.int64(n) + np.searchsorted(ids[by_id][heads], ids[at]), return_index=True)[1]
    again.sort()
    at, q, exact = at[again], q[again], exact[again]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q_ids[q[rank < k]], ids[at[rank < k]], exact[rank < k]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; is_query: which rows' vectors are queries."""
    used = settle(whole(vectors), "whole")
    n, n_queries = used.agg(F.count("*"), F.count_if(is_query)).first()
    n_blocks, n_batches = max(1, -(-n // BLOCK)), max(1, -(-n_queries // BATCH))
    spread = F.xxhash64("vec_id", "v")
    index = settle(used.withColumn("block", F.pmod(spread, F.lit(n_blocks)).cast("int")).groupBy("block").applyInArrow(build, _INDEX), "index")
    batches = used.where(is_query).withColumn("batch", F.pmod(spread, F.lit(n_batches)).cast("int")).groupBy("batch").applyInArrow(
        _packed, "batch int, q_ids binary, q_width int, q_values binary")
    asked = batches.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    # No join: it would copy an index for each batch, and Spark, which takes `asked` for as large as the queries, broadcast it.
    dealt = index.unionByName(asked, allowMissingColumns=True).repartition(n_blocks, "block").sortWithinPartitions(
        "block", F.col("q_ids").isNotNull())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's index comes before its batches of queries and is opened once; blocks without vectors have none."""
        block, opened_index = None, None
        for batch in rows:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["q_ids"] is None:
                    block, opened_index = row["block"], opened(row)
                elif row["block"] == block:
                    q_ids = np.frombuffer(row["q_ids"], np.int64)
                    found = search(opened_index, q_ids, np.frombuffer(row["q_values"], np.int64).reshape(len(q_ids), row["q_width"]), k)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    near = dealt.mapInArrow(run, RESULT)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A vector that repeats under one id with other components keeps its best score.
    each = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
