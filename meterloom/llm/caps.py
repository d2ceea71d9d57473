"""Near-duplicate vectors by spherical-cap filters.

A filter is a unit vector f; a vector v lies in its cap when <v, f> >= alpha. Filters are products: after a random
rotation a vector is cut into PARTS parts, each part has a book of WORDS random directions, and every choice of one word
from each book is a filter, TURNS * WORDS^PARTS in all. Vectors of few components need fewer: a part of n components has at
most 2^n words, and there are no more turns than components. <v, f> is a sum over parts, so a vector is list-decoded to all
filters above alpha part by part, dropping a choice as soon as the best words left cannot lift it to alpha; no filter is
written down. Two vectors that share a filter (and a label) are compared exactly.

alpha follows from the dimension and the least cosine alone (`calibrated`): it is the largest one at which the share
RECALL of random pairs with exactly that cosine have a filter in common, so nearer pairs are found more often still.
Rotations and books are random and seeded, so that holds for every pair of the data, whatever its shape. Measured recall
is in tests/llm; alpha does not depend on the number of rows.

Equal vectors of a label are folded to one with a count first. A filter with more than TILE vectors is cut into pieces by
hash, and each two pieces meet in one group of rows, so no group has more than about 2 * TILE rows and the rows dealt
grow by the number of pieces. Inside a group cosines are matrix products; links are added up there (a link that several
filters see is counted by the smallest one) and leave as a count and one connecting edge per vector, never as pairs.
Totals go back to rows by key and salt, so neither a common vector nor a large component makes a hot key.

Vectors compare only with equal, non-null labels and equal lengths. Null vectors, zero vectors and those that hold null
or non-finite components link with nothing, and are their own component. Rows that repeat an id are vectors of their
own; a component's id is the smallest not null. An empty table gives an empty one. Only the named columns are read."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterloom.llm.components import components
from meterloom.session import settle

PARTS, WORDS, TURNS = 2, 128, 64
RECALL = 0.995
TILE = 1024
SMALL = 64
SALTS = 64
_TRIALS = 1000


class Code:
    """The filters for vectors of `size` components."""

    def __init__(self, size: int):
        self.parts = np.array_split(np.arange(size), min(PARTS, size))
        self.turns = []
        for turn in range(min(TURNS, size)):
            rng = np.random.default_rng([20, size, turn])
            rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
            books = [rng.standard_normal((min(WORDS, 1 << len(p)), len(p))) for p in self.parts]
            if size <= PARTS:
                books = [np.array([[1.0], [-1.0]]) for _ in self.parts]
            self.turns.append((rotation, [b / (np.linalg.norm(b, axis=1, keepdims=True) * len(self.parts) ** 0.5) for b in books]))

    def decode(self, unit: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, filter, product) of every filter whose product with the row's unit vector is alpha or more."""
        out = []
        for turn, (rotation, books) in enumerate(self.turns):
            turned = unit @ rotation
            scores = [turned[:, p] @ b.T for p, b in zip(self.parts, books)]
            most = [np.zeros(len(unit))]
            for s in scores[:0:-1]:
                most.append(most[-1] + s.max(axis=1))
            row, total, code = np.arange(len(unit)), np.zeros(len(unit)), np.full(len(unit), turn)
            for s, left in zip(scores, reversed(most)):
                sums = total[:, None] + s[row]
                i, word = np.nonzero(sums >= (alpha - left[row])[:, None])
                row, total, code = row[i], sums[i, word], code[i] * WORDS + word
            out.append((row, code, total))
        return tuple(np.concatenate(x) for x in zip(*out))


def calibrated(code: Code, size: int, cosine: float) -> float:
    """The largest alpha at which RECALL of random pairs with this cosine share a filter."""
    rng = np.random.default_rng([21, size])
    a = _unit(rng.standard_normal((_TRIALS, size)))
    other = rng.standard_normal((_TRIALS, size))
    other = _unit(other - (other * a).sum(axis=1, keepdims=True) * a + 1e-300)
    b = cosine * a + (1 - cosine * cosine) ** 0.5 * other if size > 1 else a
    alpha = 1.0
    while True:
        alpha -= 0.03
        (ra, ca, ta), (rb, cb, tb) = code.decode(a, alpha), code.decode(b, alpha)
        filters = WORDS ** PARTS * TURNS
        common, ia, ib = np.intersect1d(ra * filters + ca, rb * filters + cb, assume_unique=True, return_indices=True)
        best = np.full(_TRIALS, -np.inf)
        np.maximum.at(best, common // filters, np.minimum(ta[ia], tb[ib]))
        least = np.sort(best)[int((1 - RECALL) * _TRIALS)]
        if np.isfinite(least):
            return float(least)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision, of a list column whose values are usable and of one length."""
    return _unit(np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1))


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def delivered(rows: DataFrame, keys: list[str], by: str, results: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined to `results`, one row per key, when a key may hold any share of the rows: results go to each of at
    most SALTS parts of a key, and rows meet them there. `by`: what parts a key's rows."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    parts = salted.select(*keys, "_salt").distinct().join(results, keys)
    return salted.join(parts, [*keys, "_salt"], how).drop("_salt")


def _decoded(alphas: dict[int, float]):
    """Rows of (node, sort, size, vector) to (node, sort, filters), filters in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                code = codes.setdefault(size, Code(size))
                for start in range(0, own.num_rows, 256):
                    some = own.slice(start, 256)
                    row, found, _ = code.decode(_matrix(some.column("vector")), alphas[size])
                    order = np.lexsort((found, row))
                    offsets = np.searchsorted(row[order], np.arange(some.num_rows + 1))
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found[order], pa.int64()))
                    yield pa.RecordBatch.from_arrays([some.column("node"), some.column("sort"), lists], ["node", "sort", "filters"])
    return run


def _bounds(batch: pa.RecordBatch, keys: tuple[str, ...]) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    n = batch.num_rows
    new = np.ones(n, bool)
    codes = [batch.column(k).dictionary_encode().indices.to_numpy() for k in keys]
    new[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0)
    return np.append(np.flatnonzero(new), n)


class Group:
    """The vectors of some groups: links inside each, those counted here, and what connects them."""

    def __init__(self, rows: pa.RecordBatch, cosine: float):
        self.cosine = cosine
        self.unit = _matrix(rows.column("vector"))
        self.members = rows.column("members").to_numpy()
        self.node = rows.column("node").to_numpy()
        self.here = rows.column("filter").to_numpy()
        self.piece = rows.column("piece").to_numpy()
        self.apart = (rows.column("a").to_numpy() != rows.column("b").to_numpy())
        lists = rows.column("filters")
        self.offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        self.filters = np.asarray(lists.flatten())
        self.n = np.zeros(len(self.node), np.int64)
        self.root = np.arange(len(self.node))

    def meets(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Two pieces of a filter meet each other here, not themselves."""
        return ~self.apart[i] | (self.piece[i] != self.piece[j])

    def large(self, start: int, stop: int) -> None:
        """One group, by matrix products."""
        unit = self.unit[start:stop]
        i, j = np.nonzero(np.triu(unit @ unit.T >= self.cosine, 1))
        ok = self.meets(i + start, j + start)
        i, j = i[ok], j[ok]
        if not len(i):
            return
        rows = np.unique(np.concatenate([i, j]))
        owner = np.repeat(np.arange(len(rows)), np.diff(self.offsets)[rows + start])
        held = np.concatenate([self.filters[self.offsets[r + start]:self.offsets[r + start + 1]] for r in rows.tolist()])
        less = held < self.here[start]
        values, column, counts = np.unique(held[less], return_inverse=True, return_counts=True)
        shared = counts > 1
        column, owner = column[shared[column]], owner[less][shared[column]]
        at = np.cumsum(shared) - 1
        incidence = np.zeros((len(rows), max(1, int(shared.sum()))), np.float32)
        incidence[owner, at[column]] = 1
        place = np.searchsorted(rows, np.arange(stop - start))
        earlier = (incidence @ incidence.T) > 0
        self.link(i + start, j + start, ~earlier[place[i], place[j]])

    def small(self, group: np.ndarray) -> None:
        """Many groups of at most SMALL rows: row i beside row i + k of its group, for each k."""
        at = np.flatnonzero(group >= 0)
        for k in range(1, SMALL):
            at = at[at + k < len(group)]
            at = at[group[at] == group[at + k]]
            if not len(at):
                return
            hits = at[np.einsum("ij,ij->i", self.unit[at], self.unit[at + k]) >= self.cosine]
            hits = hits[self.meets(hits, hits + k)]
            counted = np.array([self.first(i, i + k) == self.here[i] for i in hits.tolist()], bool)
            self.link(hits, hits + k, counted)

    def first(self, i: int, j: int) -> int:
        """The smallest filter that two rows share."""
        a, b = (self.filters[self.offsets[x]:self.offsets[x + 1]] for x in (i, j))
        return int(np.intersect1d(a, b, assume_unique=True)[0])

    def link(self, i: np.ndarray, j: np.ndarray, counted: np.ndarray) -> None:
        np.add.at(self.n, i[counted], self.members[j[counted]])
        np.add.at(self.n, j[counted], self.members[i[counted]])
        while len(i):
            before = self.root.copy()
            low = np.minimum(self.root[i], self.root[j])
            np.minimum.at(self.root, i, low)
            np.minimum.at(self.root, j, low)
            if (before == self.root).all():
                return


def _verified(cosine: float):
    keys = ("sort", "filter", "a", "b")

    def linked(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Whole groups; those of one length of vectors at a time."""
        sizes = np.diff(np.asarray(rows.column("vector").offsets))
        for size in np.unique(sizes).tolist():
            own = rows.filter(pa.array(sizes == size))
            bounds, work = _bounds(own, keys), Group(own, cosine)
            lengths = np.diff(bounds)
            work.small(np.repeat(np.where(lengths <= SMALL, np.arange(len(lengths)), -1), lengths))
            for g in np.flatnonzero(lengths > SMALL).tolist():
                work.large(int(bounds[g]), int(bounds[g + 1]))
            seen = np.flatnonzero((work.n > 0) | (work.root != np.arange(len(work.root))))
            yield pa.RecordBatch.from_arrays([pa.array(work.node[seen]), pa.array(work.n[seen]), pa.array(work.node[work.root[seen]])],
                                             ["node", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = int(_bounds(batch, keys)[-2])
            same = bool(held) and all(held[-1].column(k)[held[-1].num_rows - 1] == batch.column(k)[0] for k in keys)
            if last == 0 and same:
                held.append(batch)
                continue
            done = pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            if done.num_rows:
                yield from linked(done.to_batches()[0])
            held = [batch.slice(last)]
        if held:
            yield from linked(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of `vectors`: the key, n_links (other rows with the label whose cosine reaches `cosine`),
    component_id (the smallest key reached by links, its own included) and kept (it is that one)."""
    v, mark = F.col(vector), F.col(label).cast("string")
    rows = vectors.select(F.col(key).alias("key"), mark.alias("mark"), v.alias("vector"), usable(v, mark).alias("_ok"))
    of = [F.xxhash64("mark", "vector").alias("h1"), F.xxhash64(F.lit("second"), "mark", "vector").alias("h2")]
    good = settle(rows.where("_ok").select("key", *of, "mark", "vector"), "vectors")
    folded = good.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("members"), F.min("key").alias("least"), F.first("mark").alias("mark"),
                                          F.first("vector").alias("vector"))
    size = F.size("vector")
    classes = settle(folded.select("*", F.concat_ws("/", size.cast("string"), "mark").alias("sort"), size.alias("size"),
                                   F.monotonically_increasing_id().alias("node")), "classes")
    alphas = {s: calibrated(Code(s), s, cosine) for (s,) in classes.select("size").distinct().collect()}
    lists = settle(classes.select("node", "sort", "size", "vector").mapInArrow(
        _decoded(alphas), "node long, sort string, filters array<long>"), "filters")
    caps = lists.select("node", "sort", F.explode("filters").alias("filter"))
    crowd = caps.groupBy("sort", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "sort", "filter", F.ceil(F.col("n") / TILE).cast("int").alias("pieces"))
    placed = delivered(caps, ["sort", "filter"], "node", crowd).withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "node", "sort", "filter", "piece", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"))
    told = dealt.join(classes.select("node", "members", "vector").join(lists.select("node", "filters"), "node"), "node")
    tiles = told.repartition("sort", "filter", "a", "b").sortWithinPartitions("sort", "filter", "a", "b")
    seen = settle(tiles.mapInArrow(_verified(cosine), "node long, n long, root long"), "cap-links")
    counts = seen.groupBy("node").agg(F.sum("n").alias("n"))
    near = settle(components(seen.where("root <> node").select(F.col("node").alias("a"), F.col("root").alias("b"))), "cap-components")
    least = near.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("lowest"))
    reached = delivered(near, ["component"], "node", least).select("node", "lowest")
    results = classes.join(counts, "node", "left").join(reached, "node", "left").select(
        "h1", "h2", (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("lowest", "least").alias("component_id"))
    linked = delivered(good.select("key", "h1", "h2"), ["h1", "h2"], "key", results).select("key", "n_links", "component_id")
    alone = rows.where("not _ok").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.unionByName(alone).select(F.col("key").alias(key), "n_links", "component_id",
                                            F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"))
