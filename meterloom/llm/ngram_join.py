"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

The matrix has a row per text and a column per distinct word n-gram. Columns are ordered by how often they occur (a count
sketch of all texts) and then by hash, rarest first. A row is cut into a head, just long enough that two rows similar
enough share a column of it, and a tail. The product of the heads accumulates overlap counts per pair; a pair whose sizes
differ too much, or whose count so far plus all that can still follow is below what its sizes ask for, is discarded; at a
pair's first shared column that is known from the column's places in both rows, before the two are put together. For
the pairs left the product goes on over whole rows, and the exact test decides.

Three things keep the product from growing with the square of a group. Equal rows are one row, with its members listed
beside it. Each column first links its rows to the smallest one; rows found connected that way need no further
comparison. Only columns that still hold rows of different components are multiplied out, and only across components. A
column's rows are never gathered unless its sketch count proves that they are few.

Results, for every row of documents (nulls and repeats included):
* `n_shingles`: size of the set of distinct n-grams; fewer words than n: the whole sequence is one; no words or a null
  text: 0, linked with nothing;
* `component_id`: the smallest doc_id reached by links, its own included;
* `class_id`: the smallest doc_id whose text has the same set (its own where the set is empty);
* rows that share a doc_id are one document with all their links; a null doc_id has a null component and no links.
Extra columns of documents are left alone; an empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from meterloom.llm import sketch, textkit
from meterloom.llm.components import components
from meterloom.session import settle

#: A column of at most this many rows, by its sketch count, is gathered by one window; a larger one is folded first.
GATHERED = 20_000


def _sets(batch: pa.RecordBatch, n: int, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    words = textkit.words(batch.column(name))
    return textkit.distinct_per_row(*textkit.windows(words.hashes(), words.rows, n))


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document the size and a 128-bit hash of its set; at the end the task's counters."""
        counters = sketch.Counters()
        names = ["doc_id", "n_shingles", "s1", "s2", "chunk", "counts"]
        for part in textkit.cuts(batches):
            grams, offsets = _sets(part, n)
            counters.add(grams)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(textkit.mix(grams ^ np.uint64(salt)), dtype=np.uint64)])
                    for salt in (0x1234567, 0x89ABCDE0)]
            own = [textkit.ids(s[offsets[1:]] - s[offsets[:-1]]) for s in sums]
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(own[0]), pa.array(own[1]),
                                              pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        chunks = counters.chunks()
        k = len(chunks)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                                          pa.array([c for c, _ in chunks], pa.int32()), pa.array([b for _, b in chunks], pa.binary())], names)
    return run


def _heads(n: int, similarity: Fraction, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The head of each row: its rarest columns, with the column's place in the row and the sketch count."""
        width = np.uint64(sketch.WIDTH - 1)
        for part in textkit.cuts(batches):
            grams, offsets = _sets(part, n)
            sizes = np.diff(offsets)
            seen = counts.value[(grams & width).astype(np.int64)]
            heads = np.where(sizes > 0, sizes - -(-sizes * similarity.numerator // similarity.denominator) + 1, 0)
            order = np.empty(len(grams), np.int64)
            for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                order[start:stop] = start + np.argsort(seen[start:stop], kind="stable")  # grams are sorted: ties go by hash
            at = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(heads)[:-1]]), heads) + np.arange(heads.sum())
            row = np.repeat(np.arange(len(sizes)), heads)
            picked = order[at]
            yield pa.RecordBatch.from_arrays([
                pa.array(textkit.ids(grams[picked])), part.column("doc_id").take(pa.array(row)), pa.array(sizes[row].astype(np.int32)),
                pa.array((at - offsets[:-1][row]).astype(np.int32)), pa.array(seen[picked] > GATHERED)], ["h", "doc", "n", "pos", "hot"])
    return run


def _verified(n: int, similarity: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of texts that pass the exact test, by the whole rows' product."""
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                x, y = _sets(one, n, "text_a")[0], _sets(one, n, "text_b")[0]
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(both * similarity.denominator >= (len(x) + len(y) - both) * similarity.numerator)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))
    return run


def _can_follow(similarity: Fraction, na: str, nb: str, most):
    """Size-derived bound: an overlap of `most` is as large as two rows of na and nb columns need."""
    return most * (similarity.numerator + similarity.denominator) >= (F.col(na) + F.col(nb)) * similarity.numerator


def _small_enough(similarity: Fraction, na: str, nb: str, shared: str, rest: str):
    """Size-derived bounds: the sizes' ratio, and the overlap so far plus what can follow against what is asked for."""
    return ((F.least(na, nb) * similarity.denominator >= F.greatest(na, nb) * similarity.numerator)
            & _can_follow(similarity, na, nb, F.col(shared) + F.col(rest)))


def _repeated(heads: DataFrame) -> DataFrame:
    """Head entries of columns with two rows or more, each with its column's smallest row `lead`. Short columns go
    through a window; columns that may be long are folded first and joined back, so no task gathers one."""
    own = W.partitionBy("h")
    cool = (heads.where("not hot").withColumn("lead", F.min("doc").over(own)).withColumn("last", F.max("doc").over(own)))
    hot = heads.where("hot")
    ends = hot.groupBy("h").agg(F.min("doc").alias("lead"), F.max("doc").alias("last")).where("lead < last")
    return cool.where("lead < last").unionByName(hot.join(ends, "h").select(*cool.columns)).drop("hot", "last")


def links(documents: DataFrame, n: int = 5, similarity: Fraction = Fraction(3, 4)) -> tuple[DataFrame, DataFrame]:
    """(members, links). members: doc_id, n_shingles and rep, the smallest doc_id of its equal texts; links: (a, b),
    rep pairs that pass the exact test, enough of them to connect all that are connected."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    first = settle(texts.mapInArrow(_signatures(n), "doc_id long, n_shingles long, s1 long, s2 long, chunk int, counts binary"), "signatures")
    counts = spark.sparkContext.broadcast(sketch.collected(first.where("chunk is not null").select("chunk", "counts")))
    sized = first.where("chunk is null").select("doc_id", "n_shingles", "s1", "s2")
    classes = sized.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    members = settle(sized.join(classes, ["s1", "s2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep")), "members")
    reps = members.where("doc_id = rep and n_shingles > 0").select(F.col("doc_id").alias("doc")).distinct()

    heads = texts.where("doc_id is not null").mapInArrow(_heads(n, similarity, counts), "h long, doc long, n int, pos int, hot boolean")
    entries = settle(_repeated(heads).join(reps, "doc", "left_semi"), "entries")
    wanted = settle(texts.join(entries.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi"), "wanted")

    def exact(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(wanted.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        return with_b.join(wanted.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select(
            "a", "b", "text_a", "text_b").mapInArrow(_verified(n, similarity), "a long, b long").distinct()

    rep_rows = entries.select("doc", "n").distinct()
    leads = entries.where("doc <> lead").groupBy(F.col("lead").alias("a"), F.col("doc").alias("b")).agg(
        F.count("*").alias("shared"), F.max("pos").alias("pos"), F.first("n").alias("nb"))
    sizes = rep_rows.select(F.col("doc").alias("a"), F.col("n").alias("na"))
    leads = leads.join(sizes, "a").withColumn("rest", F.col("nb") - F.col("pos") - 1)
    tried = settle(leads.where(_small_enough(similarity, "na", "nb", "shared", "rest")).select("a", "b"), "tried")
    stars = settle(exact(tried), "stars")

    near = components(stars).withColumnRenamed("node", "doc")
    placed = entries.select("h", "doc", "n", "pos").join(near, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    spread = placed.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
    open_ = settle(placed.join(spread, "h", "left_semi"), "open")
    x, y = open_.alias("x"), open_.alias("y")
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.doc") < F.col("y.doc")) & (F.col("x.component") != F.col("y.component"))
                   & (F.least("x.n", "y.n") * similarity.denominator >= F.greatest("x.n", "y.n") * similarity.numerator)
                   & _can_follow(similarity, "x.n", "y.n", F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))))
    product = pairs.groupBy(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).agg(
        F.count("*").alias("shared"), F.first("x.n").alias("na"), F.first("y.n").alias("nb"),
        F.least(F.first("x.n") - F.max("x.pos"), F.first("y.n") - F.max("y.pos")).alias("rest"))
    left = product.where(_small_enough(similarity, "na", "nb", "shared", "rest")).select("a", "b").join(
        tried, ["a", "b"], "left_anti")
    return members, stars.unionByName(settle(exact(left), "others"))


def jaccard_components(documents: DataFrame, n: int = 5, similarity: Fraction = Fraction(3, 4)) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id for every row of documents; see the module for each case."""
    members, found = links(documents, n, similarity)
    copies = members.where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    groups = components(found.unionByName(copies)).withColumnRenamed("node", "doc_id")
    return members.join(groups, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.col("rep").alias("class_id"))


def representatives(documents: DataFrame, n: int = 5, similarity: Fraction = Fraction(3, 4)) -> DataFrame:
    """One row of documents, all columns, for each component: that of its smallest doc_id; of rows that share it, the least
    row. Rows whose doc_id is null, and documents without words, stay."""
    kept = jaccard_components(documents, n, similarity).where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    rows = documents.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("_kept")).drop("_kept")
    least = rows.groupBy("doc_id").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in documents.columns])).alias("_row"))
    return least.select("_row.*").unionByName(documents.where("doc_id is null"))
