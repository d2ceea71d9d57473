"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word (letters, digits and non-ASCII bytes, A-Z lower-cased) stands for the mean of the embeddings of its subwords: the
byte n-grams of 3 to 5 of the word between two marks, and the word itself, hashed into BUCKETS rows. A text is the mean of
its words and of PAD empty ones, times GAIN; two linear outputs and a softmax follow. A misspelling never seen shares most
of its subwords with the word it comes from. Embeddings and outputs are trained together, by full-batch Adam steps, in one
task, on a bounded sample: of each label the SAMPLE rows that come first by a hash of doc_id. The bias is then shifted by
the ratio of both labels among all training rows over that in the sample.

Labels are learnt only from rows whose crc32(doc_id as text) mod 5 is not 0. Only texts enter a score.

Null and wordless texts have the score of the bias. Several labels of one doc_id: the highest counts; null labels don't.
A null doc_id is held out and keeps its row. Without a training row of either label every score is the share of toxic
training rows (0 if there are none). Rows that repeat are scored alike. Extra columns are ignored, or carried by `clean`."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterloom.llm import textkit

SAMPLE = {0: 12_000, 1: 4_000}
BUCKETS = 1 << 17
WIDTH = 8
GAIN = 100.0
PAD = 20
STEPS = 120
RATE = 0.1
DECAY = 3e-6
_MARK = np.uint8(1)


def _reduce(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of each row of values; a row may be empty."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def subwords(parsed: textkit.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the subwords of the words numbered `which`, in order, and the offsets of each word's."""
    lengths = parsed.ends[which] - parsed.starts[which]
    marked = np.concatenate([[0], np.cumsum(lengths + 2)])
    data = np.full(marked[-1], _MARK, np.uint8)
    inside = np.repeat(marked[:-1] + 1 - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    data[inside] = parsed.data[np.repeat(parsed.starts[which] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())]
    owner = np.repeat(np.arange(len(which)), lengths + 2)
    left = marked[1:][owner] - np.arange(len(data))
    codes, owners = [], []
    for n in (3, 4, 5):
        at = np.flatnonzero(left >= n)
        own = np.zeros(len(at), np.uint64)
        for j in range(n):
            own = own * np.uint64(257) + data[at + j].astype(np.uint64)
        codes.append(textkit.mix(own + np.uint64(n << 48)))
        owners.append(owner[at])
    codes.append(textkit.mix(textkit.Words(parsed.data, parsed.starts[which], parsed.ends[which], np.zeros(1, np.int64)).hashes()))
    owners.append(np.arange(len(which)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return ((np.concatenate(codes)[order] & np.uint64(BUCKETS - 1)).astype(np.int64),
            np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(which)))]))


def fit(texts: list[bytes], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """The trained model as it scores: what each bucket adds to the toxic output over the other, and the bias. The outputs
    of a softmax of two count by their difference alone, so they are kept as one vector."""
    rng = np.random.default_rng(5)
    known: dict[int, int] = {}
    buckets, widths, doc_words, doc_counts, sizes, lengths = [], [], [], [], [], []
    for start in range(0, len(texts), 500):
        parsed = textkit.words(pa.array(texts[start:start + 500], pa.binary()), textkit.ALNUM)
        values, first, inverse = np.unique(parsed.hashes(), return_index=True, return_inverse=True)
        fresh = np.array([i for i, h in enumerate(values.tolist()) if h not in known], np.int64)
        own, offsets = subwords(parsed, first[fresh])
        buckets.append(own.astype(np.int32))
        widths.append(np.diff(offsets))
        known.update(zip(values[fresh].tolist(), range(len(known), len(known) + len(fresh))))
        number = np.array([known[h] for h in values.tolist()], np.int32)[inverse]
        for a, b in zip(parsed.rows[:-1].tolist(), parsed.rows[1:].tolist()):
            word, count = np.unique(number[a:b], return_counts=True)
            doc_words.append(word)
            doc_counts.append(count.astype(np.float32))
            sizes.append(len(word))
            lengths.append(b - a)
    words, doc_of = np.concatenate(doc_words), np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    weights = (np.concatenate(doc_counts) * (GAIN / (np.array(lengths, np.float32) + PAD))[doc_of]).astype(np.float32)
    widths, sub = np.concatenate(widths), np.concatenate(buckets)
    told = np.bincount(words, minlength=len(widths)) >= 2  # a word of one sampled text tells nothing of others
    sub, widths, number = sub[np.repeat(told, widths)], widths[told], (np.cumsum(told) - 1).astype(np.int32)
    words, weights, doc_of = number[words[told[words]]], weights[told[words]], doc_of[told[words]]
    word_at, each = np.cumsum(widths) - widths, np.repeat((1.0 / widths).astype(np.float32), widths)
    doc_at = np.searchsorted(doc_of, np.arange(len(texts) + 1))
    del buckets, doc_words, doc_counts, known

    embedding, output, bias = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32), rng.normal(0, 0.5, WIDTH).astype(np.float32), np.zeros(1)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (embedding, output, bias)]
    for step in range(1, STEPS + 1):
        # Both averages are linear, so they are taken of each bucket's output instead of its embedding.
        parts = (embedding @ output)[sub]
        parts *= each
        parts = (np.add.reduceat(parts, word_at) if len(parts) else parts)[words]
        parts *= weights
        score = _reduce(parts, doc_at) + bias
        wrong = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - toxic) / len(texts)
        parts = wrong.astype(np.float32)[doc_of]
        parts *= weights
        parts = np.repeat(np.bincount(words, parts, minlength=len(widths)).astype(np.float32), widths)
        parts *= each
        back = np.bincount(sub, parts, minlength=BUCKETS).astype(np.float32)
        grads = [back[:, None] * output + DECAY * embedding, embedding.T @ back + DECAY * output, wrong.sum(keepdims=True)]
        for value, grad, (m, v) in zip((embedding, output, bias), grads, moments):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)).astype(value.dtype)
    return (embedding @ output).astype(np.float32), float(bias[0])


class Scorer:
    """Scores texts with a model; what a word adds is computed once per task, for as many words as KEPT."""
    KEPT = 500_000

    def __init__(self, model: dict):
        self.given, self.bias, self.fixed = model["given"], model["bias"], model["fixed"]
        self.known: dict[int, float] = {}

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(texts), self.fixed)
        parsed = textkit.words(texts, textkit.ALNUM)
        counts = np.diff(parsed.rows)
        values, first, inverse = np.unique(parsed.hashes(), return_index=True, return_inverse=True)
        adds = np.array([self.known.get(h, np.nan) for h in values.tolist()], np.float64)
        fresh = np.flatnonzero(np.isnan(adds))
        if len(fresh):
            sub, offsets = subwords(parsed, first[fresh])
            adds[fresh] = _reduce(self.given[sub].astype(np.float64), offsets) / np.diff(offsets)
            if len(self.known) > self.KEPT:
                self.known.clear()
            self.known.update(zip(values[fresh].tolist(), adds[fresh].tolist()))
        total = _reduce(adds[inverse], parsed.rows) * (GAIN / (counts + PAD))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -500, 500)))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def train(documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> dict:
    """The model: BUCKETS numbers and a bias."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(known, "doc_id")
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad or not good:
        return {"given": None, "bias": 0.0, "fixed": float(bad > 0)}
    chosen = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample[t]) for t in (0, 1)]
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("doc_id", "toxic", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(d, t, x or b"") for b in batches for d, t, x in zip(*(b.column(i).to_pylist() for i in range(3)))]
        got.sort()
        given, bias = fit([x for _, _, x in got], np.array([t for _, t, _ in got]))
        yield pa.RecordBatch.from_arrays([pa.array([given.tobytes()], pa.binary()), pa.array([bias])], ["given", "bias"])

    given, bias = rows.repartition(1).mapInArrow(run, "given binary, bias double").first()
    shift = np.log(bad / good) - np.log(min(bad, sample[1]) / min(good, sample[0]))
    return {"given": np.frombuffer(given, np.float32), "bias": bias + float(shift), "fixed": None}


def scores(documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of documents; see the module for each case."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for part in textkit.cuts(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scorer.scores(part.column("text")))], ["doc_id", "score"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> DataFrame:
    """The rows of documents, all columns, that score under 0.5."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for part in textkit.cuts(batches):
            yield part.filter(pa.array(scorer.scores(part.column("text").cast(pa.binary())) < 0.5))

    return documents.mapInArrow(run, documents.schema)
