import random

import numpy as np
import pyarrow as pa

from fixtures import awkward, fold
from meterloom.llm import textkit
from meterloom.llm.components import components
from meterloom.llm.running import running
from pyspark.sql import functions as F


def texts():
    return [None if t is None else t.encode() for _, t, _ in awkward()]


def test_words_are_those_of_split():
    parsed = textkit.words(pa.array(texts(), pa.binary()))
    for i, t in enumerate(texts()):
        assert [parsed.word(j) for j in range(parsed.rows[i], parsed.rows[i + 1])] == fold(t.decode() if t else "")


def test_equal_words_and_windows_have_equal_hashes_only():
    parsed = textkit.words(pa.array(texts(), pa.binary()))
    hashes = parsed.hashes()
    by_word, by_hash = {}, {}
    for i, h in enumerate(hashes.tolist()):
        assert by_word.setdefault(parsed.word(i), h) == h
        assert by_hash.setdefault(h, parsed.word(i)) == parsed.word(i)
    found, offsets = textkit.windows(hashes, parsed.rows, 5)
    seen = {}
    for i, t in enumerate(texts()):
        w = fold(t.decode() if t else "")
        grams = [tuple(w[j:j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        assert len(grams) == offsets[i + 1] - offsets[i]
        for gram, h in zip(grams, found[offsets[i]:offsets[i + 1]].tolist()):
            assert seen.setdefault(gram, h) == h
    assert len(set(seen.values())) == len(seen)


def test_cuts_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts()))), pa.array(texts(), pa.binary())], ["i", "text"])
    parts = list(textkit.cuts(iter([batch]), limit=500))
    assert len(parts) > 3 and [i for p in parts for i in p.column("i").to_pylist()] == list(range(len(texts())))


def test_distinct_per_row():
    values, offsets = textkit.distinct_per_row(np.array([3, 1, 3, 2, 2], np.uint64), np.array([0, 3, 3, 5, 5]))
    assert values.tolist() == [1, 3, 2] and offsets.tolist() == [0, 2, 2, 3, 3]


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(4)
    ids = rng.sample(range(1000), 60)
    links = [*zip(ids[:20], ids[1:20]), *((ids[20], i) for i in ids[21:40]), *zip(ids[40:50], ids[41:50] + ids[40:41]), (ids[55], ids[55])]
    parent = {i: i for i in ids}

    def root(i):
        return i if parent[i] == i else root(parent[i])
    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: root(i) for i in ids[:50]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_sums(spark):
    rows = [(f"k{i % 3}", i * 7 % 100, i % 5) for i in range(100)]
    got = running(spark.createDataFrame(rows, "k string, o int, n long"), [F.col("o")], "n", ["k"]).collect()
    assert len(got) == 100
    for r in got:
        assert r.n_before == sum(n for k, o, n in rows if k == r.k and o < r.o)
