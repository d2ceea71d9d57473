import random

from fixtures import awkward, documents, fold, prose
from meterloom.llm import ngram_join, topk_search
from pyspark.sql import functions as F


def shingles(text):
    w = fold(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def expected(rows):
    """Component by doc_id of all pairs."""
    sets = [(d, shingles(t)) for d, t, _ in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(d):
        return d if parent[d] == d else root(parent[d])
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: root(d) for d, _ in sets}


def check_join(spark, rows):
    got = ngram_join.jaccard_components(documents(spark, rows)).collect()
    want = expected(rows)
    assert sorted((repr(r.doc_id), r.n_shingles, r.component_id) for r in got) == sorted(
        (repr(d), len(shingles(t)), want.get(d)) for d, t, _ in rows)


def test_join_of_awkward_documents(spark):
    check_join(spark, awkward())


def test_join_of_edited_groups(spark):
    """Copies with a few to many edits, in chains, so that links lie on both sides of the bound, beside a shared passage."""
    rng, rows, number = random.Random(9), [], 100
    for group in range(6):
        words = prose(group, 90).split()
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randrange(0, 7)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((number, " ".join(own), "a"))
            number += rng.randrange(1, 5)
    passage = prose(77, 50)
    rows += [(5000 + i, prose(500 + i, 30 + i) + " " + passage, "a") for i in range(30)]
    rng.shuffle(rows)
    check_join(spark, rows)


def test_long_columns_are_folded(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GATHERED", 0)
    check_join(spark, awkward())


def test_representatives(spark):
    kept = ngram_join.representatives(documents(spark, awkward())).collect()
    want = {d for d, c in expected(awkward()).items() if d == c}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in kept) == 2 and kept[0].component == "c"


def test_join_of_nothing(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).count() == 0


def brute_top(vectors, is_query, k):
    import math
    used = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in vectors if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v)})
    out = []
    for q, a in used:
        if is_query(q):
            best = {}
            for o, b in used:
                if o != q:
                    best[o] = max(best.get(o, -10 ** 30), sum(x * y for x, y in zip(a, b)))
            out += [(q, r + 1, o, s) for r, (o, s) in enumerate(sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k])]
    return sorted(out)


def check_top(spark, vectors, k=5):
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in vectors], "vec_id long, embedding array<float>, score string, block int")
    got = sorted(map(tuple, topk_search.top_k(df, F.col("vec_id") % 5 == 0, k).collect()))
    assert got == brute_top([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 5 == 0, k)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 40)
    monkeypatch.setattr(topk_search, "BATCH", 7)
    rng = random.Random(3)
    vectors = [(i, [rng.gauss(0, 0.15) for _ in range(16)]) for i in range(150)]
    vectors += [(200 + i, vectors[10][1]) for i in range(30)]  # ties
    vectors += [(5, vectors[5][1]), (300, None), (301, [0.1, None]), (302, [float("nan")] * 16), (303, [float("inf")] * 16), (None, vectors[1][1]),
                (304, []), (305, [0.5, -0.25]), (310, [0.0] * 16)]
    # One id with more vectors than a block has places, best for many queries.
    vectors += [(77, [3.0 - j / 10] * 16) for j in range(9)] + [(96, [0.4 + j / 10] * 16) for j in range(9)]
    check_top(spark, vectors)


def test_top_k_of_few_and_none(spark):
    check_top(spark, [(0, [0.1, 0.2]), (5, [0.3, -0.2]), (7, [1e-9, 3.0])])
    check_top(spark, [(0, [0.1, 0.2])])
    check_top(spark, [])


def test_top_k_copies_no_index(spark, monkeypatch):
    """Batches meet a block's index without a join, which Spark would broadcast with a copy of every batch for every block."""
    monkeypatch.setattr(topk_search, "BLOCK", 2)  # some blocks are empty
    monkeypatch.setattr(topk_search, "BATCH", 2)
    rng = random.Random(4)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(40)]
    check_top(spark, vectors)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    plan = topk_search.top_k(df, F.col("vec_id") % 5 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_block_is_opened_once_for_its_batches():
    """One opened index serves batches of wider and narrower queries, of impacts held by all vectors of the block or by few."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(5)
    vectors = {i: [rng.randrange(-9, 9) * 10 ** (i % 3) for _ in range(6)] for i in range(30)}
    table = pa.table({"block": pa.array([0] * 30, pa.int32()), "vec_id": list(vectors), "v": list(vectors.values())})
    index = topk_search.opened(topk_search.build(table).to_pylist()[0])
    for width in (3, 6, 8):
        queries = np.array([[rng.randrange(-99, 99) for _ in range(width)] for _ in range(20)])
        got = list(zip(*map(np.ndarray.tolist, topk_search.search(index, np.arange(20), queries, 4))))
        want = []
        for q, a in enumerate(queries.tolist()):
            best = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in vectors.items() if i != q)[:4]
            want += [(q, i, -s) for s, i in best]
        assert got == want
