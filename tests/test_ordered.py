"""Ordered operators cut into chunks, against straight windows and brute force on skewed keys."""

import random
import statistics

import pytest
from pyspark.sql import Window as W, functions as F

from meterloom.operators.chunks import asof, balanced_chunks, counts_between, id_chunk, running
from meterloom.operators.dedup import mark_repeats
from meterloom.operators.quantiles import exact_median, nearest_rank, upper_median
from meterloom.operators.windows import no_window_runs


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, some have none; values repeat and are sometimes missing."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]), rng.choice([None, 1, 2, 3, 5]), rng.randrange(400)) for i in range(900)]
    return spark.createDataFrame(rows, "id long, key string, v int, t long").cache()


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_running_equals_plain_windows(skewed, rows, size):
    order = W.partitionBy("key").orderBy("id")
    upto, before = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    specs = {"p": ("previous", F.col("v")), "l": ("last_known", F.col("v")), "k": ("known_before", F.col("v")),
             "m": ("max_before", F.col("v")), "s": ("sum_through", F.col("v")), "b": ("sum_before", F.col("v"))}
    got = running(skewed, ["key"], [F.col("id")], specs, id_chunk(F.col("id"), size))
    want = skewed.select("*", F.lag("v").over(order).alias("p"), F.last("v", True).over(upto).alias("l"), F.last("v", True).over(before).alias("k"),
                         F.max("v").over(before).alias("m"), F.sum("v").over(upto).alias("s"), F.sum("v").over(before).alias("b"))
    assert rows(got) == rows(want)


def test_balanced_chunks_split_the_hot_key(skewed, rows):
    cut = balanced_chunks(skewed, [F.col("key"), F.col("t"), F.col("id")], parts=6)
    got = running(cut, ["key"], [F.col("t"), F.col("id")], {"p": ("previous", F.col("v"))}, F.col("_chunk"))
    want = skewed.withColumn("p", F.lag("v").over(W.partitionBy("key").orderBy("t", "id")))
    assert rows(got, "id", "p") == rows(want, "id", "p")
    assert cut.where("key = 'hot'").select("_chunk").distinct().count() > 1


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("equal", [False, True])
@pytest.mark.parametrize("balanced", [False, True])
def test_asof_against_brute_force(spark, skewed, rows, forward, equal, balanced):
    left = skewed.where("id % 2 = 0").select("id", "key", "t")
    right = skewed.where("id % 5 = 0 AND key IS NOT NULL").select("key", F.col("t").alias("at"))
    got = asof(left, right, "t", "at", ["at"], "hit", keys=["key"], forward=forward, equal=equal, span=13, balanced=balanced)
    pairs = [(r.key, r["at"]) for r in right.collect()]

    def nearest(key, t):
        fit = [a for k, a in pairs if k == key and ((a >= t if equal else a > t) if forward else (a <= t if equal else a < t))]
        return (min(fit) if forward else max(fit)) if fit else None
    assert {r.id: r.at for r in got.select("id", "hit.at").collect()} == {r.id: nearest(r.key, r.t) for r in left.collect()}


def test_counts_between(spark, skewed, rows):
    bounds = spark.createDataFrame([(i, i * 9, i * 9 + i) for i in range(-2, 40)], "i long, lo long, hi long")
    got = counts_between(bounds, ["i"], {"every": (skewed, "t", F.col("lo"), F.col("hi")), "hot": (skewed.where("key = 'hot'"), "t", F.col("lo"), F.col("hi") - 3)}, span=17)
    data = [(r.key, r.t) for r in skewed.collect()]
    for r in got.collect():
        assert r.every == sum(r.lo <= t < r.hi for _, t in data)
        assert r.hot == max(0, sum(r.lo <= t < r.hi - 3 for k, t in data if k == "hot")) or r.hi - 3 <= r.lo


def test_medians(skewed, rows):
    got = {r.key: (r.median, r.n) for r in exact_median(skewed, ["key"], "t").collect()}
    by_key = {}
    for r in skewed.collect():
        by_key.setdefault(r.key, []).append(r.t)
    assert got == {k: (statistics.median(v), len(v)) for k, v in by_key.items()}
    marks = {r.key: (r.mid, r.high) for r in nearest_rank(skewed, ["key"], F.col("t"), {"mid": 0.5, "high": 0.9}).collect()}
    assert marks == {k: (sorted(v)[round(0.5 * (len(v) - 1))], sorted(v)[round(0.9 * (len(v) - 1))]) for k, v in by_key.items()}
    upper = {r.key: r.u for r in upper_median(skewed, ["key"], F.col("t"), "u").collect()}
    assert upper == {k: sorted(v)[len(v) // 2] for k, v in by_key.items()}


def test_repeats_pass_over_copies(spark, rows):
    df = spark.createDataFrame([(1, "s", 1, False), (2, "s", 2, False), (3, "s", 1, True), (4, "s", 2, False), (5, "s", None, False), (6, "s", None, False)],
                               "ingest_id long, s string, v int, copy boolean")
    got = mark_repeats(df, ["s"], [F.col("v")], copy=F.col("copy"))
    assert rows(got.where("redundant"), "ingest_id") == [(4,), (6,)]
    held = spark.createDataFrame([("s", (1,))], "s string, last_values struct<f0: int>")
    assert rows(mark_repeats(df, ["s"], [F.col("v")], stored=held, copy=F.col("copy")).where("redundant"), "ingest_id") == [(1,), (4,), (6,)]


def test_no_window_runs(spark, rows):
    data = [(i, ts, "claude_api", end) for i, (ts, end) in enumerate([(1, None), (2, 9), (3, None), (4, None), (5, 9), (6, None), (7, 9), (8, None), (9, None)])]
    read = spark.createDataFrame(data, "ingest_id long, ts long, source string, end_7d long")
    assert rows(no_window_runs(read)) == [(1, 2, 1, True), (3, 5, 2, False), (6, 7, 1, True), (8, 8, 2, False)]


def test_rows_are_numbered_where_they_were_written(spark):
    """No window over the rows: only one row per file is added up."""
    from meterloom.plans.jobs import in_order
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("ts"), F.col("id").cast("string").alias("v")).repartition(7)
    got = in_order(rows, 40, ["ts", "v"])
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r.ts, r.ingest_id) for r in got.orderBy("ts").collect()] == [(n, 41 + n) for n in range(1000)]
    assert in_order(rows.limit(0), 5, ["ts"]).count() == 0
