"""Exact ranks beside sorted lists: hot keys, ties, wide ranges, NULL keys."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from meterloom.operators import quantiles


def groups(seed):
    rng = random.Random(seed)
    return {"hot": [rng.gauss(0, 1e6) for _ in range(4000)], "ties": [rng.choice([1.5, 2.5, 2.5, 9.0]) for _ in range(300)], "one": [7.0],
            "two": [-3.0, 4.0], "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-12, 12) for _ in range(30)],
            "edge": [1.7e308, -1.7e308, 0.0], "next": [1.0, 1.0000000000000002, 1.0000000000000004], None: [float(i) for i in range(50)],
            "zero": [0.0, -0.0, 0.0]}


def table(spark, made):
    rows = [(k, v, 1) for k, vs in made.items() for v in vs] + [("hot", None, 1), ("none", None, 1)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double, name int")


def test_ranks_equal_sorted_lists(spark, monkeypatch):
    for bins, made in ((4096, groups(3)), (16, {k: v for k, v in groups(4).items() if k not in ("edge", "wide")})):
        monkeypatch.setattr(quantiles, "BINS", bins)
        got = quantiles.nearest_rank(table(spark, made), ["k"], F.col("v"), {"p10": 0.1, "p50": 0.5, "p90": 0.9}).collect()
        assert {r.k: (r.n, r.p10, r.p50, r.p90) for r in got} == {
            k: (len(v), *[sorted(v)[round(f * (len(v) - 1))] for f in (0.1, 0.5, 0.9)]) for k, v in made.items()}


def test_medians(spark):
    made = {k: v for k, v in groups(5).items() if k not in ("edge", "wide")}
    df = table(spark, made)
    got = {r.k: (r.median, r.n) for r in quantiles.exact_median(df, ["k"], "v").collect()}
    assert got == {k: (pytest.approx(statistics.median(v), rel=1e-15), len(v)) for k, v in made.items()}
    assert {r.k: r.m for r in quantiles.upper_median(df, ["k"], F.col("v"), "m").collect()} == {k: sorted(v)[len(v) // 2] for k, v in made.items()}
    every = sorted(x for v in made.values() for x in v)
    assert quantiles.exact_median(df, [], "v").first().median == pytest.approx(statistics.median(every))
    assert quantiles.exact_median(df.limit(0), ["k"], "v").count() == 0
