"""Stores compared by digests, beside the full join."""

import random
import re

import pytest

from meterloom.operators import digests, reconcile

SCHEMA = "request_id string, dt string, machine string, a long, b long"
VALUES = ["a", "b"]


def store(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def facts(n, seed=1):
    rng = random.Random(seed)
    return [(f"r{i}", f"2024-01-0{1 + i % 3}", "hot" if rng.random() < 0.4 else rng.choice(["m1", None]), rng.randrange(9), rng.choice([None, 5, 2 ** 62])) for i in range(n)]


def changed(rows, seed):
    """Some rows gone, some with other values, some on another day, some new."""
    rng, out = random.Random(seed), []
    for key, dt, machine, a, b in rows:
        luck = rng.random()
        if luck < 0.9:
            out.append((key, dt, machine, a, b))
        elif luck < 0.94:
            out.append((key, dt, machine, b, a))
        elif luck < 0.97:
            out.append((key, "2024-02-01", machine, a, b))
    return out + [(f"new{i}", "2024-01-01", "m1", 1, None) for i in range(5)]


@pytest.mark.parametrize("group", [(), ("dt", "machine")])
def test_digests_find_what_the_join_finds(spark, group):
    rows = facts(600)
    old, new = store(spark, rows), store(spark, changed(rows, 4))
    want = reconcile.fact_counts(reconcile.compare_facts(old, new, VALUES)).first()
    got = digests.compare_stores(old, new, VALUES, group=group).first()
    assert tuple(got) == tuple(want) and got.missing > 5 and got.different > 5
    want = reconcile.missing_from(old, new, "request_id").collect()
    assert sorted(map(repr, digests.missing(old, new, "request_id", group).collect())) == sorted(map(repr, want))


def test_equal_stores_leave_no_rows_and_one_change_one_bucket(spark):
    rows = facts(2_000)
    old, shuffled = store(spark, rows), store(spark, random.Random(2).sample(rows, len(rows)))
    a, b, total = digests.narrowed(old, shuffled, VALUES, "request_id")
    assert (a.count(), b.count(), total) == (0, 0, 2_000)
    rows[77] = (*rows[77][:4], 6)
    a, b, _ = digests.narrowed(old, store(spark, rows), VALUES, "request_id")
    assert "r77" in {r.request_id for r in a.collect()} and a.count() == b.count() <= 3
    assert tuple(digests.compare_stores(old, store(spark, rows), VALUES).first()) == (2_000, 0, 1)


def test_swapped_nulls_and_repeats_are_seen(spark):
    old = store(spark, [("x", None, None, None, 5), ("y", None, None, 1, 1), ("y", None, None, 1, 1)])
    new = store(spark, [("x", None, None, 5, None), ("y", None, None, 1, 1)])
    a, b, _ = digests.narrowed(old, new, VALUES, "request_id", ("dt",))
    assert sorted(r.request_id for r in a.collect()) == ["x", "y", "y"] and sorted(r.request_id for r in b.collect()) == ["x", "y"]


def test_empty_stores(spark):
    none, some = store(spark, []), store(spark, facts(20))
    assert tuple(digests.compare_stores(none, none, VALUES).first()) == (0, 0, 0)
    assert tuple(digests.compare_stores(some, none, VALUES).first()) == (20, 20, 0)
    assert tuple(digests.compare_stores(none, some, VALUES).first()) == (0, 0, 0)


def test_a_partition_filter_reaches_the_second_scan(spark, tmp_path):
    """Rows of days that don't differ are not compared: the files are partitioned by day."""
    rows = facts(300)
    for name, own in (("old", rows), ("new", [r for r in rows if r[0] != "r3"])):
        store(spark, own).write.partitionBy("dt").parquet(str(tmp_path / name))
    old, new = (spark.read.schema(SCHEMA).parquet(str(tmp_path / n)) for n in ("old", "new"))
    a, b, _ = digests.narrowed(old, new, VALUES, "request_id", ("dt",))
    assert {r.dt for r in a.collect()} == {"2024-01-01"}
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-01", a._jdf.queryExecution().executedPlan().toString())
