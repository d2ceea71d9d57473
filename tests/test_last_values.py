"""The last value per key beside a store, against the store itself."""

import random

from pyspark.sql import functions as F

from meterloom.sinks import last_values
from meterloom.sinks.last_values import LastValues
from meterloom.sources.tables import stored

SCHEMA = "ingest_id LONG, s STRING, v STRING, kind STRING"


def table(spark, tmp_path):
    return LastValues(spark, str(tmp_path / "last"), ["s"], F.struct(F.col("v").alias("f0")), F.col("kind") == "push")


def batch(spark, seed, first, n=200, sessions=40):
    rng = random.Random(seed)
    return spark.createDataFrame([(first + i, f"s{rng.randrange(sessions)}", rng.choice(["a", "b", None]), rng.choice(["push", "poll"]))
                                  for i in range(n)], SCHEMA)


def expected(rows, keys):
    best = {}
    for r in rows:
        if r.kind == "push" and r.s in keys and r.ingest_id >= best.get(r.s, (-1, None))[0]:
            best[r.s] = (r.ingest_id, r.v)
    return {k: v for k, (_, v) in best.items()}


def asked(lasts, batch_, store):
    return {r.s: r.last_values.f0 for r in lasts.read(batch_, store).collect()}


def test_equals_the_store_batch_by_batch(spark, tmp_path):
    path, lasts = str(tmp_path / "store"), table(spark, tmp_path)
    for n in range(5):
        new = batch(spark, n, n * 1000)
        store = stored(spark, path, SCHEMA)
        keys = {r.s for r in new.collect()}
        assert asked(lasts, new, store) == expected(store.collect(), keys)
        new.write.mode("append").parquet(path)
        if n != 2:  # a crash between the append and the merge: the store's newer rows are folded in
            lasts.merge(stored(spark, path, SCHEMA), new)
    store = stored(spark, path, SCHEMA)
    version = lasts.commit()[0]
    assert version == 4 and asked(lasts, store, store) == expected(store.collect(), {f"s{i}" for i in range(40)})
    lasts.merge(store, store.limit(0))  # a batch that adds nothing changes nothing
    assert lasts.commit()[0] == version
    late = spark.createDataFrame([(5, "late", "x", "push")], SCHEMA)  # a number below those merged
    late.write.mode("append").parquet(path)
    lasts.merge(stored(spark, path, SCHEMA), late)
    assert asked(lasts, late, stored(spark, path, SCHEMA)) == {"late": "x"}


def test_reads_only_the_buckets_of_the_batch(spark, tmp_path):
    path, lasts = str(tmp_path / "store"), table(spark, tmp_path)
    batch(spark, 1, 0, 3000, 2000).write.parquet(path)
    store = stored(spark, path, SCHEMA)
    lasts.merge(store, store.limit(0))
    few = spark.createDataFrame([(9999, "s1", "a", "push"), (10000, "s2", "a", "push")], SCHEMA)
    wanted = {r.b for r in few.select(lasts.bucket().alias("b")).collect()}
    got = lasts.read(few, store)
    opened = {f.split("/bucket=")[1].split("/")[0] for f in got.inputFiles() if "/bucket=" in f}
    assert opened == {str(b) for b in wanted} and len(wanted) < last_values.BUCKETS
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThan(ingest_id,2999)" in plan  # of the store nothing but what is newer


def test_an_unfinished_version_is_overwritten(spark, tmp_path):
    path, lasts = str(tmp_path / "store"), table(spark, tmp_path)
    batch(spark, 1, 0).write.parquet(path)
    store = stored(spark, path, SCHEMA)
    spark.createDataFrame([("s1", 7, ("wrong",), 3)], "s STRING, at LONG, last_values STRUCT<f0: STRING>, bucket INT").write.partitionBy(
        "bucket").parquet(f"{lasts.path}/data/version=1")
    lasts.merge(store, store.limit(0))
    assert asked(lasts, store, store) == expected(store.collect(), {f"s{i}" for i in range(40)})
