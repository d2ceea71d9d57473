"""Filters per file: what is opened for a batch of ids, that none is missed, and the same at every size."""

import pytest

from meterloom.sinks import known_ids
from meterloom.sinks.known_ids import KnownIds

SCHEMA = "ingest_id LONG, id STRING"


def store(spark, tmp_path, files=12, per_file=3000):
    path = str(tmp_path / "a store")
    for n in range(files):
        spark.createDataFrame([(n * per_file + i, f"f{n}-{i}") for i in range(per_file)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return KnownIds(spark, path, SCHEMA, "id")


def ids(spark, values):
    return spark.createDataFrame([(0, v) for v in values], SCHEMA)


def test_new_ids_open_no_old_file(spark, tmp_path):
    known = store(spark, tmp_path)
    assert known.highest() == 35_999 and len(known.candidates(ids(spark, ["x"]))) == 12  # no filters yet: all are read
    known.update()
    opened = known.candidates(ids(spark, [f"new-{i}" for i in range(1000)]))
    assert len(opened) <= 2  # an id is a false positive in a file less than once in 100,000 times
    assert known.candidates(ids(spark, ["f3-0"])) != [] and known.filtered() == known.files()
    assert known.candidates(ids(spark, [])) == [] and known.holding(ids(spark, [])).count() == 0
    assert known.highest() == 35_999


def test_no_file_is_missed(spark, tmp_path):
    known = store(spark, tmp_path, files=4, per_file=700)
    known.update()
    spark.createDataFrame([(9000, "late"), (9001, None)], SCHEMA).coalesce(1).write.mode("append").parquet(known.store)
    found = known.holding(ids(spark, ["f0-1", "f0-699", "f3-5", None]))
    assert {"f0-1", "f0-699", "f3-5", "late"} <= {r.id for r in found.collect()}  # the file without a filter is read too
    assert known.highest() == 9001
    known.update()
    for n in range(4):
        for some in (0, 350, 699):
            assert known.holding(ids(spark, [f"f{n}-{some}"])).where(f"id = 'f{n}-{some}'").count() == 1


@pytest.mark.parametrize("most", [0, 100])
def test_a_large_batch_reads_the_store(spark, tmp_path, monkeypatch, most):
    known = store(spark, tmp_path, files=3, per_file=50)
    known.update()
    monkeypatch.setattr(known_ids, "MOST", most)
    assert known.holding(ids(spark, ["f1-7"])).where("id = 'f1-7'").count() == 1
    assert len(known.candidates(ids(spark, ["f1-7"]))) == (3 if most == 0 else 1)


def test_an_id_is_sorted_once_for_all_its_bits(spark, tmp_path):
    """Bits are taken apart above the aggregate that builds them, not below it; and they are those of every id."""
    known = store(spark, tmp_path, files=2, per_file=2500)
    got = known.filters_of(sorted(known.files()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("bitmap_or_agg") < plan.index("Generate explode") < plan.index("bitmap_construct_agg") and plan.count("Generate") == 1
    wanted = set()
    asked = known._open(sorted(known.files())).select(
        "id", known_ids._segment(known_ids.F.col("id"), known_ids.F.lit(4)).alias("segment"), known_ids._positions(known_ids.F.col("id")).alias("bits"))
    for r in asked.collect():
        wanted |= {(r["id"].split("-")[0], r["segment"], bit) for bit in r["bits"]}
    held, tops = set(), set()
    for r in got.collect():
        assert r["segments"] == 4
        tops.add(r["top"])
        name = "f0" if r["top"] == 2499 else "f1"
        held |= {(name, r["segment"], 8 * i + b) for i, byte in enumerate(r["bits"]) for b in range(8) if byte >> b & 1}
    assert held == wanted and tops == {2499, 4999}


def test_ids_that_are_null_repeat_or_all_miss_a_file(spark, tmp_path):
    path = str(tmp_path / "odd")
    spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], SCHEMA).coalesce(1).write.parquet(path)
    known = KnownIds(spark, path, SCHEMA, "id")
    known.update()
    known.update()
    assert known.highest() == 4 and len(known.candidates(ids(spark, ["a", None]))) == 1 and known.candidates(ids(spark, ["b"])) == []
