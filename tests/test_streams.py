"""Streams: slots in append mode, repeats, two-stream cost join, replication, merging, staleness."""

import json

import pytest
from pyspark.sql import functions as F

from meterloom import schemas
from meterloom.operators.quality import staleness
from meterloom.sinks import gates
from meterloom.sources.tables import stored
from meterloom.streaming import exchange
from meterloom.streaming.repeats import ROCKSDB, drop_repeats
from meterloom.streaming.slots import dropped_late, slots_stream, with_costs
from meterloom.streaming.transcripts import ingest_requests

REQUEST = ("at timestamp, machine string, folder string, entrypoint string, model string, input_tokens long, output_tokens long, cache_read_tokens long, "
           "cache_write_5m_tokens long, cache_write_1h_tokens long, cache_write_unknown_tokens long, cost_usd double")


def drain(spark, stream, out, progress):
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_slots_close_once_and_late_requests_are_counted(spark, rows, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def land(*stamps):
        data = [(t, "m", None, "cli", "x", 1, 2, 3, 0, 0, 0, 0.5 if t % 2 == 0 else None) for t in stamps]
        df = spark.createDataFrame(data, REQUEST.replace("at timestamp", "at long"))
        df.withColumn("at", F.timestamp_seconds("at")).coalesce(1).write.mode("append").parquet(source)
    land(1000, 1001, 1300)
    stream = lambda: slots_stream(spark.readStream.schema(REQUEST).parquet(source))
    drain(spark, stream(), out, progress)
    land(2500)                  # 15 minutes past 1600: the slots 900 and 1200 are final
    drain(spark, stream(), out, progress)
    got = lambda: rows(spark.read.parquet(out), "ts", "folder", "requests", "input_tokens", "usd", "tokens_without_usd")
    first = [(1200, "", 1, 1, 0.5, 0), (900, "", 2, 2, 0.5, 6)]
    assert got() == first
    land(1010, 4000)            # 1010 is late: its slot is written and stays as it is
    q = drain(spark, stream(), out, progress)
    assert dropped_late(q) == 1
    assert got() == sorted([*first, (2400, "", 1, 1, 0.5, 0)], key=repr)


def test_repeats_across_batches(spark, rows, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "ingest_id long, session string, pct double, reset long"
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        for batch in ([(3, "s", 2.0, None), (1, "s", 1.0, None), (2, "s", 1.0, None)], [(4, "s", 2.0, None), (5, "s", 2.0, 7), (6, "t", 2.0, None)]):
            spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
            drain(spark, drop_repeats(spark.readStream.schema(schema).parquet(source), ["session"], ["pct", "reset"]), out, progress)
    finally:
        for k in ROCKSDB:
            spark.conf.unset(k)
    assert rows(spark.read.parquet(out), "ingest_id") == [(1,), (3,), (5,), (6,)]


def test_costs_join_two_streams(spark, rows, tmp_path):
    a, b, out, progress = (str(tmp_path / n) for n in ("a", "b", "out", "progress"))
    def land(path, data, schema):
        df = spark.createDataFrame(data, schema)
        df.withColumn(df.columns[1], F.timestamp_seconds(df.columns[1])).coalesce(1).write.mode("append").parquet(path)
    land(a, [("r1", 1000), ("r2", 1010)], "request_id string, at long")
    land(b, [("r1", 1005, 0.5), ("r1", 1006, 0.5)], "request_id string, reported_at long, cost_usd double")
    def run():
        joined = with_costs(spark.readStream.schema("request_id string, at timestamp").parquet(a),
                            spark.readStream.schema("request_id string, reported_at timestamp, cost_usd double").parquet(b))
        drain(spark, joined, out, progress)
    run()
    land(a, [("r9", 9000)], "request_id string, at long")
    land(b, [("r8", 9000, 1.0)], "request_id string, reported_at long, cost_usd double")
    run()
    run()
    assert rows(spark.read.parquet(out).where("request_id <> 'r9'"), "request_id", "cost_usd") == [("r1", 0.5), ("r2", None)]


def slot(ts, machine="m1"):
    return (ts, f"1970-01-01T00:{ts // 60:02d}:00Z", machine, "/a", "cli", "m", 1, 1, 2, 3, 0, 0, 0, 0.5, 0, 1)


def test_replication_sends_each_slot_once(spark, rows, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("source", "target", "progress"))
    add = lambda *s: spark.createDataFrame(list(s), schemas.SLOTS).write.mode("append").parquet(source)
    send = lambda: exchange.replicate_slots(spark, source, target, progress, "m1")
    there = lambda: rows(stored(spark, target, schemas.SLOTS), "ts", "machine")
    add(slot(300), slot(600), slot(900), slot(300, "m2"))
    send()
    send()
    assert there() == [(300, "m1"), (600, "m1"), (900, "m1")]
    add(slot(1200))
    send()
    assert len(there()) == 4
    add(slot(1500), slot(1501))
    with pytest.raises(Exception):
        send()                   # one bad slot: nothing of the batch is stored, and it stays to be sent
    assert len(there()) == 4


def test_pages_and_their_watermark(spark, tmp_path):
    table = spark.createDataFrame([(i, i, "x", "claude_api", 1.0, None, None, None, None, i, "{}", str(i), "m1" if i % 2 else "m2") for i in range(1, 10)],
                                  schemas.ACCOUNT_QUOTAS)
    seen = []
    collect = lambda page: seen.extend(r.ingest_id for r in page.collect())
    mark = exchange.send(table, 0, "m1", collect, limit=3)
    assert (seen, mark) == ([1, 3, 5], 5)
    mark = exchange.send(table, mark, "m1", collect, limit=3)
    assert (seen, mark) == ([1, 3, 5, 7, 9], 9)

    def down(page):
        raise RuntimeError("link down")
    with pytest.raises(RuntimeError):
        exchange.send(table, 5, "m1", down)


def test_two_way_merge_echoes_nothing(spark, rows):
    schema = "row_hash string, machine string"
    a = spark.createDataFrame([("h1", "a"), ("h2", "a"), ("h9", "b")], schema)
    b = spark.createDataFrame([("h2", "a"), ("h3", "b"), ("h9", "b")], schema)
    to_a, to_b = exchange.merge_both_ways(a, b, "a", "b")
    assert (rows(to_a), rows(to_b)) == ([("h3", "b")], [("h1", "a")])
    a, b = a.unionByName(to_a), b.unionByName(to_b)
    assert [d.count() for d in exchange.merge_both_ways(a, b, "a", "b")] == [0, 0]


def test_readings_stream_through_the_gate(spark, rows, tmp_path):
    source, path, errors, progress = (str(tmp_path / n) for n in ("in", "account", "errors", "progress"))
    def push(i, ts, pct):
        return (json.dumps({"ts": ts, "source": "claude_statusline", "observed_at": 5, "five_hour_pct": pct, "observed_by_session": "s"}), i)
    for batch in ([push(1, 1, 1), push(2, 2, 1)], [push(3, 3, 1), push(4, 4, 2)]):
        spark.createDataFrame(batch, "value string, ingest_id long").write.mode("append").parquet(source)
        exchange.ingest_readings(spark, source, path, errors, "claude", progress)
    assert rows(stored(spark, path, schemas.ACCOUNT_QUOTAS), "ingest_id", "five_hour_pct") == [(1, 1.0), (4, 2.0)]


def test_transcript_segments_are_read_once(spark, rows, tmp_path):
    folder, paths = tmp_path / "logs", {n: str(tmp_path / n) for n in ("requests", "scans", "pending", "progress")}
    folder.mkdir()
    t0 = 1791460800
    def land(name, *entries):
        text = [json.dumps({"type": "assistant", "timestamp": f"2026-10-08T12:{m:02d}:{s:02d}.000Z", "requestId": rid, "sessionId": "s", "message": {
            "model": "m", "usage": {"input_tokens": 1, "output_tokens": out}}}) for m, s, rid, out in entries]
        (folder / name).write_text("\n".join(text) + "\n")
    run = lambda now: ingest_requests(spark, str(folder), paths["requests"], paths["scans"], paths["pending"], paths["progress"], now)
    held = lambda: rows(stored(spark, paths["requests"], schemas.REQUESTS), "ingest_id", "request_id", "ts", "output_tokens")
    land("a.jsonl", (0, 0, "req_a", 10), (0, 2, "req_a", 500), (10, 0, "req_b", 7))
    assert run(t0 + 960) == 1 and held() == [(1, "req_a", t0, 500)]
    land("b.jsonl", (10, 3, "req_b", 90), (0, 1, "req_a", 900))     # req_b goes on; req_a is stored and stays as it is
    assert run(t0 + 1600) == 1 and held() == [(1, "req_a", t0, 500), (2, "req_b", t0 + 600, 90)]
    land("c.jsonl", (30, 0, "req_c", 5))
    assert run(t0 + 1900) == 0 and run(t0 + 2800) == 1              # no new segment: req_c has only grown old enough
    assert held()[-1] == (3, "req_c", t0 + 1800, 5) and run(t0 + 2900) == 0
    assert [r[1] for r in rows(stored(spark, paths["scans"], schemas.SCANS), "complete_through_ts", "requests_added")] == [1, 1, 0, 1, 0]


def test_staleness(spark, rows):
    scans = spark.createDataFrame([(1000, "x", 1, 1), (3000, "x", 1, 1)], schemas.SCANS)
    assert rows(staleness(scans, 4799)) == [(3000, False)] and rows(staleness(scans, 4800)) == [(3000, True)]
    assert rows(staleness(scans.limit(0), 4800)) == [(None, True)]
