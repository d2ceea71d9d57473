"""Payloads dated on arrival, beside a plain look-up; and end to end, with transcripts that grow."""

import json
import random
from datetime import datetime, timezone

import pandas as pd

from meterloom import schemas
from meterloom.sources.tables import stored
from meterloom.streaming.dating import Dating, dated
from meterloom.streaming.repeats import rocksdb
from meterloom.streaming.transcripts import follow_payloads

ANSWER = "path STRING, at TIMESTAMP, block LONG, line LONG, ts LONG"
PAYLOAD = "path STRING, arrived TIMESTAMP, ingest_id LONG, value STRING"
at = lambda s: datetime.fromtimestamp(s, timezone.utc)


def plain(answers, payload):
    """ts of the last answer at or before the payload's arrival; of two at one time the later line's."""
    path, arrived, *_ = payload
    before = [a for a in answers if (a[0] or "") == (path or "") and a[1] <= arrived]
    return max(before, key=lambda a: a[1:4])[4] if before else None


def test_equals_a_plain_look_up(spark, tmp_path):
    rng, answers, payloads = random.Random(4), [], []
    told, shown, out, progress = (str(tmp_path / n) for n in ("told", "shown", "out", "progress"))
    with rocksdb(spark):
        for run in range(3):
            start = 100_000 + run * 5_000
            a = [(f"p{rng.randrange(4)}", at(start + rng.randrange(3_000)), 0, run * 1000 + i, rng.choice([None, start + i])) for i in range(200)]
            p = [(rng.choice(["p0", "p1", "p2", "p9", None]), at(start + rng.randrange(3_000)), run * 1000 + i, f"v{i}") for i in range(150)]
            p += [p[0][:2] + (run * 1000 + 900, None)]  # two at one time
            answers, payloads = answers + a, payloads + p
            spark.createDataFrame(a, ANSWER).write.mode("append").parquet(told)
            spark.createDataFrame(p + ([("end", at(999_999), -1, "")] if run == 2 else []), PAYLOAD).write.mode("append").parquet(shown)
            stream = dated(spark.readStream.schema(PAYLOAD).parquet(shown), spark.readStream.schema(ANSWER).parquet(told))
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    got = sorted(((r.ingest_id, r.path, r.value, r.arrived, r.observed_at) for r in spark.read.parquet(out).collect()))
    assert got == sorted((i, p or "", v, int(t.timestamp()), plain(answers, (p, t))) for p, t, i, v in payloads)


class Held:
    """A state variable or the handle itself in plain memory, counting what it is asked."""
    def __init__(self):
        self.rows, self.calls, self.timers = [], 0, []

    def getListState(self, name, schema):
        return self.__dict__.setdefault(name, Held())

    getValueState = getListState

    def registerTimer(self, at):
        self.timers.append(at)

    def exists(self):
        return bool(self.rows)

    def get(self):
        return self.rows

    def appendList(self, rows):
        self.calls, self.rows = self.calls + 1, self.rows + rows

    def put(self, rows):
        self.rows = rows

    def update(self, row):
        self.rows = list(row)

    def clear(self):
        self.rows = []

    def getCurrentWatermarkInMs(self):
        return self.now


def test_state_is_asked_once_a_frame(spark):
    handle, clock, d = Held(), Held(), Dating()
    d.init(handle)
    n = 1_000  # a payload and an answer of one second, each second
    frame = pd.DataFrame({"path": "p", "at": pd.to_datetime([s for s in range(n)] * 2, unit="s"), "answer": [True] * n + [False] * n, "block": 0,
                          "line": range(2 * n), "ts": list(range(n)) + [None] * n, "ingest_id": range(2 * n), "value": "v"})
    d.handleInputRows((0,), iter([frame]), clock)
    assert handle.timers == [1_000] and handle.answers.calls == handle.waiting.calls == 1
    clock.now = 400_500
    out = pd.concat(d.handleExpiredTimer((0,), clock, None))
    assert out["arrived"].tolist() == out["observed_at"].tolist() == list(range(401)) and handle.timers == [1_000, 402_000]
    clock.now = 2_000_000
    out = pd.concat(d.handleExpiredTimer((0,), clock, None))
    assert out["observed_at"].tolist() == list(range(401, n)) and not handle.answers.rows and not handle.waiting.rows and len(handle.last.rows) == 1
    assert len(handle.timers) == 2 and list(d.handleExpiredTimer((0,), clock, None)) == []


def test_from_growing_transcripts_to_the_gates(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    file = str(logs / "a.jsonl")
    account, errors, snaps, progress, landed = (str(tmp_path / n) for n in ("account", "errors", "snaps", "progress", "landed"))

    def answer(second, zone="Z"):
        with open(file, "a") as f:
            f.write(json.dumps({"type": "assistant", "timestamp": f"2026-10-08T12:00:{second:02d}{zone}"}, separators=(",", ":")) + "\n")

    def payload(second, number, pct):
        text = json.dumps({"transcript_path": file, "session_id": "s1", "cost": {"total_cost_usd": pct / 10},
                           "rate_limits": {"five_hour": {"used_percentage": pct}}})
        spark.createDataFrame([(text, number, at(t0 + second))], "value STRING, ingest_id LONG, arrived TIMESTAMP").write.mode("append").parquet(landed)

    t0 = int(datetime(2026, 10, 8, 12, tzinfo=timezone.utc).timestamp())
    with rocksdb(spark):
        def run():
            shown = spark.readStream.schema("value STRING, ingest_id LONG, arrived TIMESTAMP").parquet(landed)
            follow_payloads(spark, shown, file.rsplit("/", 1)[0], account, errors, snaps, progress, "m1", t0 + 9_000, delay="1 second")
        answer(1)
        answer(10)
        for second, number, pct in ((0, 1, 5.0), (5, 2, 6.0), (12, 3, 7.0)):  # before any answer; between two; after both
            payload(second, number, pct)
        run()
        answer(20, "+02:00")  # no UTC stamp: an earlier instant, which dates nothing that comes later
        answer(30)
        payload(40, 4, 8.0)
        run()
        payload(90, 5, 9.0)
        run()
        for number in (6, 7):  # what came before them is settled; they wait themselves
            payload(500 * number, number, 1.0)
            run()
    got = sorted((r.ts - t0, r.five_hour_pct) for r in stored(spark, account, schemas.ACCOUNT_QUOTAS).collect())
    assert got == [(1, 6.0), (10, 7.0), (30, 8.0), (30, 9.0)]
    assert stored(spark, snaps, schemas.SESSION_SNAPSHOTS).count() == 4
