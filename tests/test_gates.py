"""The gates: one rule a test, on readings, snapshots, telemetry, requests and slots made here."""

import json

import pytest
from pyspark.sql import functions as F

from meterloom import schemas
from meterloom.operators.quality import last_attempt, latest
from meterloom.sinks import gates
from meterloom.sources.tables import stored


def pushed(wrote, five=12.25, session="tab-4", at=70_000, week=31, **more):
    return json.dumps({"ts": wrote, "source": "claude_statusline", "observed_at": at, "five_hour_pct": five, "seven_day_pct": week,
                       "observed_by_session": session, **more})


def polled(wrote, five=None, reset=None, **more):
    return json.dumps({"ts": wrote, "source": "claude_api", "api": {"five_hour": {"utilization": five, "resets_at": reset}}, **more})


def failed(wrote, **more):
    return json.dumps({"ts": wrote, "source": "claude_api", "error": {"stage": "dns", "type": "Gone", "status": 503, "retry_after_s": 44}, **more})


class Store:
    def __init__(self, spark, folder):
        self.spark, self.number = spark, 0
        self.account, self.errors, self.snaps, self.telemetry = (str(folder / n) for n in ("account", "errors", "snaps", "telemetry"))

    def lines(self, texts, **extra):
        first, self.number = self.number, self.number + len(texts)
        return self.spark.createDataFrame([(t, first + i, *extra.values()) for i, t in enumerate(texts)],
                                          "value string, ingest_id long" + "".join(f", {k} string" for k in extra))

    def read(self, *texts, agent="claude", dedup=True):
        """(inserted, duplicate, redundant, rejected)"""
        return tuple(gates.outcome_counts(gates.add_readings(self.lines(texts), self.account, self.errors, agent, dedup)).values())

    def snapshot(self, *texts, session="tab-4"):
        return tuple(gates.outcome_counts(gates.add_snapshots(self.lines(texts, session_id=session), self.snaps)).values())

    def report(self, *texts):
        return tuple(gates.outcome_counts(gates.add_telemetry(self.lines(texts), self.telemetry)).values())

    def table(self, path, schema):
        return stored(self.spark, path, schema)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def test_a_pushed_reading_is_dated_when_it_was_observed(store, rows):
    line = pushed(70_040, 12.25, five_hour_resets_at="1700000400")
    assert store.read(line) == (1, 0, 0, 0)
    assert rows(store.table(store.account, schemas.ACCOUNT_QUOTAS), "ts", "written_ts", "five_hour_pct", "five_hour_resets_ts", "seven_day_pct",
                "seven_day_resets_ts", "raw") == [(70_000, 70_040, 12.25, 1_700_000_400, 31.0, None, line)]


def test_a_session_that_repeats_itself_is_redundant(store):
    assert store.read(pushed(1), pushed(2), pushed(3, 13), pushed(4), pushed(4), pushed(5, session="tab-9")) == (4, 0, 2, 0)
    assert store.read(pushed(6), pushed(7, session="tab-9"), pushed(8, 14)) == (1, 0, 2, 0)


def test_without_dedup_only_the_same_text_is_a_copy(store):
    assert store.read(pushed(1), dedup=False) == (1, 0, 0, 0)
    assert store.read(pushed(1), pushed(2), dedup=False) == (1, 1, 0, 0)


@pytest.mark.parametrize("line", [
    pushed(5, five="much"), pushed(5, five=False), pushed(5, prompt_cache={}), pushed("5"), '"text"', '{"ts":5', '{"ts":5,"source":"elsewhere"}',
    polled(5, 1, machine="two words"), polled(5, 1, machine="m-1\n"), polled(5, 1, "tomorrow")],
    ids=["text percent", "bool percent", "session field", "text time", "no object", "half a line", "source", "machine", "line feed", "reset"])
def test_refused(store, line):
    assert store.read(line, pushed(6)) == (1, 0, 0, 1)


def test_blank_lines_are_no_readings(store):
    assert store.read("", "  \t", pushed(1)) == (1, 0, 0, 0)


def test_a_reset_may_be_an_iso_time(store, rows):
    assert store.read(polled(80_000, 55.5, "2023-11-14T22:13:20.900+00:00")) == (1, 0, 0, 0)
    assert rows(store.table(store.account, schemas.ACCOUNT_QUOTAS), "ts", "five_hour_pct", "five_hour_resets_ts") == [(80_000, 55.5, 1_700_000_000)]


def test_failures_are_kept_apart_and_once(store, rows):
    """A failed push is dated when it was written, so it is found again."""
    push = json.dumps({"ts": 91_000, "source": "claude_statusline", "observed_at": 12, "error": {"stage": "parse"}})
    assert store.read(failed(90_000), push) == (2, 0, 0, 0)
    assert store.read(push, failed(90_000), failed(90_001)) == (1, 2, 0, 0)
    assert rows(store.table(store.errors, schemas.POLL_ERRORS), "ts", "stage", "status", "retry_after_s") == [
        (90_000, "dns", 503, 44), (90_001, "dns", 503, 44), (91_000, "parse", None, None)]
    assert rows(last_attempt(store.table(store.account, schemas.ACCOUNT_QUOTAS), store.table(store.errors, schemas.POLL_ERRORS), ["claude_api"]), "ts") == [(90_001,)]


def test_what_is_told_late_is_not_the_latest(store, rows):
    assert store.read(polled(50_000, 3.5, machine="m-7")) == (1, 0, 0, 0)
    assert store.read(pushed(60_000, at=49_000)) == (1, 0, 0, 0)
    assert rows(latest(store.table(store.account, schemas.ACCOUNT_QUOTAS), 0), "ts", "machine", "five_hour_pct") == [(50_000, "m-7", 3.5)]


def test_the_second_agents_meters_are_told_by_their_length(store, rows):
    def limits(primary, secondary):
        return json.dumps({"ts": 400, "source": "codex_app_server", "codex_rate_limits": {"rateLimits": {"primary": primary, "secondary": secondary}}})
    week = {"usedPercent": 61, "windowDurationMins": 10080, "resetsAt": 777}
    five = {"usedPercent": 8, "windowDurationMins": 300, "resetsAt": 555}
    assert store.read(limits(week, five), '{"ts":401,"source":"codex_plan_limit_history"}', '{"ts":402}', agent="codex") == (2, 0, 0, 1)
    assert rows(latest(store.table(store.account, schemas.ACCOUNT_QUOTAS), 0), "five_hour_pct", "five_hour_resets_ts", "seven_day_pct",
                "seven_day_resets_ts") == [(8.0, 555, 61.0, 777)]


@pytest.mark.parametrize("reset, now, shown", [(300, 299, (47.5, 300)), (300, 301, (0.0, None)), (None, 9_999, (47.5, None))])
def test_a_meter_past_its_reset_shows_zero(spark, rows, reset, now, shown):
    row = (1, 100, "x", "claude_api", 47.5, reset, 20.0, 10 ** 6, None, 100, "{}", "h", "m")
    got = latest(spark.createDataFrame([row], schemas.ACCOUNT_QUOTAS), now)
    assert rows(got, "five_hour_pct", "five_hour_resets_ts", "seven_day_pct") == [(*shown, 20.0)]


def snap(wrote, cost=2.5, cache='{"hits":4,"cold":false}', model="m-x"):
    return f'{{"ts":{wrote},"observed_at":{wrote - 9},"model_id":"{model}","session_cost_usd":{cost},"prompt_cache":{cache}}}'


def test_snapshots_repeat_whatever_the_order_of_keys(store, rows):
    assert store.snapshot(snap(800)) == (1, 0, 0, 0)
    assert store.snapshot(snap(810, cache='{"cold":false,"hits":4}'), snap(820, 2.75), snap(830, 2.75, model="m-y")) == (2, 0, 1, 0)
    assert store.snapshot(snap(840, 2.75, model="m-y"), session="tab-5") == (1, 0, 0, 0)
    assert rows(store.table(store.snaps, schemas.SESSION_SNAPSHOTS).where("session_cost_usd = 2.5"), "ts", "session_id") == [(791, "tab-4")]


@pytest.mark.parametrize("cache", ['{"used_percent":1}', r'{"a":[{"pct":1}]}', '{"UTILIZation":{}}'], ids=["plain", "escaped", "case"])
def test_snapshots_hold_no_percent_key(store, cache):
    assert store.snapshot(snap(800, cache=cache)) == (0, 0, 0, 1)


def test_a_percent_in_a_text_is_no_key(store):
    assert store.snapshot(snap(800, cache=r'{"note":"A \"pct\": 3"}')) == (1, 0, 0, 0)


@pytest.mark.parametrize("session", ["../up", "a b", "tab\n", "account", "x" * 129])
def test_session_names(store, session):
    assert store.snapshot(snap(800), session=session) == (0, 0, 0, 1)


def test_telemetry_is_stored_once(store, rows):
    def event(received, **more):
        return json.dumps({"source": "claude_otel", "observed_at": 640, "received_at": received, "event": "api_request", "attributes": {
            "session.id": "tab-4", "request_id": "q-8", "model": "m-x", "input_tokens": 70, "output_tokens": "71", "cost_usd": 0.125}, **more})
    assert store.report(event(9), event(9), event(10), event(11, source="other"), "no json") == (2, 1, 0, 2)
    assert store.report(event(10), event(12)) == (1, 1, 0, 0)
    assert rows(store.table(store.telemetry, schemas.TELEMETRY).where("received_ts = 9"), "ts", "request_id", "input_tokens", "output_tokens", "cost_usd") == [
        (640, "q-8", 70, None, 0.125)]


def turns(spark, *ids, output=6):
    return spark.createDataFrame([(i, 500 + i, "x", r, "m", "s", "/w", "cli", "m", 5, output, 4, 3, 2, 0.5) for i, r in enumerate(ids)], schemas.TURNS)


def test_requests_once(spark, tmp_path):
    path = str(tmp_path / "requests")
    assert [gates.add_requests(turns(spark, *ids), path, schemas.TURNS) for ids in (("a", "b", "a", "c"), ("c", "d"), ("d",))] == [3, 1, 0]
    for bad in (turns(spark, "e", "", "f"), turns(spark, "g", output=-2), turns(spark, None)):
        with pytest.raises(ValueError):
            gates.add_requests(bad, path, schemas.TURNS)
    assert stored(spark, path, schemas.TURNS).count() == 4


def test_a_scan_is_kept_once(spark, tmp_path):
    path = str(tmp_path / "scans")
    assert [gates.add_scan(spark, path, ts, through, 0) for ts, through in ((700, 100), (700, 100), (700, 200))] == ["inserted", "duplicate", "inserted"]


def slot(ts=1_200, **more):
    return {"ts": ts, "dt": f"1970-01-01T00:{ts // 60:02d}:00Z", "machine": "node-3", "folder": "/w", "entrypoint": "cli", "model": "m-x", "requests": 2,
            "input_tokens": 9, "output_tokens": 8, "cache_read_tokens": 7, "cache_write_5m_tokens": 6, "cache_write_1h_tokens": 5,
            "cache_write_unknown_tokens": 4, "usd": 0.75, "tokens_without_usd": 0, "written_ts": 1_600, **more}


def receive(spark, path, *slots, sender="node-3", receiver="hub", **envelope):
    lines = spark.createDataFrame([(json.dumps({"agent": "claude", "table": "slots", **envelope, "row": s}), i) for i, s in enumerate(slots)],
                                  "value string, ingest_id long")
    return gates.receive_slots(lines, path, sender, receiver)


def test_received_slots_are_stored_once_and_the_first_sent_counts(spark, rows, tmp_path):
    path = str(tmp_path / "slots")
    assert receive(spark, path, slot(), slot(1_500, usd=None), slot(1_500, usd=3.0), slot(requests=7)) == 2
    assert receive(spark, path, slot(requests=9), slot(1_800)) == 1
    assert rows(stored(spark, path, schemas.SLOTS), "ts", "requests", "usd") == [(1_200, 2, 0.75), (1_500, 2, None), (1_800, 2, 0.75)]


@pytest.mark.parametrize("bad", [{"ts": 1_201}, {"dt": "soon"}, {"machine": "node-4"}, {"machine": "node-3\n"}, {"requests": -1}, {"requests": 0.5},
                                 {"requests": True}, {"usd": "0.75"}, {"model": None}, {"pct": 1}], ids=str)
def test_one_bad_slot_refuses_all(spark, tmp_path, bad):
    path = str(tmp_path / "slots")
    with pytest.raises(ValueError):
        receive(spark, path, slot(1_500), slot(**bad))
    assert stored(spark, path, schemas.SLOTS).count() == 0


@pytest.mark.parametrize("how", [{"sender": "hub"}, {"sender": "a/b"}, {"sender": "node-3\n"}, {"table": "readings"}, {"agent": "other"}], ids=str)
def test_who_may_send(spark, tmp_path, how):
    with pytest.raises(ValueError):
        receive(spark, str(tmp_path / "slots"), slot(), **how)


def test_own_slots_need_no_envelope(spark, tmp_path):
    path, typed = str(tmp_path / "slots"), spark.createDataFrame([tuple(slot().values())], schemas.SLOTS)
    assert gates.add_slots(typed, path, "node-3") == 1 and gates.add_slots(typed, path) == 0
    with pytest.raises(ValueError):
        gates.add_slots(typed.withColumn("tokens_without_usd", F.lit(None).cast("long")), path)
