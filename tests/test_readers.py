"""Readers of transcripts, session files, telemetry batches, payloads and answers, on logs generated here."""

import collections
import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from meterloom.sources import lines as src, readings, telemetry, transcripts

DAY = 1_700_006_400


def stamp(second, zone="Z"):
    return datetime.fromtimestamp(second, UTC).strftime("%Y-%m-%dT%H:%M:%S.125") + zone


@pytest.fixture
def log(spark, tmp_path):
    """Writes files of lines and reads the tree."""
    def write(files, tail=""):
        for name, lines in files.items():
            path = tmp_path / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("".join(line + "\n" for line in lines) + tail)
        return src.read_lines(spark, str(tmp_path))
    return write


def compact(value):
    """JSON as the logs hold it."""
    return json.dumps(value, separators=(",", ":"))


def answer(second, request, output, **more):
    usage = {"input_tokens": 7, "output_tokens": output, "cache_read_input_tokens": 90, "cache_creation_input_tokens": 13,
             "cache_creation": {"ephemeral_5m_input_tokens": 8, "ephemeral_1h_input_tokens": 5}}
    return compact({"type": "assistant", "timestamp": stamp(second), "requestId": request, "sessionId": "z0", "cwd": "/w/north", "entrypoint": "cli",
                       "message": {"id": f"id-{request}", "model": "big", "usage": usage}} | more)


def test_requests_of_random_lines(log, rows):
    """Per request the usage of its largest output and the time of its first line, wherever the lines lie."""
    rng = random.Random(11)
    said = [(DAY + rng.randrange(1_000), f"q{rng.randrange(25)}", rng.randrange(10 ** 6), f"{rng.choice('ab')}/{i % 4}.jsonl") for i in range(120)]
    files = collections.defaultdict(list)
    for second, request, output, name in said:
        files[name] += [answer(second, request, output), json.dumps({"type": "user", "timestamp": stamp(second), "message": {"usage": output}})]
    lines = log(files, tail=answer(DAY, "half", 1)[:70])
    for limit in (None, DAY + 300):
        want = {}
        for second, request, output, _ in said:
            first, most = want.get(request, (10 ** 12, -1))
            want[request] = (min(first, second), max(most, output))
        got = transcripts.requests(lines, limit) if limit else transcripts.requests(lines)
        assert rows(got, "request_id", "ts", "output_tokens") == sorted(
            ((r, *w) for r, w in want.items() if limit is None or w[0] <= limit), key=repr)
    one = transcripts.requests(lines).where("request_id = 'q3'")
    assert rows(one, "input_tokens", "cache_read_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens", "folder", "entrypoint", "session_id", "model") == [
        (7, 90, 8, 5, "/w/north", "cli", "z0", "big")]


def opened(second, thread, **more):
    return json.dumps({"timestamp": stamp(second), "type": "session_meta", "payload": {"id": thread, **more}})


def context(second, **more):
    return json.dumps({"timestamp": stamp(second), "type": "turn_context", "payload": more})


def used(second, total, own):
    """A running total and the turn's own usage: (input, cached, output)."""
    names = ("input_tokens", "cached_input_tokens", "output_tokens")
    return json.dumps({"timestamp": stamp(second), "type": "event_msg", "payload": {"type": "token_count", "info": {
        "total_token_usage": dict(zip(names, total)) | {"total_tokens": total[0] + total[2]}, "last_token_usage": dict(zip(names, own))}}})


def test_turns_take_their_context_and_count_once(log, rows):
    session = [opened(DAY, "t1", cwd="/w/east", source="cli"), context(DAY + 1, model="gpt-5.6-sol", cwd="/w/east"), used(DAY + 2, (600, 100, 40), (600, 100, 40)),
               used(DAY + 3, (600, 100, 40), (600, 100, 40)), context(DAY + 4, model="unlisted", cwd=""), used(DAY + 5, (900, 150, 70), (300, 50, 30))]
    got = transcripts.turns(log({"now/t1.jsonl": session, "old/t1.jsonl": session}), "node-3")
    assert rows(got, "request_id", "folder", "entrypoint", "model", "input_tokens", "cache_read_tokens", "output_tokens", F.round("usd", 9)) == [
        ("t1:640", "/w/east", "cli", "gpt-5.6-sol", 500, 100, 40, round((500 * 4 + 100 * 0.4 + 40 * 20) / 1e6, 9)),
        ("t1:970", "/w/east", "cli", "unlisted", 250, 50, 30, None)]


def test_a_new_session_line_forgets_the_old_folder(log, rows):
    lines = log({"t.jsonl": [opened(DAY, "t2", cwd="/w/west", source={"by": "t0"}), used(DAY + 1, (4, 0, 2), (4, 0, 2)), opened(DAY + 2, "t3", source="exec"),
                             used(DAY + 3, (9, 0, 3), (5, 0, 1))]})
    assert rows(transcripts.turns(lines, "node-3"), "request_id", "folder", "entrypoint") == [("t2:6", "/w/west", "subagent"), ("t3:12", None, "exec")]


def test_a_counter_that_restarts_counts_its_own_usage(log):
    totals = [(50, 20, 5), (50, 20, 5), (80, 30, 9), (12, 4, 3), (20, 4, 4)]
    own = [(50, 20, 5), (50, 20, 5), (30, 10, 4), (12, 4, 3), (8, 0, 1)]
    lines = log({"t.jsonl": [context(DAY, model="big"), *(used(DAY + i, t, o) for i, (t, o) in enumerate(zip(totals, own)))]})
    got = transcripts.turn_usage(lines).orderBy("line").collect()
    assert [(r.input_tokens, r.cache_read_tokens, r.output_tokens) for r in got] == [(30, 20, 5), (20, 10, 4), (8, 4, 3), (8, 0, 1)]


def wrap(value):
    """A value as telemetry wraps it."""
    if isinstance(value, bool):
        return {"boolValue": value}
    if isinstance(value, int):
        return {"intValue": str(value)}
    if isinstance(value, float):
        return {"doubleValue": value}
    if isinstance(value, list):
        return {"arrayValue": {"values": [wrap(v) for v in value]}}
    if isinstance(value, dict):
        return {"kvlistValue": {"values": [{"key": k, "value": wrap(v)} for k, v in value.items()]}}
    return {} if value is None else {"stringValue": value}


def exported(*events):
    """A batch of (body, attributes)."""
    records = [{"timeUnixNano": f"{DAY + i}250000000", "body": {"stringValue": body}, "attributes": wrap(attributes)["kvlistValue"]["values"]}
               for i, (body, attributes) in enumerate(events)]
    return json.dumps({"resourceLogs": [{"resource": {"attributes": wrap({"host": "h"})["kvlistValue"]["values"]}, "scopeLogs": [{"logRecords": records}]}]})


DEEP = {"list": [1, [2.5, ["x", {"k": [True, None, [["é\n"]]]}]]], "text": 'a "quoted" \\ text', "none": None, "n": 12}


def test_telemetry_keeps_usage_events_and_unwraps_any_depth(spark):
    bodies = [exported(("claude_code.api_request", DEEP | {"session.id": "tab-4", "input_tokens": 5, "cost_usd": 0.0625, "request_id": "q1"}),
                       ("claude_code.user_prompt", {"prompt": "hidden"})),
              exported(("x", {"event.name": "api_error", "session.id": "../up"}), ("claude_code.api_refusal", {}), ("claude_code.api_retries_exhausted", {"n": 1})),
              "{", exported()]
    got = telemetry.telemetry(spark.createDataFrame([(b, 33) for b in bodies], "value string, received_ts long")).collect()
    assert sorted(r.event for r in got) == ["api_error", "api_refusal", "api_request", "api_retries_exhausted"]
    assert not any("hidden" in r.raw for r in got) and [r.session_id for r in got if r.event == "api_error"] == [None]
    one = next(r for r in got if r.event == "api_request")
    assert (one.ts, one.session_id, one.input_tokens, one.cost_usd, one.request_id, one.received_ts) == (DAY, "tab-4", 5, 0.0625, "q1", 33)
    raw = json.loads(one.raw)
    assert {k: raw["attributes"][k] for k in DEEP} == DEEP and raw["resource"] == {"host": "h"} and raw["time_unix_nano"] == DAY * 10 ** 9 + 250_000_000


def test_attribute_keys_are_listed_once(spark):
    """Of a key that comes twice the last value counts, and a batch's keys are turned round once, not once per attribute."""
    twice = exported(("claude_code.api_request", {"request_id": "a", "n": 1})).replace('"n"', '"request_id"', 1)
    assert twice.count("request_id") == 2
    got = telemetry.telemetry(spark.createDataFrame([(twice.replace('"intValue": "1"', '"stringValue": "b"').replace('"intValue": 1', '"stringValue": "b"'), 33)],
                                                    "value string, received_ts long"))
    assert [r.request_id for r in got.collect()] == ["b"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(") == 1


def test_a_payload_has_the_time_of_its_transcripts_last_answer(spark, log, rows):
    quoted = compact({"type": "user", "timestamp": stamp(DAY + 900), "text": answer(DAY + 800, "q", 1)})
    lines = log({"a.jsonl": [answer(DAY, "q1", 1), answer(DAY + 60, "q2", 2), quoted], "b.jsonl": [compact({"type": "assistant", "timestamp": stamp(DAY, "+01:00")})]})
    at = transcripts.observed_at(transcripts.last_answers(lines)).withColumn("path", F.element_at(F.split("path", "/"), -1))
    assert rows(at) == [("a.jsonl", DAY + 60), ("b.jsonl", None)]
    limits = {"seven_day": {"used_percentage": 64.5, "resets_at": "77"}}
    shown = [{"transcript_path": "a.jsonl", "session_id": "tab-4", "rate_limits": limits, "cost": {"total_cost_usd": 1.25}, "model": {"id": "big"}, "prompt_cache": {"w": 0}},
             {"transcript_path": "a.jsonl", "session_id": "no/name", "rate_limits": limits}, {"transcript_path": "a.jsonl", "session_id": "tab-4"},
             {"transcript_path": "b.jsonl", "rate_limits": limits}, {"transcript_path": "c.jsonl", "rate_limits": limits}]
    account, session = readings.payload_rows(spark.createDataFrame([(json.dumps(p),) for p in shown], "value string"), at, F.lit(DAY + 99), "node-3")
    told = sorted((json.loads(r.value) for r in account.collect()), key=lambda r: r["observed_by_session"])
    assert [(t["observed_by_session"], t["ts"], t["observed_at"], t["five_hour_pct"], t["seven_day_pct"], t["five_hour_resets_at"], t["seven_day_resets_at"], t["machine"])
            for t in told] == [(s, DAY + 99, DAY + 60, 0, 64.5, None, "77", "node-3") for s in ("no/name", "tab-4")]
    [kept] = session.collect()
    assert kept.session_id == "tab-4" and {k: json.loads(kept.value)[k] for k in ("model_id", "session_cost_usd", "prompt_cache")} == {
        "model_id": "big", "session_cost_usd": 1.25, "prompt_cache": {"w": 0}}


def test_the_latest_answer_about_a_window_or_day_counts(spark, rows):
    def history(ts, points):
        return ("codex_plan_limit_history", ts, json.dumps({"ts": ts, "plan_limit_history": {"periods": [
            {"window_minutes": 300, "starts_at": stamp(DAY + 3_600 * n), "ends_at": stamp(DAY + 3_600 * n + 18_000), "used_basis_points": p, "accounting_complete": n == 0}
            for n, p in enumerate(points)]}}))

    def daily(ts, **days):
        return ("codex_app_server", ts, json.dumps({"ts": ts, "codex_usage": {"dailyUsageBuckets": [
            {"startDate": f"2023-11-{d[1:]}", "tokens": n} for d, n in days.items()]}}))
    share = ("claude_api", 9, json.dumps({"api": {"seven_day_breakdown": {"as_of": stamp(DAY), "rows": [{"key": k, "percent": p} for k, p in (("code", 41.5), ("chat", 2.0))]}}}))
    df = spark.createDataFrame([history(1, [900, 50]), history(3, [5_050.0]), history(2, [700]), daily(1, d15=8, d16=3), daily(2, d16=11), share],
                               "source string, ts long, raw string")
    assert rows(readings.finished_windows(df), "start", "end", F.round("pct", 6), "fetched_ts", "accounting_complete") == [
        (DAY, DAY + 18_000, 50.5, 3, True), (DAY + 3_600, DAY + 21_600, 0.5, 1, False)]
    assert rows(readings.daily_tokens(df)) == [("2023-11-15", 8, 1), ("2023-11-16", 11, 2)]
    assert rows(readings.product_breakdown(df), "ts", "as_of", "product", "pct") == [(9, DAY, "chat", 2.0), (9, DAY, "code", 41.5)]


def test_costs_refusals_and_arrival_numbers(log, rows):
    state = lambda usd, took: json.dumps({"type": "cost-state", "sessionId": "z0", "totalCostUSD": usd, "totalDuration": took, "startTime": DAY * 1000 + 400})
    lines = log({"a.jsonl": [state(0.5, 2_000), state(0.75, 61_700), answer(DAY + 5, "q", 1, quotaLimits={
        "status": "rejected", "rateLimitType": "seven_day", "resetsAt": DAY + 999})]})
    assert rows(transcripts.cost_states(lines), "session_id", "ts", "usd") == [("z0", DAY + 62, 0.75)]
    assert rows(transcripts.refusals(lines)) == [(DAY + 5, "z0", "seven_day", DAY + 999)]
    assert [r.ingest_id for r in src.number_rows(lines, 40).orderBy("line").collect()] == [41, 42, 43]
