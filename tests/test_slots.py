"""Requests and telemetry to slots, beside a plain Python form on random rows; finality, costs, recounts, maintenance."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from meterloom import schemas
from meterloom.operators import maintenance, reconcile, slots
from meterloom.plans import jobs
from meterloom.sinks import gates
from meterloom.sources.tables import stored

COLUMNS = ["ts", "folder", "entrypoint", "model", "requests", "input_tokens", "output_tokens", "cache_read_tokens", "cache_write_5m_tokens",
           "cache_write_1h_tokens", "cache_write_unknown_tokens", "usd", "tokens_without_usd"]
PLACES = {"z0": ("/w/north", "cli"), "z1": ("/w/south", "sdk-go"), "z2": (None, "cli")}


def random_requests(n, seed=1):
    """(arrival, ts, dt, id, session, folder, entrypoint, model, five token counts)"""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        session = rng.choice(list(PLACES))
        out.append((i, 9_000 + rng.randrange(3_000), "x", f"q{i}", session, *PLACES[session], rng.choice(["big", "small"]), *(rng.randrange(50) for _ in range(5))))
    return out


def random_telemetry(n, n_requests, seed=2):
    """Reports on some requests and on others that no transcript has, some sent twice, some without cost."""
    rng, out = random.Random(seed), []
    for i in range(n):
        known = rng.random() < 0.6
        request = f"q{rng.randrange(n_requests)}" if known else f"only{rng.randrange(n // 3)}"
        out.append((len(out), 9_000 + rng.randrange(3_000), "x", rng.choice(["api_request"] * 4 + ["api_error"]), rng.choice([*PLACES, "z9"]), request,
                    rng.choice(["big", "tiny"]), "topic", *(rng.randrange(50) for _ in range(4)), rng.choice([None, 0.25, 0.5, 1.0]), 1, "{}", str(i)))
    return out


def brute_slots(requests, telemetry, start, end):
    first = {}
    for t in telemetry:
        if t[3] == "api_request":
            first.setdefault(t[5], t)
    place = {}
    for r in requests:
        for n in (5, 6):
            if r[n] is not None:
                place.setdefault((r[4], n), r[n])
    found = collections.defaultdict(lambda: [0] * 9)

    def add(ts, folder, entry, model, tokens, usd):
        if start <= ts < end:
            own = found[ts // 300 * 300, folder or "", entry or "", model]
            own[0] += 1
            for i, n in enumerate(tokens):
                own[1 + i] += n
            own[7] = own[7] if usd is None else (own[7] or 0) + usd
            own[8] += sum(tokens) if usd is None else 0
            own.append(usd)
    for r in requests:
        add(r[1], r[5], r[6], r[7], [*r[8:13], 0], first[r[3]][12] if r[3] in first else None)
    for request, t in first.items():
        if request not in {r[3] for r in requests}:
            add(t[1], place.get((t[4], 5)), place.get((t[4], 6)), t[6], [t[8], t[9], t[10], 0, 0, t[11]], t[12])
    return sorted(((*key, *own[:7], own[7] if any(u is not None for u in own[9:]) else None, own[8]) for key, own in found.items()), key=repr)


@pytest.fixture(scope="module")
def facts(spark):
    requests, telemetry = random_requests(60), random_telemetry(50, 60)
    return requests, telemetry, spark.createDataFrame(requests, schemas.REQUESTS), spark.createDataFrame(telemetry, schemas.TELEMETRY)


def test_slots_of_random_rows(facts, rows):
    requests, telemetry, r, t = facts
    for start, end in ((0, 20_000), (9_600, 10_800)):
        assert rows(slots.build_slots(r, t, "node-3", 1, start, end), *COLUMNS) == brute_slots(requests, telemetry, start, end)
    assert rows(slots.build_slots(r, None, "node-3", 1, 0, 20_000), *COLUMNS) == brute_slots(requests, [], 0, 20_000)


def test_slots_are_written_once_when_final(spark, facts, rows, tmp_path):
    requests, telemetry, r, t = facts
    path = {n: str(tmp_path / n) for n in ("requests", "telemetry", "scans", "slots")}
    r.write.parquet(path["requests"])
    t.write.parquet(path["telemetry"])

    def run(now, through=None):
        if through:
            gates.add_scan(spark, path["scans"], now, through, 0)
        return jobs.write_slots(spark, path["requests"], path["telemetry"], path["scans"], path["slots"], "node-3", now)
    assert run(20_000) == 0
    assert run(20_100, 10_499) == len(brute_slots(requests, telemetry, 0, 10_200))
    assert run(20_200) == 0
    assert run(20_300, 13_000) == len(brute_slots(requests, telemetry, 10_200, 12_900))
    held = stored(spark, path["slots"], schemas.SLOTS)
    assert rows(held, *COLUMNS) == brute_slots(requests, telemetry, 0, 12_900)
    assert rows(held.where("ts = 9000").select("dt", "machine", "written_ts").distinct()) == [("1970-01-01T02:30:00Z", "node-3", 20_100)]
    agreed = reconcile.check_slots(held, r, t, 12_900)
    reconcile.require_agreement(agreed)
    with pytest.raises(ValueError):
        reconcile.require_agreement(reconcile.check_slots(held, r.where("request_id <> 'q7'"), t, 12_900))


def test_where_a_cost_comes_from(spark, rows):
    turn = lambda i, ts, request, folder, usd: (i, ts, "x", request, "node-3", "z0", folder, "cli" if i else "sdk-go", "big", 1, 1, 1, 1, 1, usd)
    told = lambda i, request, usd: (i, 5_000, "x", "api_request", "z0", request, "big", "topic", 9, 9, 9, 9, usd, 1, "{}", str(i))
    used = slots.usage_requests(
        spark.createDataFrame([turn(0, 4_700, "a", "/w/one", 8.0), turn(1, 4_900, "b", "/w/two", 16.0), turn(2, 5_100, "c", "/w/two", None)], schemas.TURNS),
        spark.createDataFrame([told(0, "b", 0.5), told(1, "d", 0.25), told(2, "d", 4.0), told(3, "a", None)], schemas.TELEMETRY))
    assert rows(used, "request_id", "folder", "entrypoint", "usd", "usd_from", "seen_in") == [
        ("a", "/w/one", "sdk-go", 8.0, "price_table", "transcript"), ("b", "/w/two", "cli", 0.5, "telemetry", "transcript"),
        ("c", "/w/two", "cli", None, None, "transcript"), ("d", "/w/one", "sdk-go", 0.25, "telemetry", "telemetry")]
    scans = spark.createDataFrame([(9_000, "x", 5_150, 0), (9_100, "x", 5_050, 0)], schemas.SCANS)
    assert rows(slots.usage_5m(used, scans), "slot_ts", "folder", "interactive", "requests", "usd", "final") == [
        (4_500, "/w/one", False, 1, 8.0, True), (4_800, "/w/one", False, 1, 0.25, True), (4_800, "/w/two", True, 1, 0.5, True),
        (5_100, "/w/two", True, 1, None, False)]
    assert {r[0] for r in rows(slots.usage_5m(used, scans.limit(0)), "final")} == {False}


def test_transcripts_to_slots(spark, rows, tmp_path):
    """Lines of one request in two files, told in pieces; then the slot of what became final."""
    day = 1_700_006_400  # 2023-11-15

    def said(minute, request, output):
        return json.dumps({"type": "assistant", "timestamp": f"2023-11-15T00:{minute:02d}:30.000Z", "requestId": request, "sessionId": "z0", "cwd": "/w/north",
                           "entrypoint": "cli", "message": {"model": "big", "usage": {"input_tokens": 3, "output_tokens": output, "cache_read_input_tokens": 40,
                                                                                      "cache_creation_input_tokens": 11, "cache_creation": {
                                                                                          "ephemeral_5m_input_tokens": 6, "ephemeral_1h_input_tokens": 5}}}})
    folder = tmp_path / "logs"
    (folder / "deep").mkdir(parents=True)
    (folder / "one.jsonl").write_text("\n".join([said(1, "qa", 12), said(2, "qa", 31), said(7, "qb", 9)]) + "\n")
    (folder / "deep" / "two.jsonl").write_text(said(1, "qa", 12) + "\n")
    path = {n: str(tmp_path / n) for n in ("requests", "telemetry", "scans", "slots")}
    spark.createDataFrame([(1, day + 95, "x", "api_request", "z0", "qa", "big", "topic", None, None, None, None, 0.375, 1, "{}", "h")],
                          schemas.TELEMETRY).write.parquet(path["telemetry"])

    def run(now):
        return (jobs.read_transcripts(spark, str(folder), path["requests"], path["scans"], now),
                jobs.write_slots(spark, path["requests"], path["telemetry"], path["scans"], path["slots"], "node-3", now))
    assert [run(day + s) for s in (60, 1_250, 1_260, 9_000)] == [(0, 0), (1, 1), (0, 0), (1, 1)]
    assert rows(stored(spark, path["slots"], schemas.SLOTS), *COLUMNS) == [
        (day, "/w/north", "cli", "big", 1, 3, 31, 40, 6, 5, 0, 0.375, 0), (day + 300, "/w/north", "cli", "big", 1, 3, 9, 40, 6, 5, 0, None, 63)]
    assert rows(stored(spark, path["requests"], schemas.REQUESTS), "request_id", "ingest_id") == [("qa", 1), ("qb", 2)]


def quotas(spark, *stamps):
    return spark.createDataFrame([(i, ts, "x", "claude_api", 1.0, None, None, None, None, ts, "{}", f"h{ts}", None) for i, ts in enumerate(stamps)],
                                 schemas.ACCOUNT_QUOTAS)


def test_two_stores_become_one(spark, rows, tmp_path):
    left, right = quotas(spark, 10, 20, 30, 40), quotas(spark, 30, 50, 20)
    shared = reconcile.shared_hashes(left, right)
    assert rows(shared) == [("h20",), ("h30",)] and rows(reconcile.shared_by_source(left, right)) == [("claude_api", 2)]
    path, labelled = str(tmp_path / "right"), str(tmp_path / "labelled")
    right.write.parquet(path)
    assert rows(maintenance.label_table(spark, path, shared, "hub", labelled), "ts", "machine") == [(20, None), (30, None), (50, "hub")]
    assert [maintenance.seed(spark, left, labelled, shared, "node-3") for _ in range(2)] == [2, 0]
    assert rows(stored(spark, labelled, schemas.ACCOUNT_QUOTAS), "ts", "machine") == [(10, "node-3"), (20, None), (30, None), (40, "node-3"), (50, "hub")]


def test_facts_are_compared_and_backed_up(spark, facts, rows, tmp_path):
    r, tokens = facts[2], reconcile.REQUEST_TOKENS
    assert rows(maintenance.check_facts(r, r, tokens)) == [(60, 0, 0)]
    for other in (r.where("request_id <> 'q3'"), r.withColumn("output_tokens", F.col("output_tokens") + F.when(F.col("request_id") == "q5", 1).otherwise(0))):
        with pytest.raises(ValueError):
            maintenance.check_facts(r, other, tokens)
    path = str(tmp_path / "requests")
    r.write.parquet(path)
    assert rows(maintenance.back_up(spark, {"requests": (path, schemas.REQUESTS)}, str(tmp_path / "copy"))) == [("requests", 60, 60)]


def test_a_move_refuses_other_machines(spark, facts, tmp_path):
    both = slots.build_slots(*facts[2:], "node-3", 1).unionByName(slots.build_slots(*facts[2:], "node-4", 1))
    with pytest.raises(ValueError):
        maintenance.move_slots(spark, both, str(tmp_path / "one"), "node-3")
    assert maintenance.move_slots(spark, both, str(tmp_path / "all")) == both.count()


def test_the_price_table_against_reported_costs(spark, rows):
    requests = spark.createDataFrame([(i, 1, "x", f"q{i}", "z0", "f", "e", "big", 0, 200_000 * (i + 1), 0, 0, 0) for i in range(4)], schemas.REQUESTS)
    ours = [2.0 * (i + 1) for i in range(4)]
    told = lambda i, usd, request=None: (i, 1, "x", "api_request", "z0", request or f"q{i}", "big", "topic", 0, 200_000 * (i + 1), 0, 0, usd, 1, "{}", str(i))
    costs = [2.0, 5.0, 6.0, 10.0]
    telemetry = spark.createDataFrame([*(told(i, c) for i, c in enumerate(costs)), told(4, 2.0, "alone"), told(5, None, "free")], schemas.TELEMETRY)
    matched = reconcile.matched_requests(requests, telemetry)
    assert rows(reconcile.token_mismatches(matched)) == [(4, 0)]
    got = reconcile.price_errors(matched, {"big": (3.0, 10.0, 0.1)}).first()
    errors = sorted(abs(a - b) / b for a, b in zip(ours, costs))
    assert (got.n, got.off_by_1_percent) == (4, sum(e > 0.01 for e in errors)) and abs(got.median_err - (errors[1] + errors[2]) / 2) < 1e-12
    assert abs(got.total_err - (sum(ours) / sum(costs) - 1)) < 1e-12
    assert [r[:2] for r in rows(reconcile.telemetry_only_cost(requests, telemetry))] == [("topic", 2.0)]
