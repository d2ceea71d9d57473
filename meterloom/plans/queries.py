"""Every operator as a query over the supplied tables. Each runs on whole tables; the feeds are derived by Spark."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from meterloom import schemas
from meterloom.fixed_values import JUMP_PCT, JUMP_S
from meterloom.functions import numbers, text, times
from meterloom.operators import budgets, dedup, digests, maintenance, quality, reconcile, slots as slot_ops, split, windows
from meterloom.operators.chunks import DAY, asof, id_chunk, running
from meterloom.operators.quantiles import exact_median
from meterloom.plans import feeds, jobs, log_lines
from meterloom.plans.feeds import COMPLETE_THROUGH, NOW, PLANS, PRICES, events, table
from meterloom.session import configure, scratch, settle
from meterloom.sinks import gates
from meterloom.sources import readings as reading_source, telemetry as telemetry_source, transcripts
from meterloom.sources.tables import all_slots, stored
from meterloom.streaming import exchange
from meterloom.streaming.dating import dated
from meterloom.streaming.repeats import drop_repeats, rocksdb
from meterloom.streaming.transcripts import follow_requests, follow_turns
from meterloom.streaming.slots import open_costs, open_slots, slots_stream, with_costs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
COVERS: dict[str, str] = {}


def query(covers: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(configure(spark), sf_dir)
        QUERIES[f.__name__] = run
        COVERS[f.__name__] = covers
        return f
    return add


def _read(spark, sf):
    return windows.readings(feeds.account_quotas(spark, sf), PLANS)


def _seen(spark, sf, kind):
    return windows.first_seen(_read(spark, sf), kind)


def _line(spark, sf):
    return budgets.timeline(_slots(spark, sf))


def _fits(spark, sf, kind):
    return budgets.fits(_seen(spark, sf, kind), _line(spark, sf), kind, PLANS)


def _slots(spark, sf):
    return slot_ops.countable_slots(feeds.slots(spark, sf))


def _active(spark, sf):
    return slot_ops.active_starts(_slots(spark, sf))


def _requests(spark, sf):
    """The working table, stored as jobs store it: arrival numbers as the request numbers, which are unique."""
    r = dedup.largest_output(feeds.request_lines(spark, sf))
    return settle(r.withColumn("ingest_id", F.substring("request_id", F.lit(2), F.length("request_id")).cast("long")), "requests")


def _r6(df: DataFrame) -> DataFrame:
    """Doubles to six places: a sum's last digits depend on its order."""
    return df.select(*[F.round(c, 6).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def _r9(df: DataFrame) -> DataFrame:
    """To nine places: prices of single requests have eight."""
    return df.select(*[F.round(c, 9).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def _longs(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint", "boolean") else F.col(c) for c, t in df.dtypes])


# --- slots and requests -------------------------------------------------------------------------------------------

@query("A1 C8 X1 F2")
def slots_of_events(spark, sf):
    return _r6(feeds.slots(spark, sf).drop("written_ts"))


@query("J1 J2 J3 D4 D5 A1 X3 U1 C6 F2")
def slots_final(spark, sf):
    end = COMPLETE_THROUGH // 300 * 300
    return _r6(slot_ops.build_slots(_requests(spark, sf), feeds.telemetry(spark, sf), "m1", NOW, 0, end))


@query("A1 J1 J2 J3 without the telemetry store")
def slots_without_telemetry(spark, sf):
    return slot_ops.build_slots(_requests(spark, sf), None, "m1", NOW, 0, COMPLETE_THROUGH // 300 * 300).drop("usd")


@query("D4 C9")
def requests_of_lines(spark, sf):
    return dedup.largest_output(feeds.request_lines(spark, sf))


@query("D5 W1")
def telemetry_once(spark, sf):
    return _r6(slot_ops.telemetry_requests(feeds.telemetry(spark, sf)).drop("raw", "row_hash", "dt"))


def _priced(spark, sf):
    usd = numbers.list_price_usd(F.col("model"), *[F.col(c) for c in reconcile.REQUEST_TOKENS], prices=PRICES)
    return (_requests(spark, sf).withColumn("usd", usd).withColumn("dt", times.iso(F.col("ts")))
            .withColumn("machine", F.concat(F.lit("m"), (F.col("ingest_id") % 3).cast("string"))))


@query("A3 J1 J2 J3 C10 U1")
def requests_with_costs(spark, sf):
    return _r9(slot_ops.usage_requests(_priced(spark, sf), feeds.telemetry(spark, sf)))


@query("A2 X2")
def totals_5m_of_all_scans(spark, sf):
    """Totals whose last completed scan is that of any event, not only of errors."""
    used = slot_ops.usage_requests(_priced(spark, sf), feeds.telemetry(spark, sf))
    return _r9(_longs(slot_ops.usage_5m(used, events(spark, sf).select((F.col("t") - 900).alias("complete_through_ts")))))


# --- deduplication ------------------------------------------------------------------------------------------------

@query("D2 D3 C22")
def repeats_dropped(spark, sf):
    e = events(spark, sf).withColumn("half", F.floor(F.col("k") / 50))
    kept = dedup.mark_repeats(e, ["user_id"], [F.col("event_type"), F.col("half")], "event_id")
    return kept.where(~F.col("redundant")).select("event_id", "user_id", "event_type", "half")


@query("D1 C7")
def exact_copies_dropped(spark, sf):
    e = events(spark, sf).select("event_id", F.concat_ws("|", "user_id", "event_type", "props").alias("raw"))
    once = dedup.drop_copies(e.withColumn("row_hash", text.row_hash(F.col("raw"))), by="event_id")
    return once.select("event_id", "raw", "row_hash")


@query("D10 W1")
def spend_per_interval_of_all(spark, sf):
    """The spend between the snapshots of every event."""
    got = dedup.session_spend(feeds.all_snapshots(spark, sf))
    return _r6(got.select("ingest_id", "session_id", "ts", "session_cost_usd", "prev_cost", "spent_usd"))


@query("D6 W1")
def last_purchase_carried(spark, sf):
    """Per user the value of the last purchase, carried to every later event."""
    e = events(spark, sf).select("event_id", "user_id", "event_type", "value")
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return running(e, ["user_id"], [F.col("event_id")], {"last_purchase": ("last_known", bought)}, id_chunk(F.col("event_id"), 4096))


@query("S2 D6 D7 C9 C10")
def turns_of_sessions(spark, sf):
    return _r9(transcripts.turns(log_lines.session_lines(spark, sf), "m1", PRICES))


@query("D8 C24")
def counter_usage(spark, sf):
    got = transcripts.turn_usage(log_lines.session_lines(spark, sf))
    return (got.groupBy(times.month_of(F.col("timestamp")).alias("month"), "model")
            .agg(F.count(F.lit(1)).alias("events"), *[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "cache_read_tokens")]))


# --- log readers --------------------------------------------------------------------------------------------------

@query("S1 D4 C9 C1 X2")
def requests_of_transcripts(spark, sf):
    return transcripts.requests(log_lines.transcript_lines(spark, sf), COMPLETE_THROUGH)


def _growing(spark, sf, lines):
    """A folder for growing files, and per run the lines to write and the time of its last event."""
    e = events(spark, sf)
    dealt = settle(log_lines.run_of(lines, e), "lines-of-runs")
    times_ = log_lines.run_of(e.withColumnRenamed("event_id", "line"), e).groupBy("run").agg(F.max("t").alias("now")).orderBy("run").collect()
    return dealt, [r["now"] for r in times_]


@query("X5 X2 S1 D4")
def requests_of_growing_files(spark, sf):
    """Transcripts written in three runs, files appended to, replaced and cut; each run reads what is new. A request is
    final, with the lines there are, when its first line is 15 minutes old."""
    lines, nows = _growing(spark, sf, log_lines.transcript_lines(spark, sf))
    folder, requests, scans, pending, progress = (scratch(spark, n) for n in ("grown", "requests", "scans", "pending", "progress"))
    for run, now in enumerate(nows):
        log_lines.grow(lines, folder, run)
        follow_requests(spark, folder, requests, scans, pending, progress, now)
    return stored(spark, requests, schemas.REQUESTS).drop("ingest_id")


@query("X5 S2 D6 D7")
def turns_of_growing_files(spark, sf):
    """The second agent's files written in three runs; a file's context is carried from run to run, and a file in another's
    place starts without one."""
    lines, nows = _growing(spark, sf, log_lines.session_lines(spark, sf))
    folder, turns, scans, contexts, progress = (scratch(spark, n) for n in ("grown", "turns", "scans", "contexts", "progress"))
    for run, now in enumerate(nows):
        log_lines.grow(lines, folder, run)
        follow_turns(spark, folder, turns, scans, contexts, progress, "m1", now, prices=PRICES)
    return _r9(stored(spark, turns, schemas.TURNS).drop("ingest_id"))


@query("S3 C17 C18 C13 C19")
def telemetry_of_batches(spark, sf):
    got = telemetry_source.telemetry(log_lines.telemetry_batches(spark, sf))
    # Engines print doubles differently; the raw text is compared without the cost, which has its own column.
    return _r6(got.withColumn("raw", F.regexp_replace("raw", '"cost_usd":[^}]*', '"cost_usd":?')))


@query("S5 C1 C2 C3 C15 C7 D1 D2 K1")
def readings_classified(spark, sf):
    empty = spark.createDataFrame([], schemas.ACCOUNT_QUOTAS)
    got = gates.classify_readings(log_lines.reading_lines(spark, sf), empty, spark.createDataFrame([], schemas.POLL_ERRORS), "claude")
    return _longs(got.select("ingest_id", "outcome", "reason", "is_error", "ts", "source", "five_hour_pct", "five_hour_resets_ts",
                             "observed_by_session", "machine", "status"))


@query("K1 K9 D1 I1")
def readings_stored_twice(spark, sf):
    """The gate in action: the same lines sent twice leave one copy; what was appended is read back."""
    path, errors = scratch(spark, "account"), scratch(spark, "errors")
    lines = log_lines.reading_lines(spark, sf)
    gates.add_readings(lines, path, errors, "claude", dedup=False)
    gates.add_readings(lines, path, errors, "claude", dedup=False)
    return stored(spark, path, schemas.ACCOUNT_QUOTAS).groupBy("source", "machine").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("row_hash").alias("hashes"), F.sum("written_ts").alias("written"))


def _in_batches(lines, add, batches=4):
    """Lines through a gate in as many batches as arrive, in order; the last one twice, as after a crash."""
    n = lines.select((F.max("ingest_id") + 1).alias("n")).scalar()
    dealt = settle(lines.withColumn("_batch", F.floor(F.col("ingest_id") * batches / n)), "arriving")
    for b in [*range(batches), batches - 1]:
        add(dealt.where(F.col("_batch") == b).drop("_batch"), f"batch-{b}")


@query("K1 D2")
def readings_in_batches(spark, sf):
    """What is stored when lines come batch by batch: a session's last reading is looked up beside the store."""
    path, errors = scratch(spark, "account"), scratch(spark, "errors")
    _in_batches(log_lines.reading_lines(spark, sf), lambda rows, batch: gates.add_readings(rows, path, errors, "claude", batch=batch))
    return stored(spark, path, schemas.ACCOUNT_QUOTAS).select("ingest_id", "ts", "source", "five_hour_pct", "observed_by_session")


@query("K2 D3")
def snapshots_in_batches(spark, sf):
    path = scratch(spark, "snapshots")
    _in_batches(_snapshot_lines(spark, sf), lambda rows, batch: gates.add_snapshots(rows, path, batch=batch))
    return stored(spark, path, schemas.SESSION_SNAPSHOTS).select("ingest_id", "ts", "session_id", "session_cost_usd")


def _plan_answers(spark, sf):
    """Overlapping answers: each event of a day tells one finished window per hour of it."""
    e = events(spark, sf)
    hour = F.col("t") - F.pmod(F.col("t"), F.lit(3600))
    period = F.struct(F.when(F.col("k") % 2 == 0, 300).otherwise(10080).alias("window_minutes"), times.iso(hour).alias("starts_at"),
                      times.iso(hour + 3600).alias("ends_at"), (F.col("k") * 1.5).alias("used_basis_points"), F.lit(True).alias("accounting_complete"))
    raw = F.to_json(F.struct(F.col("event_id").alias("ts"), F.lit("codex_plan_limit_history").alias("source"),
                             F.struct(F.array(period).alias("periods")).alias("plan_limit_history")))
    return e.select(F.lit("codex_plan_limit_history").alias("source"), raw.alias("raw"))


@query("S6 D11")
def finished_windows(spark, sf):
    return _longs(reading_source.finished_windows(_plan_answers(spark, sf)))


@query("S7 D11")
def daily_tokens(spark, sf):
    e = events(spark, sf)
    bucket = F.struct(F.substring(times.iso(F.col("t")), 1, 10).alias("startDate"), F.col("k").alias("tokens"))
    raw = F.to_json(F.struct(F.col("event_id").alias("ts"), F.lit("codex_app_server").alias("source"),
                             F.struct(F.array(bucket).alias("dailyUsageBuckets")).alias("codex_usage")))
    return reading_source.daily_tokens(e.select(F.lit("codex_app_server").alias("source"), raw.alias("raw")))


@query("S9")
def product_breakdown(spark, sf):
    e = events(spark, sf)
    rows = F.array(*[F.struct(F.lit(p).alias("key"), (F.col("k") + i).cast("double").alias("percent")) for i, p in enumerate(("chat", "other"))])
    raw = F.to_json(F.struct(F.col("t").alias("ts"), F.struct(F.struct(times.iso(F.col("t")).alias("as_of"), rows.alias("rows"))
                                                              .alias("seven_day_breakdown")).alias("api")))
    got = reading_source.product_breakdown(e.select(F.col("t").alias("ts"), F.lit("claude_api").alias("source"), raw.alias("raw")))
    return got.groupBy("product", times.slot_start(F.col("as_of"), DAY).alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.sum("pct").alias("pct"))


@query("S8 S10")
def costs_and_refusals(spark, sf):
    e = events(spark, sf)
    cost = F.to_json(F.struct(F.lit("cost-state").alias("type"), F.concat(F.lit("s"), F.col("user_id")).alias("sessionId"),
                              (F.col("k") / 4).alias("totalCostUSD"), F.lit(5000).alias("totalDuration"), (F.col("t") * 1000).alias("startTime")))
    refused = F.to_json(F.struct(F.lit("assistant").alias("type"), times.iso(F.col("t")).alias("timestamp"), F.concat(F.lit("s"), F.col("user_id")).alias("sessionId"),
                                 F.struct(F.when(F.col("k") % 2 == 0, "rejected").otherwise("allowed").alias("status"), F.lit("five_hour").alias("rateLimitType"),
                                          (F.col("t") + F.col("k")).alias("resetsAt")).alias("quotaLimits")))
    lines = e.select(F.lit("f").alias("path"), F.lit(0).alias("block"), F.col("event_id").alias("line"),
                     F.when(F.col("event_type") == "error", refused).otherwise(cost).alias("value"))
    costs = transcripts.cost_states(lines).select("session_id", "ts", "usd")
    full = transcripts.refusals(lines).groupBy("session_id").agg(F.count(F.lit(1)).alias("refused"), F.max("resets_ts").alias("resets_ts"))
    return costs.join(full, "session_id", "left")


@query("C20 J6 J15")
def payloads_of_all_dated(spark, sf):
    """Every event is a payload and, up to a few minutes later, an answer of its session."""
    e = events(spark, sf).select("event_id", F.col("user_id").alias("session"), "t", "k")
    answers = e.select("session", (F.col("t") + F.col("k") + 1).alias("answered"))
    hit = asof(e, answers, "t", "answered", ["answered"], "_a", keys=["session"], balanced=True)
    return hit.select("event_id", "session", "t", F.col("_a.answered").alias("observed_at"))


@query("C20 S4 J6")
def payloads_dated_on_arrival(spark, sf):
    """The same as two streams in three runs, each run a backlog with answers on both sides of its payloads. A last
    payload of no transcript moves the watermark past the others."""
    e = settle(log_lines.run_of(events(spark, sf).withColumn("line", F.col("event_id")), events(spark, sf)), "arriving")
    path = F.col("user_id").cast("string").alias("path")
    at = F.timestamp_seconds(F.col("t") + F.col("k") + 1)
    answers = e.select(path, at.alias("at"), F.lit(0).cast("long").alias("block"), "line", (F.col("t") + F.col("k") + 1).alias("ts"), "run")
    shown = e.select(path, F.timestamp_seconds("t").alias("arrived"), F.col("event_id").alias("ingest_id"), F.col("t").cast("string").alias("value"), "run")
    end = e.groupBy().agg(F.timestamp_seconds(F.max("t") + DAY).alias("arrived"))
    flush = end.select(F.lit(None).cast("string").alias("path"), "arrived", F.lit(-1).cast("long").alias("ingest_id"), F.lit("").alias("value"), F.lit(2).alias("run"))
    told, asked, out, progress = (scratch(spark, n) for n in ("answers", "payloads", "dated", "progress"))
    with rocksdb(spark):
        for run in range(log_lines.RUNS):
            answers.where(F.col("run") == run).drop("run").write.mode("append").parquet(told)
            shown.unionByName(flush).where(F.col("run") == run).drop("run").write.mode("append").parquet(asked)
            stream = dated(spark.readStream.schema(shown.drop("run").schema).parquet(asked), spark.readStream.schema(answers.drop("run").schema).parquet(told))
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    return got.select(F.col("ingest_id").alias("event_id"), F.col("path").cast("long").alias("session"), F.col("arrived").alias("t"), "observed_at")


@query("S4 C20 C21")
def payloads_to_lines(spark, sf):
    e = events(spark, sf)
    lines = e.select(F.concat(F.lit("t"), (F.col("user_id") % 50).cast("string")).alias("path"), F.lit(0).alias("block"), F.col("event_id").alias("line"),
                     F.to_json(F.struct(F.when(F.col("event_type") == "view", "assistant").otherwise("user").alias("type"),
                                        F.concat(F.substring(times.iso(F.col("t")), 1, 19), F.when(F.col("user_id") % 10 == 0, "+02:00").otherwise(".5Z")).alias("timestamp"),
                                        F.lit('"type":"assistant"').alias("text"))).alias("value"))
    at = transcripts.observed_at(transcripts.last_answers(lines))
    limits = F.when(F.col("k") % 5 != 0, F.struct(F.struct(F.when(F.col("k") % 3 != 0, F.col("k").cast("double")).alias("used_percentage"),
                                                           F.when(F.col("k") % 2 == 0, "").otherwise("2026-01-01T00:00:00Z").alias("resets_at")).alias("five_hour")))
    payload = F.to_json(F.struct(F.concat(F.lit("t"), (F.col("user_id") % 60).cast("string")).alias("transcript_path"),
                                 F.when(F.col("k") % 4 == 0, "../x").otherwise(F.concat(F.lit("s"), F.col("user_id"))).alias("session_id"),
                                 F.struct((F.col("k") / 4).alias("total_cost_usd")).alias("cost"), limits.alias("rate_limits")))
    account, session = reading_source.payload_rows(e.select("event_id", payload.alias("value")), at, F.lit(NOW), "m1")
    get = lambda p: F.get_json_object("value", p)
    a = account.select("event_id", get("$.observed_at").cast("long").alias("observed_at"), get("$.five_hour_pct").cast("double").alias("pct"),
                       get("$.five_hour_resets_at").alias("resets_at"))
    s = session.select("event_id", "session_id", get("$.session_cost_usd").cast("double").alias("cost"))
    return a.join(s, "event_id", "left")


def _snapshot_lines(spark, sf):
    """Snapshot lines with seeded faults."""
    e = events(spark, sf)
    fault = F.col("event_id") % 17
    day = times.slot_start(F.col("t"), DAY)
    extra = (F.when(fault == 1, F.lit('{"deep":[{"fivePercent":1}]}')).when(fault == 2, F.lit('{"note":"say \\"pct\\": 1"}'))
             .when(F.col("k") % 2 == 0, F.lit('{"a":1,"b":2}')).otherwise(F.lit('{"b":2,"a":1}')))
    value = F.concat(F.lit('{"ts":'), F.col("t").cast("string"), F.lit(',"source":"claude_statusline","observed_at":'), day.cast("string"),
                     F.lit(',"model_id":"m","session_cost_usd":'), F.when(fault == 3, F.lit('"1"')).otherwise(F.floor(F.col("k") / 50).cast("string")),
                     F.lit(',"prompt_cache":'), extra, F.lit("}"))
    session = F.when(fault == 4, F.lit("account")).when(fault == 5, F.lit("a/b")).otherwise(F.concat(F.lit("s"), (F.col("user_id") % 30).cast("string")))
    return settle(e.select(F.col("event_id").alias("ingest_id"), value.alias("value"), session.alias("session_id")), "snapshot-lines")


@query("K2 C14 C16 C19")
def session_lines_classified(spark, sf):
    """Snapshot lines through the session gate's checks."""
    held = spark.createDataFrame([], schemas.SESSION_SNAPSHOTS)
    return gates.classify_snapshots(_snapshot_lines(spark, sf), held).select("ingest_id", "outcome", "reason", "ts", "session_cost_usd")


@query("K2")
def snapshots_stored_twice(spark, sf):
    """Every good line once, however often it is sent."""
    path, lines = scratch(spark, "snapshots"), _snapshot_lines(spark, sf)
    for _ in range(2):
        gates.add_snapshots(lines, path, dedup=False)
    return stored(spark, path, schemas.SESSION_SNAPSHOTS).groupBy("session_id").agg(F.count(F.lit(1)).alias("rows"), F.max("ts").alias("ts"))


@query("K3 K4")
def telemetry_stored_twice(spark, sf):
    """Flattened telemetry lines sent twice, and a scan told twice."""
    path, scans = scratch(spark, "telemetry"), scratch(spark, "scans")
    told = telemetry_source.telemetry(log_lines.telemetry_batches(spark, sf)).select("raw").withColumnRenamed("raw", "value")
    lines = settle(told.withColumn("ingest_id", F.monotonically_increasing_id()), "telemetry-lines")
    for _ in range(2):
        gates.add_telemetry(lines, path)
        gates.add_scan(spark, scans, NOW, COMPLETE_THROUGH, 0)
    n = stored(spark, scans, schemas.SCANS).select(F.count(F.lit(1))).scalar()
    return stored(spark, path, schemas.TELEMETRY).groupBy("event").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("input_tokens").alias("input_tokens"), F.first(n).alias("scans"))


@query("K4 D4 T2")
def requests_in_batches(spark, sf):
    """Each batch brings new requests and, as a resumed session does, those of the batches before it: every id once."""
    path = scratch(spark, "requests")
    found = transcripts.requests(log_lines.transcript_lines(spark, sf))
    last = found.select((F.max("ts") + 1).alias("v")).scalar()
    first = found.select(F.min("ts").alias("v")).scalar()
    dealt = settle(found.withColumn("_batch", F.floor((F.col("ts") - first) * 3 / (last - first))), "arriving")
    for b in range(3):
        jobs.store_requests(dealt.where(F.col("_batch") <= b).drop("_batch"), path)
    return stored(spark, path, schemas.REQUESTS).withColumnRenamed("ingest_id", "place").select("place", "request_id", "ts", "output_tokens")


@query("K8 K6")
def slots_received(spark, sf):
    """Another machine's slots, sent as lines, twice."""
    path = scratch(spark, "received")
    row = F.struct(*gates.column_names(schemas.SLOTS))
    line = F.to_json(F.struct(F.lit("claude").alias("agent"), F.lit("slots").alias("table"), row.alias("row")), {"ignoreNullFields": "false"})
    lines = settle(feeds.slots(spark, sf).where("machine = 'm1'").select(line.alias("value")), "slot-lines")
    for _ in range(2):
        gates.receive_slots(lines, path, "m1", "hub")
    return _r6(stored(spark, path, schemas.SLOTS).groupBy("machine").agg(
        F.count(F.lit(1)).alias("slots"), F.sum("requests").alias("requests"), F.sum("usd").alias("usd")))


@query("M1 M4")
def requests_rebuilt(spark, sf):
    """The working table made anew from the same logs holds the same facts."""
    lines, paths = log_lines.transcript_lines(spark, sf), [scratch(spark, f"requests-{n}") for n in (1, 2)]
    for path in paths:
        jobs.store_requests(transcripts.requests(lines, COMPLETE_THROUGH), path)
    old, new = (stored(spark, p, schemas.REQUESTS) for p in paths)
    return maintenance.check_facts(old, new, reconcile.REQUEST_TOKENS)


def _stores_in(spark, sf, batches):
    """Requests stored, and slots written, in so many runs: the paths of both."""
    paths = {n: scratch(spark, n) for n in ("requests", "telemetry", "scans", "slots")}
    found = settle(transcripts.requests(log_lines.transcript_lines(spark, sf), COMPLETE_THROUGH), "found")
    low, high = found.agg(F.min("ts"), F.max("ts") + 1).first()
    ends = [low + (high - low) * (b + 1) // batches for b in range(batches)]
    for start, end in zip([low, *ends], ends):
        jobs.store_requests(found.where((F.col("ts") >= start) & (F.col("ts") < end)).drop("dt"), paths["requests"])
        feeds.telemetry(spark, sf).where((F.col("ts") >= F.lit(start if start > low else 0)) & ((F.col("ts") < end) | F.lit(end == high))).write.mode(
            "append").parquet(paths["telemetry"])
    for end in [*ends[:-1], COMPLETE_THROUGH]:
        gates.add_scan(spark, paths["scans"], NOW, end, 0)
        jobs.write_slots(spark, paths["requests"], paths["telemetry"], paths["scans"], paths["slots"], "m1", NOW)
    return stored(spark, paths["requests"], schemas.REQUESTS), stored(spark, paths["slots"], schemas.SLOTS)


@query("X3 J1 J2 J3 K6 F2")
def slots_in_three_runs(spark, sf):
    """Each run reads the files of its own time range, and those that may hold its requests and sessions."""
    return _r6(_stores_in(spark, sf, 3)[1].drop("written_ts"))


@query("M1 M4")
def stores_rebuilt(spark, sf):
    """A store made by three runs beside one rebuilt from the raw logs in one; then the slots again after one was changed
    and one taken out, which must be found."""
    (requests, slots_), (again, slots_again) = _stores_in(spark, sf, 3), _stores_in(spark, sf, 1)
    keyed = lambda df: df.withColumn("slot", F.to_json(F.struct(*schemas.SLOT_KEY)))
    old, new = settle(keyed(slots_), "old-slots"), keyed(slots_again)
    first, last = new.agg(F.min("slot"), F.max("slot")).first()
    spoiled = new.where(F.col("slot") != last).withColumn("requests", F.col("requests") + F.when(F.col("slot") == first, 1).otherwise(0))
    values = ["requests", *reconcile.REQUEST_TOKENS, "tokens_without_usd"]
    told = {"requests": reconcile.compare_facts(requests, again, reconcile.REQUEST_TOKENS), "slots": reconcile.compare_facts(old, new, values, "slot"),
            "spoiled slots": reconcile.compare_facts(old, spoiled, values, "slot")}
    return reduce(DataFrame.unionByName, [reconcile.fact_counts(c).withColumn("what", F.lit(name)) for name, c in told.items()])


@query("M6")
def slots_moved(spark, sf):
    path = scratch(spark, "moved")
    maintenance.move_slots(spark, feeds.slots(spark, sf).select(*gates.column_names(schemas.SLOTS)), path)
    return stored(spark, path, schemas.SLOTS).groupBy("machine").agg(F.count(F.lit(1)).alias("slots"), F.sum("requests").alias("requests"))


@query("T2")
def slots_in_order(spark, sf):
    """Every slot with its place in the order of time, folder, entrypoint, model and machine."""
    key = ["ts", "folder", "entrypoint", "model", "machine"]
    return jobs.in_order(feeds.slots(spark, sf).select(*key), 0, key).withColumnRenamed("ingest_id", "place")


@query("C16")
def slot_faults(spark, sf):
    fault = F.col("input_tokens") % 13
    rows = (feeds.slots(spark, sf).withColumn("requests", F.when(fault == 1, F.lit(-1)).otherwise(F.col("requests")))
            .withColumn("dt", F.when(fault == 2, F.lit("x")).otherwise(F.col("dt")))
            .withColumn("machine", F.when(fault == 3, F.lit("a b")).otherwise(F.col("machine")))
            .withColumn("model", F.when(fault == 4, F.lit(None)).otherwise(F.col("model"))))
    return rows.groupBy(F.coalesce(gates.slot_fault(), F.lit("good")).alias("fault")).agg(F.count(F.lit(1)).alias("rows"))


# --- meter windows ------------------------------------------------------------------------------------------------

@query("A4 J4 C5 S12")
def windows_5h(spark, sf):
    return _longs(windows.windows(_seen(spark, sf, "5h"), "5h", PLANS))


@query("A4 J4 C5 S12")
def windows_7d(spark, sf):
    return _longs(windows.windows(_seen(spark, sf, "7d"), "7d", PLANS))


@query("D9 C5 J4 W1")
def steps_5h(spark, sf):
    return windows.steps(_seen(spark, sf, "5h"), "5h", PLANS).select("plan", "reset", "ts", "pct")


@query("D9 C5 J4 W1")
def steps_7d(spark, sf):
    return windows.steps(_seen(spark, sf, "7d"), "7d", PLANS).select("plan", "reset", "ts", "pct")


def _gaps(spark, sf):
    return windows.gaps(_read(spark, sf), _seen(spark, sf, "5h"), _active(spark, sf), plans=PLANS)


@query("J6 J8 J16")
def gaps_between_windows(spark, sf):
    return _gaps(spark, sf).select(
        "plan", "prev_end", "start", "gap", "readings", "nulls", "active", "lag_min")


@query("A18")
def gap_statistics(spark, sf):
    return _r6(windows.gap_summary(_gaps(spark, sf)))


@query("A23")
def gap_anomalies(spark, sf):
    return windows.gap_anomalies(_gaps(spark, sf)).select("plan", "prev_end", "start", "anomaly")


@query("A20")
def activity_outside_windows(spark, sf):
    return windows.outside_windows(windows.windows(_seen(spark, sf, "5h"), "5h", PLANS), _active(spark, sf))


@query("A19")
def window_coverage(spark, sf):
    return _r6(windows.coverage(windows.windows(_seen(spark, sf, "5h"), "5h", PLANS)))


@query("A24 J6 J16")
def window_ledger(spark, sf):
    return _r6(windows.ledger(_seen(spark, sf, "7d"), _active(spark, sf), "7d", plans=PLANS))


@query("A21 J6")
def no_window_runs(spark, sf):
    return _longs(windows.no_window_runs(_read(spark, sf), _active(spark, sf)))


@query("J9")
def readings_across_resets(spark, sf):
    got = windows.across_resets(_read(spark, sf), _seen(spark, sf, "7d"), PLANS)
    return got.select("plan", "end", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("before", "after") for c in ("ts", "pct_5h", "end_5h", "pct_7d")])


@query("A27")
def saturated_windows(spark, sf):
    read = _read(spark, sf).withColumn("pct_5h", F.col("pct_5h") + 8)
    return windows.saturation(windows.steps(windows.first_seen(read, "5h"), "5h", PLANS))


@query("A22")
def meter_jumps(spark, sf):
    return windows.jumps(windows.steps(_seen(spark, sf, "5h"), "5h", PLANS), JUMP_PCT, JUMP_S * 2)


@query("A25")
def reading_compression(spark, sf):
    return windows.compression(_read(spark, sf), _seen(spark, sf, "5h"), "5h", PLANS)


# --- budgets ------------------------------------------------------------------------------------------------------

@query("A5 J5")
def spent_in_windows(spark, sf):
    win = windows.windows(_seen(spark, sf, "5h"), "5h", PLANS)
    return _r6(budgets.spent_in_windows(win, _line(spark, sf), "5h").select("plan", "reset", *budgets.SPENT))


@query("A6 A5 J5 D9")
def budgets_5h(spark, sf):
    return _r6(budgets.budget_table(_fits(spark, sf, "5h")).drop("cut"))


@query("A6 A5 J5 D9")
def budgets_7d(spark, sf):
    return _r6(_fits(spark, sf, "7d").drop("cut"))


@query("A7 J7")
def windows_per_week(spark, sf):
    return _r6(budgets.windows_per_week(_seen(spark, sf, "5h"), _seen(spark, sf, "7d"), PLANS))


@query("A8 A7 A6")
def plan_summary(spark, sf):
    five, week, line = _seen(spark, sf, "5h"), _seen(spark, sf, "7d"), _line(spark, sf)
    return _r6(budgets.plan_summary(budgets.fits(five, line, "5h", PLANS), budgets.fits(week, line, "7d", PLANS),
                                    budgets.windows_per_week(five, week, PLANS)))


@query("A9")
def one_percent_mix(spark, sf):
    line = _line(spark, sf)
    return _r6(budgets.one_percent_mix(budgets.fits(_seen(spark, sf, "5h"), line, "5h", PLANS), line))


# --- cost split ---------------------------------------------------------------------------------------------------

@query("A10 T1 C11 F1")
def split_week_by_project(spark, sf):
    placed = split.placed_in_windows(_slots(spark, sf), split.GROUPS["project"](), split.periods(_seen(spark, sf, "7d"), "7d", plans=PLANS))
    return _r6(_longs(split.cost_split(placed, 4).drop("position")))


@query("A10 C12 F1")
def split_5h_by_kind(spark, sf):
    placed = split.placed_in_windows(_slots(spark, sf), split.GROUPS["kind"](), split.periods(_seen(spark, sf, "5h"), "5h", 1705104000, plans=PLANS))
    return _r6(_longs(split.cost_split(placed).drop("position")))


@query("A10 F1")
def split_day_by_machine(spark, sf):
    placed = split.placed_in_days(_slots(spark, sf), split.GROUPS["machine"](), 1704499200, plans=PLANS)
    return _r6(_longs(split.cost_split(placed).drop("position", "peak")))


@query("A10")
def split_totals(spark, sf):
    return _r6(split.period_totals(split.placed_in_days(_slots(spark, sf), split.GROUPS["model"](), 0, plans=PLANS)))


@query("A10")
def groups_over_all_periods(spark, sf):
    placed = split.placed_in_windows(_slots(spark, sf), split.GROUPS["project"](), split.periods(_seen(spark, sf, "5h"), "5h", plans=PLANS))
    return _r6(split.group_totals(placed))


@query("A11")
def slots_outside_periods(spark, sf):
    return split.outside_periods(_slots(spark, sf), split.periods(_seen(spark, sf, "5h"), "5h", plans=PLANS))


@query("C11")
def page_projects(spark, sf):
    """Page addresses as folders of repositories."""
    p = table(spark, sf, "pages")
    folder = F.concat(F.lit("/home/"), F.regexp_extract("url", "^https?://([^/]+)", 1), F.when(F.col("page_id") % 3 == 0, "/dev").otherwise(""),
                      F.regexp_extract("url", "^https?://[^/]+(/[^?#]*)", 1))
    return p.groupBy(text.project(folder).alias("project")).agg(F.count(F.lit(1)).alias("pages"))


@query("A10 J1")
def revenue_by_month_and_segment(spark, sf):
    """Revenue per month and customer segment with both totals. Line items fold onto their order, and orders onto their
    customer and month, before the next join: a customer with a third of the orders is one row per month."""
    l = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"), F.count(F.lit(1)).alias("n"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                                          F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM").alias("month"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    per = o.join(l, "o_orderkey").groupBy("c_custkey", "month").agg(F.sum("rev").alias("rev"), F.sum("n").alias("n"))
    got = per.join(c, "c_custkey").rollup("month", "c_mktsegment").agg(
        F.sum("rev").alias("revenue"), F.sum("n").alias("lines"))
    return got.select("month", "c_mktsegment", F.round("revenue", 4).alias("revenue"), "lines")


# --- freshness and quality ----------------------------------------------------------------------------------------

@query("R1 I5")
def latest_reading(spark, sf):
    return quality.latest(feeds.account_quotas(spark, sf), 1706563000)


@query("A17")
def newest_age(spark, sf):
    return quality.newest_age(feeds.account_quotas(spark, sf), NOW)


@query("A16")
def last_attempt(spark, sf):
    return quality.last_attempt(feeds.account_quotas(spark, sf), feeds.poll_errors(spark, sf), ["claude_api"])


@query("X9")
def stale_source(spark, sf):
    scans = events(spark, sf).select(F.col("t").alias("ts"))
    return _longs(quality.staleness(scans, NOW))


@query("A25")
def key_sets(spark, sf):
    e = events(spark, sf)
    raw = F.to_json(F.struct(F.when(F.col("k") % 2 == 0, 1).alias("b"), F.when(F.col("k") % 3 == 0, 1).alias("a"), F.lit(1).alias("c")))
    return quality.key_sets(e.select(raw.alias("raw")))


@query("A25")
def rows_per_machine(spark, sf):
    return quality.rows_per(feeds.account_quotas(spark, sf), "machine", "source")


@query("A25")
def failure_rates(spark, sf):
    return _r6(quality.failure_rates(feeds.account_quotas(spark, sf), feeds.poll_errors(spark, sf)))


@query("A25")
def fractional_percents(spark, sf):
    a = feeds.account_quotas(spark, sf)
    return quality.fractional_percents(a.withColumn("five_hour_pct", F.col("five_hour_pct") + F.col("ingest_id") % 2 / 2))


@query("A26")
def telemetry_lateness(spark, sf):
    return quality.lateness(feeds.telemetry(spark, sf))


@query("A26 D4")
def lines_per_request(spark, sf):
    return _r6(quality.lines_per_request(feeds.request_lines(spark, sf)))


@query("A26 J1")
def shipping_lateness(spark, sf):
    # AQE splits an order with very many lines: the join is inner, and nothing after it needs its partitioning.
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), times.event_seconds(F.col("l_shipdate")).alias("received_ts"))
    o = table(spark, sf, "orders").select("o_orderkey", times.event_seconds(F.col("o_orderdate")).alias("ts"))
    return quality.lateness(l.join(o, "o_orderkey"))


# --- reconciliation -----------------------------------------------------------------------------------------------

def _stores(spark, sf):
    a = feeds.account_quotas(spark, sf)
    part = F.col("ingest_id") % 10
    return a.where(part < 7), a.where(part >= 4)


@query("J10 U3")
def shared_hashes(spark, sf):
    return reconcile.shared_hashes(*_stores(spark, sf))


@query("J10 J13")
def shared_by_source(spark, sf):
    return reconcile.shared_by_source(*_stores(spark, sf))


@query("J11 U4")
def missing_readings(spark, sf):
    a, b = _stores(spark, sf)
    return reconcile.missing_from(a, b).select("ingest_id", "row_hash")


@query("J13 M2")
def machine_labels(spark, sf):
    a, b = _stores(spark, sf)
    old = a.withColumn("machine", F.when(F.col("ingest_id") % 3 == 0, F.col("machine")))
    return reconcile.label_machine(old, reconcile.shared_hashes(a, b), "mac").groupBy("machine").agg(F.count(F.lit(1)).alias("rows"))


@query("K10 I1")
def merged_stores(spark, sf):
    a, b = _stores(spark, sf)
    to_a, to_b = exchange.merge_both_ways(a, b, "m0", "m1")
    return to_b.select(F.lit("to b").alias("way"), "ingest_id").unionByName(to_a.select(F.lit("to a").alias("way"), "ingest_id"))


def _copies(spark, sf):
    old = _requests(spark, sf)
    new = old.where(F.col("ingest_id") % 11 != 0).withColumn(
        "output_tokens", F.when(F.col("ingest_id") % 13 == 0, F.col("output_tokens") + 1).otherwise(F.col("output_tokens")))
    return old, new


@query("J12 M4")
def compared_facts(spark, sf):
    return reconcile.fact_counts(reconcile.compare_facts(*_copies(spark, sf), reconcile.REQUEST_TOKENS))


@query("J12 M4")
def compared_by_digests(spark, sf):
    """As compared_facts; only buckets whose digests differ are joined."""
    return digests.compare_stores(*_copies(spark, sf), reconcile.REQUEST_TOKENS)


@query("J12 M4")
def one_changed_fact(spark, sf):
    """A store beside itself with one value changed."""
    old = settle(_requests(spark, sf), "facts")
    last = old.agg(F.max("ingest_id")).first()[0]
    new = old.withColumn("output_tokens", F.col("output_tokens") + F.when(F.col("ingest_id") == last, 1).otherwise(0))
    return digests.compare_stores(old, new, reconcile.REQUEST_TOKENS)


@query("J11 U4")
def missing_by_digests(spark, sf):
    a, b = _stores(spark, sf)
    return digests.missing(a, b).select("ingest_id", "row_hash")


@query("A15 M4")
def slots_recounted(spark, sf):
    r, t = _requests(spark, sf), feeds.telemetry(spark, sf)
    end = COMPLETE_THROUGH // 300 * 300
    return _r6(reconcile.check_slots(slot_ops.build_slots(r, t, "m1", NOW, 0, end), r, t, end))


@query("J14")
def token_mismatches(spark, sf):
    return reconcile.token_mismatches(reconcile.matched_requests(_requests(spark, sf), feeds.telemetry(spark, sf)))


@query("A12 C10 J14")
def price_errors(spark, sf):
    matched = reconcile.matched_requests(_requests(spark, sf), feeds.telemetry(spark, sf))
    return _r6(reconcile.price_errors(matched, PRICES))


@query("A13 J2")
def telemetry_only_cost(spark, sf):
    return _r6(reconcile.telemetry_only_cost(_requests(spark, sf), feeds.telemetry(spark, sf)))


@query("A14 C23 C24 C10")
def monthly_differences(spark, sf):
    r = _requests(spark, sf)
    ours = reconcile.monthly(r, times.month_of(times.iso(F.col("ts"))))
    ref = (r.where("ingest_id % 7 <> 0").groupBy(times.month_of(times.iso(F.col("ts"))).alias("month"), "model")
           .agg(F.sum("input_tokens").alias("ref_input"), F.sum("output_tokens").alias("ref_output"), F.sum("cache_read_tokens").alias("ref_cache_read")))
    return _r6(_longs(reconcile.monthly_against(ours, ref, PRICES)))


@query("J12 A12 C23")
def orders_reconciled(spark, sf):
    """Order totals against the sum of their lines, per status. Lines fold onto their order before the join."""
    l = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("lines_total"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").join(l, "o_orderkey", "left")
    d = numbers.difference(F.col("o_totalprice"), F.col("lines_total"))
    return o.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("lines_total").isNull()).alias("without_lines"), F.count_if(d["is_equal"]).alias("equal"),
        F.round(F.sum(d["abs_diff"]), 2).alias("total_diff"), F.count_if(F.abs(d["rel_diff"]) > 0.01).alias("off_by_1_percent"))


@query("A12")
def median_price_per_flag(spark, sf):
    """Exact medians of groups that may each hold a third of the table."""
    return _r6(exact_median(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice"))


@query("C10")
def priced_lines(spark, sf):
    """Line items priced from a price dimension, the parts."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("price"), F.col("p_brand").alias("brand"))
    l = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"), F.sum("l_linenumber").alias("n"))
    usd = numbers.priced_usd(F.col("price"), F.col("price") * 5, F.lit(0.1), F.col("q"), F.col("n"), F.col("q"), F.col("n"), F.col("q"))
    return l.join(p, "l_partkey").groupBy("brand").agg(F.round(F.sum(usd), 6).alias("usd"), F.sum("q").alias("quantity"))


# --- small expressions, sets, pages -------------------------------------------------------------------------------

def _time_expressions(e):
    stamp = F.concat(F.substring(times.iso(F.col("t")), 1, 19), F.lit(".750+00:00"))
    return e.select("event_id", times.epoch_seconds(stamp).alias("from_iso"), times.epoch_seconds(F.col("t").cast("string")).alias("from_text"),
                    times.epoch_seconds(F.lit("")).alias("from_blank"), times.month_of(times.iso(F.col("t"))).alias("month"),
                    times.minute_label(F.col("t")).alias("minute"), times.slot_start(F.col("t")).alias("slot"),
                    numbers.whole_percent(F.col("k") + 0.5).cast("long").alias("rounded"), times.snap(F.col("k") * 100).alias("snapped"))


@query("F2")
def time_expressions(spark, sf):
    """The expressions over a half-open range (F2)."""
    return _time_expressions(events(spark, sf).where((F.col("t") >= 1704153600) & (F.col("t") < 1705968000)))


@query("C1 C4 C6 C8 C24")
def time_expressions_of_all(spark, sf):
    return _time_expressions(events(spark, sf))


@query("C22")
def canonical_properties(spark, sf):
    """Equal JSON objects written with their keys in another order."""
    e = events(spark, sf)
    a = F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit(', "k":'), F.col("k").cast("string"), F.lit("}"))
    b = F.concat(F.lit('{"k":'), F.when(F.col("k") % 5 == 0, F.col("k") + 1).otherwise(F.col("k")).cast("string"), F.lit(',"user":'), F.col("user_id").cast("string"), F.lit("}"))
    return e.groupBy((text.canonical_json(a) == text.canonical_json(b)).cast("long").alias("same")).agg(F.count(F.lit(1)).alias("rows"))


@query("C25")
def idle_countdown_dropped(spark, sf):
    e = events(spark, sf).select("event_id", F.col("t").alias("ts"), (F.col("k") % 2).cast("double").alias("pct"),
                                 (F.col("t") + 18000 + (F.col("event_id") % 200) - 100).alias("resets"))
    return reading_source.drop_idle_countdown(e, "pct", "resets", 18000)


@query("C26")
def shifted_times(spark, sf):
    e = events(spark, sf)
    late = (F.col("event_type") == "view") & (F.col("t") < 1705276800) & ~times.in_summer_time(F.col("t"), "Europe/Paris")
    return e.select("event_id", times.shift_if(F.col("t"), late).alias("ts"))


@query("T3 K7")
def one_page(spark, sf):
    return exchange.new_rows(feeds.account_quotas(spark, sf), 500, "m1", 1000).select("ingest_id", "machine")


@query("S11 U2 K6")
def slots_by_machine(spark, sf):
    """Slots through the slot gate into a folder per machine, and back without the error stubs."""
    path = scratch(spark, "slots")
    gates.add_slots(feeds.slots(spark, sf), path)
    gates.add_slots(feeds.slots(spark, sf).where("machine = 'm1'"), path, "m1")
    back = all_slots(spark, path)
    return _r6(back.groupBy("machine").agg(F.count(F.lit(1)).alias("slots"), F.sum("tokens").alias("tokens"), F.sum("usd").alias("usd")))


@query("M5")
def backed_up(spark, sf):
    path = scratch(spark, "readings")
    feeds.account_quotas(spark, sf).write.parquet(path)
    return maintenance.back_up(spark, {"account_quotas": (path, schemas.ACCOUNT_QUOTAS)}, scratch(spark, "backup"))


@query("M3 J11")
def seeded_store(spark, sf):
    a, b = _stores(spark, sf)
    path = scratch(spark, "seeded")
    b.write.parquet(path)
    maintenance.seed(spark, a, path, reconcile.shared_hashes(a, b), "mac")
    return stored(spark, path, schemas.ACCOUNT_QUOTAS).groupBy("machine").agg(F.count(F.lit(1)).alias("rows"))


# --- streams over copies of the tables ----------------------------------------------------------------------------

def _copy(spark, rows, name, files=4, order="t"):
    """A table as files in event-time order, as a log lands."""
    path = scratch(spark, name)
    rows.repartitionByRange(files, order).sortWithinPartitions(order).write.parquet(path)
    return path


def _finish(spark, stream, checkpoint_name):
    """Runs a stream to its end into a table of the shared folder and reads the table."""
    out = scratch(spark, checkpoint_name)
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "progress"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _request_feed(spark, sf):
    e = events(spark, sf)
    k = F.col("k")
    zero = F.lit(0).cast("long")
    return e.select("t", F.timestamp_seconds("t").alias("at"), F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("machine"),
                    F.lit("").alias("folder"), F.col("event_type").alias("entrypoint"), F.lit("m").alias("model"),
                    F.col("event_id").cast("string").alias("request_id"), k.alias("input_tokens"), (k % 7).alias("output_tokens"),
                    *[zero.alias(c) for c in ("cache_read_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens", "cache_write_unknown_tokens")],
                    F.when(k % 3 != 0, F.col("value")).alias("cost_usd"))


@query("X1 X2 X3 X4")
def slots_from_stream(spark, sf):
    """Every slot of a finished file stream: those it wrote, and those it left open."""
    feed = _request_feed(spark, sf)
    path = _copy(spark, feed, "requests")
    stream = spark.readStream.schema(feed.schema).parquet(path)
    written = _finish(spark, slots_stream(stream), "stream-slots")
    return _r6(written.unionByName(open_slots(spark.read.schema(feed.schema).parquet(path), written)))


@query("X6 K7")
def slots_replicated(spark, sf):
    source, target = scratch(spark, "sent"), scratch(spark, "received")
    feeds.slots(spark, sf).select(*gates.column_names(schemas.SLOTS)).write.parquet(source)
    for _ in range(2):
        exchange.replicate_slots(spark, source, target, scratch(spark, "progress"), "m1")
    return stored(spark, target, schemas.SLOTS).groupBy("machine").agg(F.count(F.lit(1)).alias("slots"), F.sum("requests").alias("requests"))


@query("X7 D2")
def repeats_dropped_in_stream(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "event_type", F.floor(F.col("k") / 50).alias("half"))
    path = _copy(spark, e, "events", order="event_id")
    stream = spark.readStream.schema(e.schema).parquet(path)
    with rocksdb(spark):
        return _finish(spark, drop_repeats(stream, ["user_id"], ["event_type", "half"], "event_id"), "kept")


@query("X8")
def costs_from_two_streams(spark, sf):
    feed = _request_feed(spark, sf).drop("cost_usd")
    told = events(spark, sf).where("k % 3 <> 0").select("t", F.col("event_id").cast("string").alias("request_id"),
                                                        F.timestamp_seconds(F.col("t") + F.col("k")).alias("reported_at"), F.col("value").alias("cost_usd"))
    asked, reported = _copy(spark, feed, "requests"), _copy(spark, told, "told")
    a = spark.readStream.schema(feed.schema).parquet(asked).select("request_id", "at", "machine")
    b = spark.readStream.schema(told.schema).parquet(reported)
    got = _finish(spark, with_costs(a, b), "with-costs").select("request_id", "machine", "cost_usd")
    rest = open_costs(spark.read.schema(feed.schema).parquet(asked).select("request_id", "at", "machine"),
                      spark.read.schema(told.schema).parquet(reported), got)
    return got.unionByName(rest.select(*got.columns)).groupBy("machine").agg(
        F.count(F.lit(1)).alias("requests"), F.count("cost_usd").alias("with_cost"), F.round(F.sum("cost_usd"), 6).alias("usd"))
