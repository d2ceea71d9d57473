"""Metering feeds derived from the supplied event table: every event becomes a reading, a request line, a telemetry
event or a log line, so the feeds grow with the table. Only projections: no feed shuffles."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterloom.functions.text import row_hash
from meterloom.functions.times import event_seconds, iso, slot_start
from meterloom.operators.slots import add_up

# Plan periods of the supplied month: its start, 2024-01-10 and 2024-01-20.
PLANS = [(0, "small"), (1704844800, "middle"), (1705708800, "large")]
# List prices of the models below, USD per million tokens: input, output, cache-read ratio.
PRICES = {"model-0": (5.0, 25.0, 0.1), "model-1": (4.0, 20.0, 0.05), "model-2": (2.0, 10.0, 0.1)}
NOW = 1706745600          # 2024-02-01
COMPLETE_THROUGH = 1706572500
FIVE, WEEK = 18000, 604800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with whole seconds `t` and the number `k` of their properties."""
    return table(spark, sf_dir, "events").select(
        "event_id", event_seconds(F.col("ts")).alias("t"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"), "props")


def account_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event. The 5-hour percent climbs through each 5-hour cell and the 7-day one through each week, with
    noise and stale zeros; every fourth cell is idle; resets jitter by a second."""
    e = events(spark, sf_dir)
    t, k, i = F.col("t"), F.col("k"), F.col("event_id")
    into5, into7 = F.pmod(t, F.lit(FIVE)), F.pmod(t, F.lit(WEEK))
    idle = F.pmod(F.floor(t / FIVE), F.lit(4)) == 3
    server = F.pmod(i, F.lit(2)) == 0
    pct5 = F.when(idle | (k % 10 == 9), 0.0).otherwise((F.floor(into5 * 90 / FIVE) + k % 5).cast("double"))
    return e.select(
        i.alias("ingest_id"), t.alias("ts"), iso(t).alias("dt"),
        F.when(server, "claude_api").otherwise("claude_statusline").alias("source"), pct5.alias("five_hour_pct"),
        F.when(~idle, t - into5 + FIVE + i % 3 - 1).alias("five_hour_resets_ts"),
        (F.floor(into7 * 80 / WEEK) + k % 3).cast("double").alias("seven_day_pct"),
        F.when(k < 97, t - into7 + WEEK + i % 2).alias("seven_day_resets_ts"),
        F.when(~server, F.concat(F.lit("s-"), (F.col("user_id") % 50).cast("string"))).alias("observed_by_session"),
        (t + i % 7).alias("written_ts"), F.col("props").alias("raw"),
        row_hash(F.concat_ws("|", i.cast("string"), F.col("props"))).alias("row_hash"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("machine"))


def poll_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("event_type = 'error'")
    return e.select(F.col("event_id").alias("ingest_id"), F.col("t").alias("ts"), iso(F.col("t")).alias("dt"),
                    F.lit("claude_api").alias("source"), F.lit("http").alias("stage"), F.lit("HTTPError").alias("type"),
                    (F.col("k") + 400).cast("int").alias("status"), F.col("k").cast("int").alias("retry_after_s"),
                    F.concat(F.lit('{"error":'), F.col("props"), F.lit("}")).alias("raw"),
                    row_hash(F.col("event_id").cast("string")).alias("row_hash"))


def _folder():
    k, u = F.col("k"), F.col("user_id")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return (F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, text("/home/u", u % 9, "/opt/job", k % 3))
            .when(k % 7 == 2, text("/private/tmp/claude-5/-Users-x-dev-q", k % 4, "/s")).when(k % 7 == 3, text("/Users/u", u % 9))
            .when(k % 7 == 4, text("/srv/w", k % 2)).otherwise(text("/home/u", u % 9, "/dev/p", k % 5, "/sub")))


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event, rolled into slots of every machine; a fortieth of the requests report no cost."""
    e = events(spark, sf_dir)
    k, i = F.col("k"), F.col("event_id")
    rows = e.select(
        slot_start(F.col("t")).alias("ts"), F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("machine"),
        _folder().alias("folder"),
        F.when(k % 3 == 0, "cli").when(k % 3 == 1, "sdk-py").otherwise("").alias("entrypoint"),
        F.when(F.col("event_type") == "error", "<synthetic>")
        .otherwise(F.concat(F.lit("model-"), (F.col("user_id") % 4).cast("string"))).alias("model"),
        k.alias("input_tokens"), (i % 1000).alias("output_tokens"), (k * 10).alias("cache_read_tokens"),
        (k % 20).alias("cache_write_5m_tokens"), (k % 11).alias("cache_write_1h_tokens"),
        F.lit(0).cast("long").alias("cache_write_unknown_tokens"),
        F.when(k % 40 != 7, F.col("value") / 100).alias("cost_usd"))
    return (add_up(rows, ["ts", "machine", "folder", "entrypoint", "model"])
            .withColumn("dt", iso(F.col("ts"))).withColumn("written_ts", F.lit(NOW).cast("long")))


def _request(prefix: str, number):
    return F.concat(F.lit(prefix), number.cast("string"))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript lines: one per event, several per request, some in two files."""
    e = events(spark, sf_dir)
    k, u, i = F.col("k"), F.col("user_id"), F.col("event_id")
    return e.select(
        F.concat(F.lit("f"), (i % 20).cast("string")).alias("path"), F.lit(0).cast("long").alias("block"), i.alias("line"),
        F.col("t").alias("ts"), _request("r", u * 10 + F.floor(k / 10)).alias("request_id"), _request("s", u).alias("session_id"),
        F.when(k % 9 != 0, F.concat(F.lit("/home/u"), (u % 7).cast("string"), F.lit("/dev/p"), (u % 5).cast("string"))).alias("folder"),
        F.when(k % 8 != 0, F.when(u % 2 == 0, "cli").otherwise("sdk-py")).alias("entrypoint"),
        _request("model-", u % 4).alias("model"), k.alias("input_tokens"), (i % 1000).alias("output_tokens"),
        (k * 10).alias("cache_read_tokens"), (k % 20).alias("cache_write_5m_tokens"), (k % 11).alias("cache_write_1h_tokens"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry: one event each. Signups report on requests no transcript has (in pairs, as sent twice; half of their
    sessions have no transcript), all others on transcript requests."""
    e = events(spark, sf_dir)
    k, u, i = F.col("k"), F.col("user_id"), F.col("event_id")
    known = F.col("event_type") != "signup"
    return e.select(
        i.alias("ingest_id"), F.col("t").alias("ts"), iso(F.col("t")).alias("dt"),
        F.when(k % 25 != 0, "api_request").otherwise("api_error").alias("event"),
        _request("s", F.when(known, u).otherwise(u * 2)).alias("session_id"),
        F.when(known, _request("r", u * 10 + F.floor(k / 10))).otherwise(_request("t", F.floor(i / 4))).alias("request_id"),
        _request("model-", u % 4).alias("model"), _request("q", k % 4).alias("query_source"), k.alias("input_tokens"),
        (i % 1000).alias("output_tokens"), (k * 10).alias("cache_read_tokens"), (k % 31).alias("cache_creation_tokens"),
        F.when(k % 6 != 0, F.col("value") / 100).alias("cost_usd"), (F.col("t") + i % 1000).alias("received_ts"),
        F.col("props").alias("raw"), row_hash(i.cast("string")).alias("row_hash"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session snapshots: purchases, the session's cost so far restarting now and then."""
    return _snapshots(events(spark, sf_dir).where("event_type = 'purchase'"))


def all_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session snapshots: one per event."""
    return _snapshots(events(spark, sf_dir))


def _snapshots(e: DataFrame) -> DataFrame:
    i, k = F.col("event_id"), F.col("k")
    return e.select(i.alias("ingest_id"), F.col("t").alias("ts"), iso(F.col("t")).alias("dt"),
                    _request("s", F.col("user_id") % 40).alias("session_id"), _request("model-", k % 2).alias("model_id"),
                    (F.floor(k / 25) / 4).alias("session_cost_usd"),
                    F.concat(F.lit('{"warm":'), (k % 2 == 0).cast("string"), F.lit("}")).alias("prompt_cache"),
                    F.col("t").alias("written_ts"), F.col("props").alias("raw"), row_hash(i.cast("string")).alias("row_hash"))
