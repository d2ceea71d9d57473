"""Meter readings: landed poll answers and display payloads, plan history, daily buckets, product breakdown."""

from pyspark.sql import Column, DataFrame, functions as F

from meterloom import schemas
from meterloom.fixed_values import (APP_SERVER_SOURCE, DEFAULT_SOURCE, PLAN_HISTORY_SOURCE, POLL_SOURCE, PUSH_SOURCE,
                                    READING_SOURCES, SESSION_ONLY_KEYS)
from meterloom.functions.numbers import is_missing, number
from meterloom.functions.text import blank_to_null, row_hash, session_or_null, valid_machine
from meterloom.functions.times import epoch_seconds, iso
from meterloom.operators.dedup import last_by
from meterloom.sources.lines import computed, parsed


def reading_columns(lines: DataFrame, agent: str, machine: Column | None = None) -> DataFrame:
    """Landed reading lines (`value`) in typed columns, with `reason` saying why a line must not be stored and
    `is_error` telling failed polls. Fields whose JSON type matters arrive as VARIANT: a percent that is a text or a bool
    is refused, not turned into NULL. `machine` names the machine of lines that do not say it."""
    rest = [c for c in lines.columns if c != "value"]
    lines = lines.where(F.col("value").rlike(r"\S"))  # a blank line is no reading, not a refused one
    j = parsed(lines.withColumn("_machine", machine if machine is not None else F.lit(None).cast("string")),
               schemas.READING_LINE, *rest, "value", "_machine")
    source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit(DEFAULT_SOURCE[agent]).cast("string"))
    limits = F.col("codex_rate_limits.rateLimits")

    def meter(minutes: int, pushed: str, polled: str, counted: str) -> Column:
        by_length = (F.when(limits["secondary"]["windowDurationMins"] == minutes, limits["secondary"][counted])
                     .when(limits["primary"]["windowDurationMins"] == minutes, limits["primary"][counted]))
        return (F.when(source == PUSH_SOURCE, F.col(pushed)).when(source == POLL_SOURCE, F.col(polled))
                .when(source == APP_SERVER_SOURCE, by_length))

    flat = j.select(
        *rest, "value", source.alias("source"), F.ltrim("value").startswith("{").alias("_object"), F.col("ts").alias("_ts"),
        number(F.col("ts"), "long").alias("written_ts"), number(F.col("observed_at"), "long").alias("_observed"),
        meter(300, "five_hour_pct", "api.five_hour.utilization", "usedPercent").alias("_p5"),
        meter(300, "five_hour_resets_at", "api.five_hour.resets_at", "resetsAt").alias("_r5"),
        meter(10080, "seven_day_pct", "api.seven_day.utilization", "usedPercent").alias("_p7"),
        meter(10080, "seven_day_resets_at", "api.seven_day.resets_at", "resetsAt").alias("_r7"),
        F.when(source == PUSH_SOURCE, F.col("observed_by_session")).alias("observed_by_session"),
        F.coalesce("_machine", "machine").alias("machine"), F.col("error").alias("_error"),
        F.greatest(*[F.col(k).isNotNull() for k in SESSION_ONLY_KEYS]).alias("_own"))
    text = lambda c: F.try_variant_get(c, "$", "string")
    typed = computed(flat, _t5=text("_r5"), _t7=text("_r7"), _n5=number(F.col("_p5")), _n7=number(F.col("_p7")))
    typed = computed(typed, five_hour_resets_ts=epoch_seconds(F.col("_t5")), seven_day_resets_ts=epoch_seconds(F.col("_t7")))
    failed = ~is_missing(F.col("_error"))
    # A failed reading is dated when it was written, whoever sent it: the gate looks for its copies there.
    ts = F.when(~failed & (F.col("source") == PUSH_SOURCE) & (F.coalesce("_observed", F.lit(0)) != 0), F.col("_observed")).otherwise(F.col("written_ts"))
    bad_pct = (~is_missing(F.col("_p5")) & F.col("_n5").isNull()) | (~is_missing(F.col("_p7")) & F.col("_n7").isNull())
    bad_reset = F.lit(False)
    for reset, said, got in (("_r5", "_t5", "five_hour_resets_ts"), ("_r7", "_t7", "seven_day_resets_ts")):
        bad_reset = bad_reset | (~is_missing(F.col(reset)) & (F.coalesce(said, F.lit("x")) != "") & F.col(got).isNull())
    reason = (F.when(~F.col("_object") | F.col("written_ts").isNull(), "not an object with a numeric ts")
              .when(F.col("_own"), "per-session field in an account row")
              .when(~F.coalesce(F.col("source").isin(READING_SOURCES[agent]), F.lit(False)), "unknown source")
              .when(failed, F.lit(None))
              .when(bad_pct, "percent is not a number")
              .when(bad_reset, "reset is not a time")
              .when(F.col("machine").isNotNull() & ~valid_machine(F.col("machine")), "not a machine name"))
    error = lambda key, kind: F.try_variant_get("_error", f"$.{key}", kind)
    return typed.select(
        *rest, reason.alias("reason"), failed.alias("is_error"), ts.alias("ts"), iso(ts).alias("dt"), "source",
        F.col("_n5").alias("five_hour_pct"), "five_hour_resets_ts", F.col("_n7").alias("seven_day_pct"),
        "seven_day_resets_ts", "observed_by_session", "written_ts", F.col("value").alias("raw"),
        row_hash(F.col("value")).alias("row_hash"), "machine", error("stage", "string").alias("stage"),
        error("type", "string").alias("type"), error("status", "int").alias("status"),
        error("retry_after_s", "int").alias("retry_after_s"))


def payload_rows(payloads: DataFrame, observed: DataFrame, now: Column, machine: str | None) -> tuple[DataFrame, DataFrame]:
    """Display payloads (`value`) to reading lines and session-snapshot lines, each for its own gate: percents go to
    the one, cost to the other. A payload without limits, or whose transcript gives no date, gives nothing. `observed`
    is one row per transcript (path, observed_at)."""
    known = observed.where(F.col("observed_at").isNotNull())
    dated = payloads.join(known, F.get_json_object("value", "$.transcript_path") == F.col("path")).drop("path")
    return dated_payload_rows(dated, now, machine)


def dated_payload_rows(payloads: DataFrame, now: Column, machine: str | None) -> tuple[DataFrame, DataFrame]:
    """The same for payloads that carry their own `observed_at`."""
    rest = [c for c in payloads.columns if c not in ("value", "observed_at")]
    j = payloads.where(F.col("observed_at").isNotNull()).select(*rest, "observed_at", F.from_json("value", schemas.PAYLOAD).alias("j"))
    limited = j.where(F.col("j.rate_limits.five_hour").isNotNull() | F.col("j.rate_limits.seven_day").isNotNull())
    dated = limited.withColumn("_now", now.cast("long"))
    common = [F.col("_now").alias("ts"), iso(F.col("_now")).alias("iso"), F.lit(PUSH_SOURCE).alias("source"), F.col("observed_at")]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    keep = {"ignoreNullFields": "false"}
    reading = F.to_json(F.struct(
        *common, zero("j.rate_limits.five_hour.used_percentage").alias("five_hour_pct"),
        zero("j.rate_limits.seven_day.used_percentage").alias("seven_day_pct"),
        blank_to_null(F.col("j.rate_limits.five_hour.resets_at")).alias("five_hour_resets_at"),
        blank_to_null(F.col("j.rate_limits.seven_day.resets_at")).alias("seven_day_resets_at"),
        blank_to_null(F.col("j.session_id")).alias("observed_by_session"), F.lit(machine).cast("string").alias("machine")), keep)
    snapshot = F.to_json(F.struct(
        *common, blank_to_null(F.col("j.model.id")).alias("model_id"),
        F.col("j.cost.total_cost_usd").try_cast("double").alias("session_cost_usd"), F.col("j.prompt_cache").alias("prompt_cache")), keep)
    session = session_or_null(F.col("j.session_id"))
    return (dated.select(*rest, reading.alias("value")),
            dated.where(session.isNotNull()).select(*rest, session.alias("session_id"), snapshot.alias("value")))


def finished_windows(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Plan-history answers to one row per finished window; of overlapping answers the latest counts."""
    j = rows.where(F.col("source") == PLAN_HISTORY_SOURCE).select(F.from_json(raw, schemas.PLAN_HISTORY).alias("j"))
    p = j.select(F.col("j.ts").alias("fetched_ts"), F.explode("j.plan_limit_history.periods").alias("p")).select("fetched_ts", "p.*")
    once = last_by(p, ["window_minutes", "starts_at"], F.col("fetched_ts"))
    return once.select("window_minutes", epoch_seconds(F.col("starts_at")).alias("start"), epoch_seconds(F.col("ends_at")).alias("end"),
                       (F.col("used_basis_points") / 100).alias("pct"), "accounting_complete", "fetched_ts")


def daily_tokens(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Account-wide tokens per day; the latest reading of a day counts."""
    j = rows.where(F.col("source") == APP_SERVER_SOURCE).select(F.from_json(raw, schemas.DAILY_BUCKETS).alias("j"))
    b = j.select(F.col("j.ts").alias("fetched_ts"), F.explode("j.codex_usage.dailyUsageBuckets").alias("b")).select("fetched_ts", "b.*")
    return last_by(b, ["startDate"], F.col("fetched_ts")).select(F.col("startDate").alias("day"), "tokens", "fetched_ts")


def product_breakdown(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """The 7-day meter split by product, one row per reading and product."""
    j = rows.where((F.col("source") == POLL_SOURCE) & F.col(raw).contains('"seven_day_breakdown"')).select(
        "ts", F.from_json(raw, schemas.BREAKDOWN).alias("j"))
    b = F.col("j.api.seven_day_breakdown")
    return j.select("ts", epoch_seconds(b["as_of"]).alias("as_of"), epoch_seconds(b["window_started_at"]).alias("window_start"),
                    F.explode(b["rows"]).alias("r")).select("ts", "as_of", "window_start", F.col("r.key").alias("product"),
                                                            F.col("r.percent").alias("pct"))


def drop_idle_countdown(rows: DataFrame, pct: str, resets: str, span: int, tolerance: int = 60) -> DataFrame:
    """Drops the fake countdown of a meter no window runs on: 0 % with a reset one whole span away."""
    idle = (F.col(pct) == 0) & (F.abs(F.col(resets) - F.col("ts") - span) <= tolerance)
    return rows.where(~F.coalesce(idle, F.lit(False)))
