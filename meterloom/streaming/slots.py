"""Slots from a stream of requests."""

from pyspark.sql import Column, DataFrame, functions as F

from meterloom.fixed_values import FINAL_AFTER_S, SLOT_S, TOKEN_COLUMNS
from meterloom.functions.times import iso


def slots_stream(requests: DataFrame, at: str = "at", delay: str = f"{FINAL_AFTER_S} seconds",
                 keys: tuple[str, ...] = ("machine", "folder", "entrypoint", "model")) -> DataFrame:
    """Final slots, each once: five-minute event-time windows in append mode. A request that comes later than `delay`
    behind the newest one finds its slot written and is left out; dropped_late counts these. The newest slot stays open
    until a later request moves the watermark past it; once the requests are known to be complete, open_slots gives what
    is still open."""
    return _totals(requests.withWatermark(at, delay), at, keys)


def open_slots(requests: DataFrame, written: DataFrame, at: str = "at",
               keys: tuple[str, ...] = ("machine", "folder", "entrypoint", "model")) -> DataFrame:
    """The slots a finished stream left open, from its stored requests: those after the last one written (slots are
    written in order of time, all keys of a slot together). Only their range of the requests is read."""
    last = written.agg(F.max("ts")).first()[0]
    left = requests if last is None else requests.where(F.col(at) >= F.timestamp_seconds(F.lit(last + SLOT_S)))
    return _totals(left, at, keys)


def _totals(requests: DataFrame, at: str, keys: tuple[str, ...]) -> DataFrame:
    every = sum((F.col(c) for c in TOKEN_COLUMNS[1:]), F.col(TOKEN_COLUMNS[0]))
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in keys]
    totals = (requests.groupBy(F.window(at, f"{SLOT_S} seconds").alias("w"), *named).agg(
        F.count(F.lit(1)).alias("requests"), *[F.sum(c).alias(c) for c in TOKEN_COLUMNS], F.sum("cost_usd").alias("usd"),
        F.sum(F.when(F.col("cost_usd").isNull(), every).otherwise(0)).cast("long").alias("tokens_without_usd")))
    ts = F.unix_seconds("w.start")
    return totals.select(ts.alias("ts"), iso(ts).alias("dt"), *keys, "requests", *TOKEN_COLUMNS, "usd", "tokens_without_usd")


def with_costs(requests: DataFrame, telemetry: DataFrame, delay: str = f"{FINAL_AFTER_S} seconds",
               bound_s: int = FINAL_AFTER_S) -> DataFrame:
    """Requests with their reported cost as two streams: a left outer join on the request id, kept open for `bound_s`
    seconds around the request. Columns: requests have `at`; telemetry has `request_id`, `reported_at`, `cost_usd`."""
    r = requests.withWatermark("at", delay)
    t = (telemetry.withWatermark("reported_at", delay).dropDuplicatesWithinWatermark(["request_id"])
         .select(F.col("request_id").alias("_id"), "reported_at", "cost_usd"))
    near: Column = F.expr(f"reported_at >= at - INTERVAL {bound_s} SECONDS AND reported_at <= at + INTERVAL {bound_s} SECONDS")
    return r.join(t, (F.col("request_id") == F.col("_id")) & near, "leftOuter").drop("_id")


def open_costs(requests: DataFrame, telemetry: DataFrame, written: DataFrame, bound_s: int = FINAL_AFTER_S) -> DataFrame:
    """The requests a finished with_costs left open, with the cost the stored telemetry reports: the first of a request."""
    left = requests.join(written.select("request_id"), "request_id", "left_anti")
    first = telemetry.groupBy(F.col("request_id").alias("_id")).agg(F.min_by(F.struct("reported_at", "cost_usd"), "reported_at").alias("_t"))
    near = F.expr(f"_t.reported_at >= at - INTERVAL {bound_s} SECONDS AND _t.reported_at <= at + INTERVAL {bound_s} SECONDS")
    return left.join(first, (F.col("request_id") == F.col("_id")) & near, "left").select(
        *left.columns, F.col("_t.reported_at").alias("reported_at"), F.col("_t.cost_usd").alias("cost_usd"))


def dropped_late(query) -> int:
    """Rows a running query left out because their slot was already written."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
