"""Requests and their telemetry to five-minute slots."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from meterloom.fixed_values import SLOT_S, STUB_MODEL, TOKEN_COLUMNS
from meterloom.functions.numbers import tokens
from meterloom.functions.times import iso, slot_start
from meterloom.operators.dedup import first_by
from meterloom.session import settle

_REQUEST_TOKENS = ["input_tokens", "output_tokens", "cache_read_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens"]
_TELEMETRY_TOKENS = ["input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens"]


def telemetry_requests(telemetry: DataFrame, *columns: str) -> DataFrame:
    """The first stored request event of each request: a batch sent twice counts once. Name the columns needed, so that
    no raw text travels with the rest."""
    events = telemetry.where((F.col("event") == "api_request") & F.col("request_id").isNotNull())
    if columns:
        events = events.select("request_id", "ingest_id", *columns)
    once = first_by(events, ["request_id"], F.col("ingest_id"))
    return once.drop("ingest_id") if columns else once


def session_places(requests: DataFrame, *columns: str, known_only: bool = True) -> DataFrame:
    """Per session the value of its first request: of the first that has one (`known_only`), or simply of the first."""
    picks = [F.min_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), F.col("ingest_id")) if known_only
                      else F.col("ingest_id")).alias(c) for c in columns]
    return (requests.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(*picks)
            .select("session_id", *[F.col(f"{c}.v").alias(c) for c in columns]))


@dataclass
class Near:
    """Where the rows of some ids lie, for tables that can tell without being read whole: telemetry by request_id, requests
    by request_id and by session_id. Each takes a table of ids and returns a part of its table that holds all their rows."""
    telemetry: Callable[[DataFrame], DataFrame]
    requests: Callable[[DataFrame], DataFrame]
    sessions: Callable[[DataFrame], DataFrame]


def request_rows(requests: DataFrame, telemetry: DataFrame | None, start: Column | int | None = None,
                 end: Column | int | None = None, near: Near | None = None) -> DataFrame:
    """Every request of [start, end) in the slot's columns, already added up where nothing tells the rows apart: the
    requests of the transcripts with their reported cost, then the requests only telemetry has, in their session's
    folder. Both sides are one row per request_id before they are joined, so no join key is hot; the time range reaches
    the scan of each side, and telemetry is folded once for both joins. `near` finds what lies outside the range; without
    it the tables are asked."""
    def during(df: DataFrame) -> DataFrame:
        if start is not None:
            df = df.where(F.col("ts") >= (F.lit(start) if isinstance(start, int) else start))
        if end is not None:
            df = df.where(F.col("ts") < (F.lit(end) if isinstance(end, int) else end))
        return df

    mine = during(requests).select("request_id", "ts", "folder", "entrypoint", "model", *_REQUEST_TOKENS)
    if telemetry is None:
        seen = mine.withColumn("cost_usd", F.lit(None).cast("double"))
        only = None
    else:
        events = telemetry
        if start is not None or end is not None:
            # Only requests of the range, or reported in it, are folded: all events of these, wherever they lie.
            wanted = mine.select("request_id").unionByName(during(telemetry).where("request_id IS NOT NULL").select("request_id")).distinct()
            if near is not None:
                wanted = settle(wanted, "wanted-requests")
            events = (telemetry if near is None else near.telemetry(wanted)).join(wanted, "request_id", "left_semi")
        reported = settle(telemetry_requests(events, "ts", "session_id", "model", *_TELEMETRY_TOKENS, "cost_usd"), "reported")
        seen = mine.join(reported.select("request_id", "cost_usd"), "request_id", "left")
        told = during(reported)
        only = told.join((requests if near is None else near.requests(told)).select("request_id"), "request_id", "left_anti")
    rows = seen.select(slot_start(F.col("ts")).alias("ts"), "folder", "entrypoint", "model", *_REQUEST_TOKENS,
                       F.lit(0).cast("long").alias("cache_write_unknown_tokens"), "cost_usd")
    rows = add_up(rows, ["ts", "folder", "entrypoint", "model"])
    if only is None:
        return rows
    alone = only.select(slot_start(F.col("ts")).alias("ts"), "session_id", "model",
                        *[tokens(F.col(c)).alias(c) for c in _REQUEST_TOKENS[:3]],
                        *[F.lit(0).cast("long").alias(c) for c in _REQUEST_TOKENS[3:]],
                        tokens(F.col("cache_creation_tokens")).alias("cache_write_unknown_tokens"), "cost_usd")
    # Added up per session first: a session with a third of the rows is at most one row per slot and model here.
    alone = add_up(alone, ["ts", "session_id", "model"])
    alone = settle(alone, "telemetry-only")
    asked = (requests if near is None else near.sessions(alone)).join(alone.select("session_id").distinct(), "session_id", "left_semi")
    placed = alone.join(session_places(asked, "folder", "entrypoint"), "session_id", "left").drop("session_id")
    return rows.unionByName(placed)


def add_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    every = sum((F.col(c) for c in TOKEN_COLUMNS[1:]), F.col(TOKEN_COLUMNS[0]))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"), *[F.sum(c).alias(c) for c in TOKEN_COLUMNS],
        F.sum("cost_usd").alias("usd"),
        F.sum(F.when(F.col("cost_usd").isNull(), every).otherwise(0)).cast("long").alias("tokens_without_usd"))


def build_slots(requests: DataFrame, telemetry: DataFrame | None, machine: str, written_ts: int,
                start: Column | int | None = None, end: Column | int | None = None, near: Near | None = None) -> DataFrame:
    """Slots of [start, end): one row per slot, machine, folder, entrypoint and model; unknown names are ''."""
    rows = request_rows(requests, telemetry, start, end, near)
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("folder", "entrypoint", "model")]
    totals = (rows.groupBy("ts", *named).agg(
        *[F.sum(c).alias(c) for c in ["requests", *TOKEN_COLUMNS, "usd", "tokens_without_usd"]]))
    return totals.select("ts", iso(F.col("ts")).alias("dt"), F.lit(machine).alias("machine"), "folder", "entrypoint",
                         "model", "requests", *TOKEN_COLUMNS, "usd", "tokens_without_usd",
                         F.lit(written_ts).cast("long").alias("written_ts"))


def final_range(slots: DataFrame, scans: DataFrame, machine: str) -> tuple[int, int]:
    """[start, end) of the slots that are final and not written yet; start = end when there is none. Two one-row
    answers, so that the range reaches the scans as a pushed filter."""
    last = slots.where(F.col("machine") == machine).agg((F.max("ts") + SLOT_S).alias("v")).first()["v"]
    complete = scans.agg(F.max("complete_through_ts").alias("v")).first()["v"]
    start = last or 0
    if not complete:
        return start, start
    return start, max(start, complete // SLOT_S * SLOT_S)


def final_slots(requests: DataFrame, telemetry: DataFrame | None, slots: DataFrame, scans: DataFrame, machine: str,
                now: int, near: Near | None = None) -> DataFrame:
    """The final slots not written yet, for a job that runs every few minutes."""
    start, end = final_range(slots, scans, machine)
    return build_slots(requests, telemetry, machine, now, start, end, near)


def usage_requests(requests: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Every request once, with the cost telemetry reports, else the one on the request, and where both came from."""
    reported = settle(telemetry_requests(telemetry, "ts", "dt", "session_id", "model", *_TELEMETRY_TOKENS, "cost_usd"), "reported")
    cost = reported.select("request_id", "cost_usd")
    seen = requests.join(cost, "request_id", "left").select(
        "ts", "dt", "request_id", "machine", "session_id", "folder", "entrypoint", "model", "input_tokens",
        "output_tokens", "cache_read_tokens",
        (F.col("cache_write_5m_tokens") + F.col("cache_write_1h_tokens")).alias("cache_write_tokens"),
        F.coalesce("cost_usd", "usd").alias("usd"),
        F.when(F.col("cost_usd").isNotNull(), F.lit("telemetry")).when(F.col("usd").isNotNull(), F.lit("price_table"))
        .alias("usd_from"), F.lit("transcript").alias("seen_in"))
    only = reported.join(requests.select("request_id"), "request_id", "left_anti")
    places = session_places(requests, "machine", "folder", "entrypoint", known_only=False)
    alone = only.join(places, "session_id", "left").select(
        "ts", "dt", "request_id", "machine", "session_id", "folder", "entrypoint", "model", "input_tokens",
        "output_tokens", "cache_read_tokens", F.col("cache_creation_tokens").alias("cache_write_tokens"),
        F.col("cost_usd").alias("usd"), F.lit("telemetry").alias("usd_from"), F.lit("telemetry").alias("seen_in"))
    return seen.unionByName(alone)


def usage_5m(requests: DataFrame, scans: DataFrame) -> DataFrame:
    """Totals per slot, folder and interactive flag, and whether the slot can still change. The last completed scan is
    a scalar subquery over the small control table."""
    complete = F.coalesce(scans.select(F.max("complete_through_ts")).scalar(), F.lit(0))
    totals = (requests.groupBy(slot_start(F.col("ts")).alias("slot_ts"), "folder",
                               (F.col("entrypoint") == "cli").alias("interactive"))
              .agg(F.count(F.lit(1)).alias("requests"), F.sum("usd").alias("usd"),
                   *[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "cache_read_tokens", "cache_write_tokens")]))
    return totals.select("slot_ts", iso(F.col("slot_ts")).alias("slot_dt"), "folder", "interactive", "requests", "usd",
                         "input_tokens", "output_tokens", "cache_read_tokens", "cache_write_tokens",
                         (F.col("slot_ts") + SLOT_S <= complete).alias("final"))


def countable_slots(slots: DataFrame) -> DataFrame:
    """Slots for analyses: error stubs left out, `tokens` added."""
    every = sum((F.col(c) for c in TOKEN_COLUMNS[1:]), F.col(TOKEN_COLUMNS[0]))
    return slots.where(F.col("model") != STUB_MODEL).withColumn("tokens", every)


def active_starts(slots: DataFrame) -> DataFrame:
    """Start of every slot with a request: one row per five minutes at most."""
    return settle(slots.where(F.col("requests") > 0).select("ts").distinct(), "active")
