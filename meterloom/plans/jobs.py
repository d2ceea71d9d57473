"""The jobs a scheduler starts: logs to slots, payloads to readings, one store to another."""

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from meterloom import schemas
from meterloom.fixed_values import FINAL_AFTER_S
from meterloom.functions.times import iso
from meterloom.operators.slots import Near, final_slots
from meterloom.sinks import gates
from meterloom.sinks.known_ids import KnownIds
from meterloom.sources.lines import read_lines
from meterloom.sources.tables import stored
from meterloom.sources.transcripts import last_answers, observed_at, requests, turns
from meterloom.sources.readings import payload_rows
from meterloom.session import scratch, settle


def in_order(rows: DataFrame, after: int, order: list[str]) -> DataFrame:
    """Rows numbered in an order, such as requests in time order: sorted across the cluster, written, then numbered by
    file and place in it. A row's place is known to the file, so only one row per file is added up and no row moves again."""
    spark = rows.sparkSession
    path = scratch(spark, "landed")
    rows.orderBy(*order).write.parquet(path)
    text = spark.read.schema(rows.schema).parquet(path)
    placed = text.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    earlier = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    starts = settle(placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
                    .select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")), "starts")
    return (placed.join(starts, "_file").withColumn("ingest_id", F.lit(after) + F.col("_start") + F.col("_place") + 1)
            .drop("_file", "_place", "_start"))


def store_requests(found: DataFrame, requests_path: str) -> int:
    """Appends the requests the working table does not have, numbered in time order."""
    return _store(found.withColumn("dt", iso(F.col("ts"))), requests_path, schemas.REQUESTS)


def _store(found: DataFrame, path: str, schema: str) -> int:
    """The table is asked once, and of it only the files whose filters may hold one of the ids."""
    found, known = settle(found, "found"), gates.known_requests(found.sparkSession, path, schema)
    new = found.join(known.holding(found).select("request_id"), "request_id", "left_anti")
    return gates.add_requests(in_order(new, known.highest(), ["ts", "request_id"]), path, schema, new=True)


def read_transcripts(spark: SparkSession, folder: str, requests_path: str, scans_path: str, now: int) -> int:
    """New finished requests of a transcript tree into the working table, then the run's completeness time. Reading a
    tree again adds nothing, so a replaced or truncated file needs no care. Returns how many were added."""
    complete_before = now - FINAL_AFTER_S
    added = store_requests(requests(read_lines(spark, folder), complete_before), requests_path)
    gates.add_scan(spark, scans_path, now, complete_before, added)
    return added


def read_sessions(spark: SparkSession, folder: str, turns_path: str, scans_path: str, machine: str, now: int) -> int:
    """New turns of the second agent. A turn is complete when written, so all up to a minute ago are in."""
    added = store_turns(turns(read_lines(spark, folder), machine), turns_path)
    gates.add_scan(spark, scans_path, now, now - 60, added)
    return added


def store_turns(found: DataFrame, turns_path: str) -> int:
    """Appends the turns the table does not have, numbered in time order."""
    return _store(found, turns_path, schemas.TURNS)


def near(spark: SparkSession, requests_path: str, telemetry_path: str) -> Near:
    """Filters per file of both tables, brought up to date: a run reads the new files' ids once."""
    telemetry = KnownIds(spark, telemetry_path, schemas.TELEMETRY, "request_id")
    requests_, sessions = (KnownIds(spark, requests_path, schemas.REQUESTS, key) for key in ("request_id", "session_id"))
    for known in (telemetry, requests_, sessions):
        known.update()
    return Near(telemetry.holding, requests_.holding, sessions.holding)


def write_slots(spark: SparkSession, requests_path: str, telemetry_path: str | None, scans_path: str, slots_path: str,
                machine: str, now: int) -> int:
    """The slots that became final since the last run, once each. Of both tables only the range's files are read, and
    those whose filters may hold a request or a session of the range."""
    telemetry = stored(spark, telemetry_path, schemas.TELEMETRY) if telemetry_path else None
    new = final_slots(stored(spark, requests_path, schemas.REQUESTS), telemetry, stored(spark, slots_path, schemas.SLOTS),
                      stored(spark, scans_path, schemas.SCANS), machine, now,
                      near(spark, requests_path, telemetry_path) if telemetry_path else None)
    return gates.add_slots(new, slots_path, machine)


def store_payloads(spark: SparkSession, payloads: DataFrame, transcripts_folder: str, account_path: str, errors_path: str,
                   snapshots_path: str, machine: str, now: int) -> tuple[dict, dict]:
    """Display payloads (`value`, `ingest_id`) to both gates; returns the outcome counts of each."""
    at = observed_at(last_answers(read_lines(spark, transcripts_folder)))
    # A file's name comes as a URI: its scheme and host go, and escaped characters are read back.
    plain = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    at = at.withColumn("path", F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))))
    account, session = payload_rows(payloads, at, F.lit(now), machine)
    done = gates.add_readings(account, account_path, errors_path, "claude")
    snaps = gates.add_snapshots(session, snapshots_path)
    return gates.outcome_counts(done), gates.outcome_counts(snaps)
