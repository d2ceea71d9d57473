"""The gates: every row is checked, deduplicated and appended once; a refused row goes to quarantine with its reason.

A table is a parquet folder that only grows. A gate classifies a batch against what the folder holds, writes the
classified batch to the shared folder, and appends from there, so that the rows counted are the rows stored even when
an executor is lost between the two.
"""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterloom import schemas
from meterloom.fixed_values import HOST_PATTERN, PUSH_SOURCE, SLOT_AGENT, SLOT_S
from meterloom.functions.numbers import is_missing, is_number, number
from meterloom.functions.text import canonical_json, has_percent_key, row_hash, valid_machine, valid_session
from meterloom.functions.times import iso
from meterloom.operators.dedup import first_by, mark_repeats
from meterloom.session import settle
from meterloom.sinks.known_ids import KnownIds
from meterloom.sinks.last_values import LastValues
from meterloom.sources.lines import parsed
from meterloom.sources.readings import reading_columns
from meterloom.sources.tables import stored
from meterloom.sources.telemetry import telemetry_from_lines

_READING = ["ts", "five_hour_pct", "five_hour_resets_ts", "seven_day_pct", "seven_day_resets_ts"]


def column_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.replace("\n", " ").split(",")]


def _during(held: DataFrame, rows: DataFrame, at: str, held_at: str | None = None) -> DataFrame:
    """The held rows of the batch's own time range: equal keys have equal times, so no other row can be a copy. The two
    bounds become a filter the parquet scan prunes files with."""
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return held.limit(0)
    return held.where(F.col(held_at or at).between(low, high))


def _mark_copies(rows: DataFrame, held: DataFrame, key: list[str], by: str = "ingest_id") -> DataFrame:
    """Flags rows whose key the table holds or an earlier row of the batch has. Copies are folded to their key before
    they travel, and the table is asked for the batch's keys only: a batch Spark finds small is sent to the table's
    files instead of the table being shuffled."""
    first = rows.groupBy(*key).agg(F.min(by).alias("_first"))
    known = held.select(*key).join(first.select(*key), key, "left_semi").distinct().withColumn("_held", F.lit(True))
    fresh = first.join(known, key, "left")
    return (rows.join(fresh, key).withColumn("copy", F.col("_held").isNotNull() | (F.col(by) > F.col("_first")))
            .drop("_first", "_held"))


def append_rows(rows: DataFrame, path: str, schema: str, partition: str | None = None) -> None:
    writer = rows.select(*column_names(schema)).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def outcome_counts(classified: DataFrame) -> dict[str, int]:
    """How many rows were inserted, duplicate, redundant and rejected."""
    found = {r["outcome"]: r["n"] for r in classified.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {k: found.get(k, 0) for k in ("inserted", "duplicate", "redundant", "rejected")}


def last_readings(spark: SparkSession, path: str) -> LastValues:
    """The last stored reading of each session, kept beside a table of readings."""
    return LastValues(spark, f"{path}-last", ["observed_by_session"], F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(_READING)]),
                      F.coalesce((F.col("source") == PUSH_SOURCE) & (F.col("observed_by_session") != ""), F.lit(False)))


def classify_readings(lines: DataFrame, held: DataFrame, held_errors: DataFrame, agent: str, dedup: bool = True,
                      machine: Column | None = None, lasts: LastValues | None = None) -> DataFrame:
    """Reading lines (`value`, `ingest_id`) with the outcome of each: rejected, duplicate, redundant (a session repeating
    its last stored reading) or inserted. `lasts`: where the last readings are kept; without it the table is asked."""
    typed = settle(reading_columns(lines, agent, machine), "typed-readings")
    good = typed.where(F.col("reason").isNull())
    # The hash covers the raw text, the raw text its write time.
    hashes = _during(held, good, "written_ts").select("row_hash").unionByName(
        _during(held_errors, good, "written_ts", "ts").select("row_hash"))
    marked = _mark_copies(good, hashes, ["row_hash"])
    if dedup:
        of_session = F.coalesce((F.col("source") == PUSH_SOURCE) & (F.col("observed_by_session") != "") & ~F.col("is_error"), F.lit(False))
        pushed = marked.where(of_session)
        if lasts is not None:
            last = lasts.read(typed.where((F.col("source") == PUSH_SOURCE) & (F.col("observed_by_session") != "")), held)
        else:
            last = (held.where(F.col("source") == PUSH_SOURCE).join(pushed.select("observed_by_session").distinct(),
                                                                   "observed_by_session", "left_semi")
                    .groupBy("observed_by_session")
                    .agg(F.max_by(F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(_READING)]), "ingest_id").alias("last_values")))
        seen = mark_repeats(pushed, ["observed_by_session"], [F.col(c) for c in _READING], stored=last, copy=F.col("copy"))
        marked = seen.unionByName(marked.where(~of_session).withColumn("redundant", F.lit(False)))
    else:
        marked = marked.withColumn("redundant", F.lit(False))
    return _with_outcome(marked, typed)


def _with_outcome(marked: DataFrame, typed: DataFrame) -> DataFrame:
    refused = typed.where(F.col("reason").isNotNull()).withColumn("copy", F.lit(False)).withColumn("redundant", F.lit(False))
    outcome = (F.when(F.col("reason").isNotNull(), "rejected").when(F.col("redundant"), "redundant")
               .when(F.col("copy"), "duplicate").otherwise("inserted"))
    return marked.unionByName(refused).withColumn("outcome", outcome).drop("copy", "redundant")


def _decided(spark: SparkSession, path: str, batch: str | None, classify: Callable[[], DataFrame], name: str) -> tuple[DataFrame, bool]:
    """The classified batch, written, and whether it was classified before. A batch with a name is classified once: when
    it comes again, after a crash, what was decided then still holds, though the table has changed meanwhile."""
    if batch is None:
        return settle(classify(), name), False
    place, told = f"{path}-classified/{batch}", f"{path}-classified-done/{batch}"
    if stored(spark, told, "n LONG").head(1):
        return spark.read.parquet(place), True
    classify().write.mode("overwrite").parquet(place)
    spark.range(1).select(F.col("id").alias("n")).coalesce(1).write.mode("overwrite").parquet(told)
    return spark.read.parquet(place), False


def _missing(new: DataFrame, path: str, schema: str, at: str, held_at: str | None = None) -> DataFrame:
    """Of the rows to insert those that the table does not hold yet, settled before the table grows."""
    held = _during(stored(new.sparkSession, path, schema), new, at, held_at)
    return settle(new.join(held.select("row_hash"), "row_hash", "left_anti"), "still-missing")


def add_readings(lines: DataFrame, path: str, errors_path: str, agent: str, dedup: bool = True,
                 machine: Column | None = None, batch: str | None = None) -> DataFrame:
    """Appends new readings to one table and failed polls to the other; returns the classified lines. `batch` names the
    batch where it may come again: then nothing is stored twice and no outcome changes."""
    spark, lasts = lines.sparkSession, last_readings(lines.sparkSession, path)
    done, again = _decided(spark, path, batch, lambda: classify_readings(
        lines, stored(spark, path, schemas.ACCOUNT_QUOTAS), stored(spark, errors_path, schemas.POLL_ERRORS), agent, dedup, machine, lasts), "readings")
    new = done.where(F.col("outcome") == "inserted")
    good, bad = new.where(~F.col("is_error")), new.where(F.col("is_error"))
    if again:
        good, bad = _missing(good, path, schemas.ACCOUNT_QUOTAS, "written_ts"), _missing(bad, errors_path, schemas.POLL_ERRORS, "ts")
    append_rows(good, path, schemas.ACCOUNT_QUOTAS)
    append_rows(bad, errors_path, schemas.POLL_ERRORS)
    lasts.merge(stored(spark, path, schemas.ACCOUNT_QUOTAS), good)
    return done


def _snapshot_values() -> list[Column]:
    """Of a snapshot what must differ from the session's last: model, cost and cache statistics, as structures."""
    return [F.col("model_id"), F.col("session_cost_usd"), canonical_json(F.col("prompt_cache"))]


def last_snapshots(spark: SparkSession, path: str) -> LastValues:
    """The last stored snapshot of each session, kept beside a table of snapshots."""
    return LastValues(spark, f"{path}-last", ["session_id"], F.struct(*[c.alias(f"f{i}") for i, c in enumerate(_snapshot_values())]))


def classify_snapshots(lines: DataFrame, held: DataFrame, dedup: bool = True, lasts: LastValues | None = None) -> DataFrame:
    """Session snapshot lines (`value`, `session_id`, `ingest_id`) with their outcome. Redundant: same model, cost and
    cache statistics (as structures, whatever the key order) as the session's last. `lasts`: as for readings."""
    j = parsed(lines, schemas.SNAPSHOT_LINE, "ingest_id", "session_id", "value")
    flat = j.select(
        "ingest_id", "session_id", "value", "model_id", "prompt_cache", number(F.col("ts"), "long").alias("written_ts"),
        number(F.col("observed_at"), "long").alias("_observed"), number(F.col("session_cost_usd")).alias("cost"),
        (~is_missing(F.col("session_cost_usd"))).alias("_has_cost"), has_percent_key(F.col("value")).alias("_percent"))
    ts = F.when(F.coalesce("_observed", F.lit(0)) != 0, F.col("_observed")).otherwise(F.col("written_ts"))
    typed = settle(flat.select(
        "ingest_id", "session_id",
        F.when(~valid_session(F.col("session_id")), "not a plain session id")
        .when(F.col("written_ts").isNull(), "not an object with a numeric ts")
        .when(F.col("_percent"), "percent-like key in session data")
        .when(F.col("_has_cost") & F.col("cost").isNull(), "session_cost_usd is not a number").alias("reason"),
        ts.alias("ts"), iso(ts).alias("dt"), "model_id", F.col("cost").alias("session_cost_usd"),
        F.when(~is_missing(F.col("prompt_cache")), F.to_json("prompt_cache")).alias("prompt_cache"), "written_ts",
        F.col("value").alias("raw"), row_hash(F.col("value"), F.col("session_id")).alias("row_hash")), "typed-snapshots")
    good = typed.where(F.col("reason").isNull())
    marked = _mark_copies(good, _during(held, good, "written_ts"), ["row_hash"])
    values = _snapshot_values()
    if dedup and lasts is not None:
        marked = mark_repeats(marked, ["session_id"], values, stored=lasts.read(good, held), copy=F.col("copy"))
    elif dedup:
        last = (held.join(marked.select("session_id").distinct(), "session_id", "left_semi").groupBy("session_id")
                .agg(F.max_by(F.struct(*[c.alias(f"f{i}") for i, c in enumerate(values)]), "ingest_id").alias("last_values")))
        marked = mark_repeats(marked, ["session_id"], values, stored=last, copy=F.col("copy"))
    else:
        marked = marked.withColumn("redundant", F.lit(False))
    return _with_outcome(marked, typed)


def add_snapshots(lines: DataFrame, path: str, dedup: bool = True, batch: str | None = None) -> DataFrame:
    """Appends new snapshots; returns the classified lines. `batch`: as for readings."""
    spark, lasts = lines.sparkSession, last_snapshots(lines.sparkSession, path)
    done, again = _decided(spark, path, batch, lambda: classify_snapshots(
        lines, stored(spark, path, schemas.SESSION_SNAPSHOTS), dedup, lasts), "snapshots")
    new = done.where(F.col("outcome") == "inserted")
    if again:
        new = _missing(new, path, schemas.SESSION_SNAPSHOTS, "written_ts")
    append_rows(new, path, schemas.SESSION_SNAPSHOTS)
    lasts.merge(stored(spark, path, schemas.SESSION_SNAPSHOTS), new)
    return done


def classify_telemetry(lines: DataFrame, held: DataFrame, known: KnownIds | None = None) -> DataFrame:
    """Flattened telemetry lines (`value`, `ingest_id`) with their outcome. `known`: which files of the table may hold a
    line; without it the table is asked."""
    good = settle(telemetry_from_lines(lines.where(~has_percent_key(F.col("value"))))
                  .withColumn("row_hash", row_hash(F.col("raw"))), "typed-telemetry")
    if known is not None:
        held = known.holding(good)
    marked = _mark_copies(good, _during(held, good, "ts"), ["row_hash"]).withColumn(
        "outcome", F.when(F.col("copy"), "duplicate").otherwise("inserted")).drop("copy")
    refused = lines.join(good.select("ingest_id"), "ingest_id", "left_anti").select("ingest_id", F.col("value").alias("raw"))
    return marked.unionByName(refused.withColumn("outcome", F.lit("rejected")), allowMissingColumns=True)


def add_telemetry(lines: DataFrame, path: str) -> DataFrame:
    spark = lines.sparkSession
    known = KnownIds(spark, path, schemas.TELEMETRY, "row_hash")
    done = settle(classify_telemetry(lines, stored(spark, path, schemas.TELEMETRY), known), "telemetry")
    append_rows(done.where(F.col("outcome") == "inserted"), path, schemas.TELEMETRY)
    known.update()
    return done


def known_requests(spark: SparkSession, path: str, schema: str = schemas.REQUESTS) -> KnownIds:
    return KnownIds(spark, path, schema, "request_id")


def add_requests(rows: DataFrame, path: str, schema: str = schemas.REQUESTS, new: bool = False) -> int:
    """Appends requests whose id is new; a missing id or a negative or missing count refuses the batch. `new`: the caller
    has asked the table already, once, for ids that do not repeat, and the rows are written and numbered (`jobs.in_order`)."""
    counts = ["input_tokens", "output_tokens", "cache_read_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens"]
    bad = F.coalesce("request_id", F.lit("")) == ""
    for c in counts:
        bad = bad | F.coalesce(F.col(c) < 0, F.lit(True))
    settled = rows if new else settle(rows, "requests")
    first = settled.where(bad).select("request_id", *counts).first()
    if first is not None:
        raise ValueError(f"a request needs an id and non-negative counts: {first.asDict()}")
    known = known_requests(rows.sparkSession, path, schema)
    fresh = settled if new else settle(
        _mark_copies(settled, known.holding(settled), ["request_id"]).where(~F.col("copy")).drop("copy"), "new-requests")
    append_rows(fresh, path, schema)
    known.update()
    return fresh.count()


def add_scan(spark: SparkSession, path: str, ts: int, complete_through_ts: int, requests_added: int) -> str:
    """Appends one run to the control table, once per (ts, complete_through_ts)."""
    row = spark.range(1).select(F.lit(ts).cast("long").alias("ts"), iso(F.lit(ts)).alias("dt"),
                                F.lit(complete_through_ts).cast("long").alias("complete_through_ts"),
                                F.lit(requests_added).cast("long").alias("requests_added"))
    held = stored(spark, path, schemas.SCANS)
    if held.where((F.col("ts") == ts) & (F.col("complete_through_ts") == complete_through_ts)).head(1):
        return "duplicate"
    append_rows(row, path, schemas.SCANS)
    return "inserted"


_SLOT_COUNTS = ["ts", "written_ts", "requests", "input_tokens", "output_tokens", "cache_read_tokens", "cache_write_5m_tokens",
                "cache_write_1h_tokens", "cache_write_unknown_tokens", "tokens_without_usd"]


def slot_fault(machine: str | None = None) -> Column:
    """Why a typed slot row must not be stored, or NULL. `machine`: the only one allowed."""
    fault = F.lit(None).cast("string")
    checks = [(F.coalesce(F.col(c) < 0, F.lit(True)), f"{c} is not a count") for c in _SLOT_COUNTS]
    checks += [(F.pmod(F.col("ts"), F.lit(SLOT_S)) != 0, "ts is no slot start"),
               (~F.col("dt").eqNullSafe(iso(F.col("ts"))), "dt is not ts"),
               (~valid_machine(F.col("machine")), "not a machine name")]
    if machine is not None:
        checks.append((F.col("machine") != machine, "a slot of another machine"))
    checks += [(F.col(c).isNull(), f"{c} is not text") for c in ("folder", "entrypoint", "model")]
    for condition, text in reversed(checks):
        fault = F.when(condition, F.lit(text)).otherwise(fault)
    return fault


def slot_line_fault(v: Column, machine: str | None = None) -> Column:
    """Why a slot sent as JSON must not be stored: wrong columns or JSON types, then the checks of slot_fault."""
    names = sorted(column_names(schemas.SLOTS))
    get = lambda c: F.try_variant_get(v, f"$.{c}", "variant")
    keys = F.array_sort(F.json_object_keys(F.to_json(v)))
    whole = lambda c: F.coalesce(F.schema_of_variant(get(c)) == "BIGINT", F.lit(False))
    text = lambda c: F.coalesce(F.schema_of_variant(get(c)) == "STRING", F.lit(False))
    fault = F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "not an object")
    fault = fault.when(keys != F.array(*[F.lit(n) for n in names]), "not exactly the columns of a slot")
    for c in _SLOT_COUNTS:
        fault = fault.when(~whole(c), f"{c} is not a count")
    for c in ("machine", "folder", "entrypoint", "model"):
        fault = fault.when(~text(c), f"{c} is not text")
    fault = fault.when(~is_missing(get("usd")) & ~is_number(get("usd")), "usd is not a number")
    return F.coalesce(fault, slot_fault(machine))


def parse_slots(lines: DataFrame, field: str = "$") -> DataFrame:
    """Slot JSON lines (`value`) to typed columns, with the parsed JSON as `_v`."""
    parsed = lines.withColumn("_v", F.try_variant_get(F.try_parse_json("value"), field, "variant"))
    kinds = dict(part.split()[:2] for part in schemas.SLOTS.replace("\n", " ").split(","))
    return parsed.select(*[c for c in lines.columns if c != "value"], "_v", *[
        F.try_variant_get("_v", f"$.{c}", kind.lower().replace("long", "bigint")).alias(c) for c, kind in kinds.items()])


def check_batch(rows: DataFrame, fault: Column, label: str = "slots") -> DataFrame:
    """The batch, settled, if no row has a fault; otherwise nothing of it may be stored and the first fault is raised."""
    settled = settle(rows.withColumn("_fault", fault).drop("_v"), label)
    first = settled.where(F.col("_fault").isNotNull()).first()
    if first is not None:
        raise ValueError(f"{label} not stored: {first['_fault']}")
    return settled.drop("_fault")


def add_slots(rows: DataFrame, path: str, machine: str | None = None, fault: Column | None = None) -> int:
    """Appends the slots the table does not hold, in one write; one bad row refuses them all. A slot is never changed. Of
    rows with one key the first sent counts (by `ingest_id`, where rows have one)."""
    spark = rows.sparkSession
    good = check_batch(rows, fault if fault is not None else slot_fault(machine))
    held = stored(spark, path, schemas.SLOTS)
    if machine is not None:
        held = held.where(F.col("machine") == machine)
    held = _during(held, good, "ts")
    once = (first_by(good, list(schemas.SLOT_KEY), F.col("ingest_id")) if "ingest_id" in good.columns
            else good.dropDuplicates(schemas.SLOT_KEY))
    fresh = once.join(held.select(*schemas.SLOT_KEY), schemas.SLOT_KEY, "left_anti")
    new = settle(fresh, "new-slots")
    append_rows(new, path, schemas.SLOTS, "machine")
    return new.count()


def receive_slots(lines: DataFrame, path: str, sender: str, receiver: str) -> int:
    """Slots another machine sent ({"agent", "table", "row"} lines): only this table, only the sender's own rows, never
    rows of the receiver, and all or nothing."""
    if not re.fullmatch(HOST_PATTERN, sender):
        raise ValueError(f"not a host name: {sender!r}")
    if sender == receiver:
        raise ValueError(f"{sender} is this machine: its slots are written here by its own job")
    whole = F.try_parse_json("value")
    named = lines.withColumn("_agent", F.try_variant_get(whole, "$.agent", "string")).withColumn(
        "_table", F.try_variant_get(whole, "$.table", "string"))
    rows = parse_slots(named, "$.row")
    envelope = F.when(~F.coalesce((F.col("_agent") == SLOT_AGENT) & (F.col("_table") == "slots"), F.lit(False)), "only slots are received")
    return add_slots(rows, path, sender, F.coalesce(envelope, slot_line_fault(F.col("_v"), sender)))
