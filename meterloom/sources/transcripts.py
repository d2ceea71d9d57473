"""Session transcripts of both agents."""

from pyspark.sql import Column, DataFrame, functions as F

from meterloom import schemas
from meterloom.fixed_values import TURN_PRICES
from meterloom.functions.numbers import at_least_zero, list_price_usd, tokens
from meterloom.functions.times import epoch_seconds, iso, zoned_epoch
from meterloom.operators.chunks import running
from meterloom.operators.dedup import counter_deltas, first_by, largest_output
from meterloom.session import settle
from meterloom.sources.lines import computed, parsed

_PLACE = ["path", "block", "line"]


def _parsed(lines: DataFrame, keep: Column, schema: str) -> DataFrame:
    """Lines that pass a plain text test, parsed. The test runs before the JSON parser and drops most lines; text that
    is no JSON object parses to NULLs and falls out of every later filter."""
    return parsed(lines.where(keep), schema, *_PLACE)


def request_lines(lines: DataFrame) -> DataFrame:
    """Assistant lines with usage, one row per line."""
    j = _parsed(lines, F.col("value").contains('"usage"'), schemas.TRANSCRIPT_LINE)
    usage = F.col("message.usage")
    written, written_1h = tokens(usage["cache_creation_input_tokens"]), tokens(usage["cache_creation"]["ephemeral_1h_input_tokens"])
    key = F.coalesce(F.nullif(F.col("requestId"), F.lit("")), F.nullif(F.col("message.id"), F.lit("")))
    dated = computed(j.where((F.col("type") == "assistant") & usage.isNotNull()), ts=epoch_seconds(F.col("timestamp")), request_id=key)
    rows = dated.where(F.col("request_id").isNotNull() & F.col("ts").isNotNull()).select(
        *_PLACE, "ts", "request_id",
        F.col("sessionId").alias("session_id"), F.col("cwd").alias("folder"), "entrypoint",
        F.col("message.model").alias("model"), tokens(usage["input_tokens"]).alias("input_tokens"),
        tokens(usage["output_tokens"]).alias("output_tokens"), tokens(usage["cache_read_input_tokens"]).alias("cache_read_tokens"),
        at_least_zero(written - written_1h).alias("cache_write_5m_tokens"), written_1h.alias("cache_write_1h_tokens"))
    return rows


def requests(lines: DataFrame, complete_before: int | None = None) -> DataFrame:
    """Requests of the transcripts, each once; with `complete_before`, only those whose first line is not younger."""
    rows = largest_output(request_lines(lines))
    if complete_before is not None:
        rows = rows.where(F.col("ts") <= complete_before)
    return rows.withColumn("dt", iso(F.col("ts")))


def turn_records(lines: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Session lines of the second agent, parsed, each with the context that holds there: thread, folder, entrypoint
    and model, carried down the file from split to split. `before` (path and those four): the context that holds where
    the lines at hand begin, as `contexts` found it in what came before them."""
    seen = F.col("value")
    j = _parsed(lines, seen.contains('"session_meta"') | seen.contains('"turn_context"') | seen.contains('"token_count"'),
                schemas.TURN_LINE).where(F.col("payload").isNotNull())
    j = settle(j, "session-records")
    meta, context = F.col("type") == "session_meta", F.col("type") == "turn_context"
    text = F.col("payload.source")
    # `source` is a text, or an object (kept as its JSON) for a subagent.
    entry = F.when(text.isNull() | text.startswith("{") | text.startswith("["), F.lit("subagent")).otherwise(text)
    folder = F.nullif(F.col("payload.cwd"), F.lit(""))
    # A session_meta sets thread, folder and entrypoint even to nothing, so they travel as structs.
    specs = {
        "_thread": ("last_known", F.when(meta, F.struct(F.col("payload.id").alias("v")))),
        "_entry": ("last_known", F.when(meta, F.struct(entry.alias("v")))),
        "_folder": ("last_known", F.when(meta, F.struct(F.col("payload.cwd").alias("v")))
                    .when(context & folder.isNotNull(), F.struct(folder.alias("v")))),
        "_model": ("last_known", F.when(context, F.nullif(F.col("payload.model"), F.lit("")))),
    }
    start = None if before is None else before.select(
        "path", *[F.struct(F.col(c).alias("v")).alias(f"_{n}") for n, c in (("thread", "thread"), ("entry", "entrypoint"), ("folder", "folder"))],
        F.col("model").alias("_model"))
    # The split is the chunk: a file's context meets the next split as one row.
    rows = running(j, ["path"], [F.col("block"), F.col("line")], specs, F.col("block"), start)
    return rows.select(*[c for c in j.columns], F.col("_thread.v").alias("thread"), F.col("_entry.v").alias("entrypoint"),
                       F.col("_folder.v").alias("folder"), F.col("_model").alias("model"))


def contexts(records: DataFrame, before: DataFrame) -> DataFrame:
    """The context after these records: each file's last; a file without new records keeps what it had."""
    held = ["thread", "entrypoint", "folder", "model"]
    last = records.groupBy("path").agg(F.max_by(F.struct(*held), F.struct("block", "line")).alias("_c")).select("path", "_c.*")
    return last.unionByName(before.join(last.select("path"), "path", "left_anti"))


def _token_counts(records: DataFrame) -> DataFrame:
    return (records.where((~F.col("type").isin("session_meta", "turn_context")) & (F.col("payload.type") == "token_count")
                          & F.col("payload.info").isNotNull())
            .withColumn("total", F.col("payload.info.total_token_usage")).withColumn("last", F.col("payload.info.last_token_usage")))


def turns(lines: DataFrame, machine: str, prices=TURN_PRICES) -> DataFrame:
    """Turns of the second agent, each once: a repeated event or an archived copy has the same thread and running
    total. Input is kept without its cached part."""
    return turns_of(turn_records(lines), machine, prices)


def turns_of(records: DataFrame, machine: str, prices=TURN_PRICES) -> DataFrame:
    """The turns of `turn_records`."""
    t = _token_counts(records).where(
        F.col("total").isNotNull() & F.col("last").isNotNull() & (F.coalesce("thread", F.lit("")) != ""))
    cached = tokens(F.col("last.cached_input_tokens"))
    rows = t.select(
        *_PLACE, epoch_seconds(F.col("timestamp")).alias("ts"),
        F.concat_ws(":", "thread", F.coalesce(F.col("total.total_tokens").cast("string"), F.lit("None"))).alias("request_id"),
        F.lit(machine).alias("machine"), F.col("thread").alias("session_id"), "folder", "entrypoint", "model",
        at_least_zero(tokens(F.col("last.input_tokens")) - cached).alias("input_tokens"),
        tokens(F.col("last.output_tokens")).alias("output_tokens"), cached.alias("cache_read_tokens"),
        tokens(F.col("last.cache_write_input_tokens")).alias("cache_write_5m_tokens"),
        F.lit(0).cast("long").alias("cache_write_1h_tokens")).where(F.col("ts").isNotNull())
    once = first_by(rows, ["request_id"], F.struct(*_PLACE)).drop(*_PLACE)
    usd = list_price_usd(*[F.col(c) for c in ("model", "input_tokens", "output_tokens", "cache_read_tokens",
                                              "cache_write_5m_tokens", "cache_write_1h_tokens")], prices=prices)
    return once.withColumn("usd", usd).withColumn("dt", iso(F.col("ts")))


def turn_usage(lines: DataFrame) -> DataFrame:
    """Usage per event from the cumulative counter of each file; after a counter reset, the event's own."""
    t = _token_counts(turn_records(lines)).where(F.col("total").isNotNull())
    names = ("input_tokens", "cached_input_tokens", "output_tokens")
    totals = {"total_tokens": F.col("total.total_tokens"), **{n: F.col(f"total.{n}") for n in names}}
    own = {"total_tokens": F.lit(None).cast("long"), **{n: F.col(f"last.{n}") for n in names}}
    moved = _counter(t, totals, own, names)
    return moved.select(*_PLACE, "timestamp", "model",
                        (F.col("input_tokens_delta") - F.col("cached_input_tokens_delta")).alias("input_tokens"),
                        F.col("output_tokens_delta").alias("output_tokens"), F.col("cached_input_tokens_delta").alias("cache_read_tokens"))


def _counter(t, totals, own, names):
    flat = t.select(*_PLACE, "timestamp", "model", "total", "last")
    return counter_deltas(flat, ["path"], [F.col("block"), F.col("line")], totals, own, F.col("block"), watch=list(names))


def last_answers(lines: DataFrame) -> DataFrame:
    """Top-level assistant lines with their UTC time (NULL where the stamp names another zone): what dates a payload."""
    j = _parsed(lines, F.col("value").contains('"type":"assistant"'), "type STRING, timestamp STRING, sessionId STRING")
    return j.where((F.col("type") == "assistant") & F.col("timestamp").isNotNull()).select(
        *_PLACE, zoned_epoch(F.col("timestamp")).alias("ts"), F.col("sessionId").alias("session_id"))


def answer_times(lines: DataFrame) -> DataFrame:
    """Top-level assistant lines with the instant of their stamp, whatever its zone, and their UTC time (else NULL): what
    tells when an answer was there, and what it dates."""
    j = _parsed(lines, F.col("value").contains('"type":"assistant"'), "type STRING, timestamp STRING")
    return j.where(F.col("type") == "assistant").select(
        *_PLACE, F.try_to_timestamp("timestamp").alias("at"), zoned_epoch(F.col("timestamp")).alias("ts")).where("at is not null")


def observed_at(answers: DataFrame) -> DataFrame:
    """Per transcript the time of its last assistant line, or NULL when that line's stamp is not UTC."""
    at = F.struct("block", "line")
    return (answers.groupBy("path").agg(F.max_by(F.struct("ts"), at).alias("_last"))
            .select("path", F.col("_last.ts").alias("observed_at")))


def cost_states(lines: DataFrame) -> DataFrame:
    """The last cumulative cost record of each session, dated by its start plus its duration (milliseconds)."""
    j = _parsed(lines, F.col("value").contains('"cost-state"'), schemas.COST_STATE_LINE).where(F.col("type") == "cost-state")
    dated = j.withColumn("ts", ((F.col("startTime") + F.coalesce("totalDuration", F.lit(0))) / 1000).cast("long"))
    last = F.max_by(F.struct("ts", "totalCostUSD", "modelUsage"), F.struct("ts", *_PLACE))
    return dated.groupBy(F.col("sessionId").alias("session_id")).agg(last.alias("_l")).select(
        "session_id", F.col("_l.ts").alias("ts"), F.col("_l.totalCostUSD").alias("usd"), F.col("_l.modelUsage").alias("models"))


def refusals(lines: DataFrame) -> DataFrame:
    """Refused requests: the window that was full and when it resets."""
    j = _parsed(lines, F.col("value").contains('"quotaLimits"'), schemas.REFUSAL_LINE)
    return j.where(F.col("quotaLimits.status") == "rejected").select(
        epoch_seconds(F.col("timestamp")).alias("ts"), F.col("sessionId").alias("session_id"),
        F.col("quotaLimits.rateLimitType").alias("window"), epoch_seconds(F.col("quotaLimits.resetsAt")).alias("resets_ts"))
