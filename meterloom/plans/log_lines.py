"""JSON log lines written from the supplied events, for the readers: each event is one line of one log. The lines are
landed in the shared folder first, as logs are; a reader's text filters then run on text, not on what wrote it."""

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterloom.functions.times import iso
from meterloom.plans.feeds import events, request_lines, telemetry
from meterloom.session import settle
from meterloom.sources.growing import local_path

_PLACE = ["path", "block", "line"]
# An attribute around a text: lists within lists, five deep.
_NESTED = ('{"key":"deep","value":' + '{"arrayValue":{"values":[' * 4 + '{"kvlistValue":{"values":[{"key":"q","value":{"stringValue":"',
           '"}}]}}' + "]}}" * 4 + "}")


def _json(*columns):
    return F.to_json(F.struct(*columns))


def transcript_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_lines as transcript JSON, with user lines and broken lines between them."""
    r = request_lines(spark, sf_dir)
    usage = F.struct("input_tokens", "output_tokens", F.col("cache_read_tokens").alias("cache_read_input_tokens"),
                     (F.col("cache_write_5m_tokens") + F.col("cache_write_1h_tokens")).alias("cache_creation_input_tokens"),
                     F.struct(F.col("cache_write_5m_tokens").alias("ephemeral_5m_input_tokens"),
                              F.col("cache_write_1h_tokens").alias("ephemeral_1h_input_tokens")).alias("cache_creation"))
    line = _json(F.lit("assistant").alias("type"), F.concat(F.substring(iso(F.col("ts")), 1, 19), F.lit(".250Z")).alias("timestamp"),
                 F.when(F.col("line") % 5 != 0, F.col("request_id")).alias("requestId"), F.col("session_id").alias("sessionId"),
                 F.col("folder").alias("cwd"), "entrypoint",
                 F.struct(F.col("request_id").alias("id"), "model", usage.alias("usage")).alias("message"))
    good = r.select(*_PLACE, line.alias("value"))
    e = events(spark, sf_dir)
    other = e.where("event_type IN ('purchase', 'signup')").select(
        F.lit("f20").alias("path"), F.lit(0).cast("long").alias("block"), F.col("event_id").alias("line"),
        F.when(F.col("event_type") == "purchase", _json(F.lit("user").alias("type"), F.col("props").alias("usage")))
        .otherwise(F.lit('{"type":"assistant","message":{"usage":{"output_tokens":')).alias("value"))
    return settle(good.unionByName(other), "transcript-lines")


def telemetry_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """telemetry as log batches: one batch per event, holding it and a prompt event that must be dropped."""
    t = telemetry(spark, sf_dir)
    text = lambda key, c: F.when(c.isNotNull(), F.concat(F.lit('{"key":"' + key + '","value":{"stringValue":"'), c, F.lit('"}}')))
    whole = lambda key, c: F.when(c.isNotNull(), F.concat(F.lit('{"key":"' + key + '","value":{"intValue":"'), c.cast("string"), F.lit('"}}')))
    real = lambda key, c: F.when(c.isNotNull(), F.concat(F.lit('{"key":"' + key + '","value":{"doubleValue":'), c.cast("string"), F.lit("}}")))
    named = F.col("ingest_id") % 2 == 0
    attributes = F.array_join(F.array_compact(F.array(
        F.when(named, text("event.name", F.col("event"))), text("session.id", F.when(F.col("ingest_id") % 11 == 0, F.lit("../x")).otherwise(F.col("session_id"))),
        text("request_id", F.col("request_id")), text("model", F.col("model")), text("query_source", F.col("query_source")),
        whole("input_tokens", F.col("input_tokens")), whole("output_tokens", F.col("output_tokens")),
        whole("cache_read_tokens", F.col("cache_read_tokens")), whole("cache_creation_tokens", F.col("cache_creation_tokens")),
        F.when(F.col("ingest_id") % 7 == 0, F.concat(F.lit(_NESTED[0]), F.col("query_source"), F.lit(_NESTED[1]))),
        real("cost_usd", F.col("cost_usd")))), ",")
    record = F.concat(F.lit('{"timeUnixNano":"'), F.col("ts").cast("string"), F.lit('123000000","body":{"stringValue":"claude_code.'),
                      F.col("event"), F.lit('"},"attributes":['), attributes, F.lit("]}"))
    prompt = F.lit('{"timeUnixNano":"1","body":{"stringValue":"claude_code.user_prompt"},"attributes":[]}')
    value = F.concat(F.lit('{"resourceLogs":[{"resource":{"attributes":[{"key":"os.type","value":{"stringValue":"x"}}]},"scopeLogs":[{"logRecords":['),
                     prompt, F.lit(","), record, F.lit("]}]}]}"))
    return settle(t.select("received_ts", value.alias("value")), "telemetry-batches")


def session_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second agent: one file per user; signups open a thread, errors switch the model, the rest count tokens."""
    e = events(spark, sf_dir)
    k, i = F.col("k"), F.col("event_id")
    stamp = F.concat(F.substring(iso(F.col("t")), 1, 19), F.lit(".000Z")).alias("timestamp")
    meta = _json(stamp, F.lit("session_meta").alias("type"), F.struct(
        F.concat(F.lit("thr-"), F.col("user_id").cast("string")).alias("id"), F.concat(F.lit("/w"), (k % 3).cast("string")).alias("cwd"),
        F.when(k % 2 == 0, "cli").otherwise("exec").alias("source")).alias("payload"))
    context = _json(stamp, F.lit("turn_context").alias("type"), F.struct(
        F.concat(F.lit("model-"), (k % 4).cast("string")).alias("model"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("/ctx")).alias("cwd")).alias("payload"))
    count = _json(stamp, F.lit("event_msg").alias("type"), F.struct(F.lit("token_count").alias("type"), F.struct(
        F.struct((k * 7).alias("total_tokens"), (k * 5).alias("input_tokens"), (k * 2).alias("cached_input_tokens"), k.alias("output_tokens"))
        .alias("total_token_usage"),
        F.struct((k + i % 10).alias("input_tokens"), (k % 50).alias("cached_input_tokens"), (k % 6).alias("cache_write_input_tokens"),
                 (i % 100).alias("output_tokens")).alias("last_token_usage")).alias("info")).alias("payload"))
    value = F.when(F.col("event_type") == "signup", meta).when(F.col("event_type") == "error", context).otherwise(count)
    return settle(e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("path"), F.floor(i / 4096).alias("block"),
                           i.alias("line"), value.alias("value")), "session-lines")


def reading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading lines with seeded faults: texts for percents, session fields, unknown sources, bad machine names, failed
    polls, broken JSON."""
    e = events(spark, sf_dir)
    k, i, t = F.col("k"), F.col("event_id"), F.col("t")
    fault = F.pmod(i, F.lit(29))
    pct = F.when(fault == 1, F.lit('"high"')).when(fault == 2, F.lit("true")).otherwise((k + 0.5).cast("string"))
    source = F.when(fault == 3, F.lit("other")).when(i % 2 == 0, F.lit("claude_api")).otherwise(F.lit("claude_statusline"))
    extra = (F.when(fault == 4, F.lit(',"session_cost_usd":1')).when(fault == 5, F.lit(',"machine":"a b"'))
             .when(fault == 6, F.lit(',"error":{"stage":"http","status":429}')).otherwise(F.lit(',"machine":"m-1"')))
    reset = F.when(i % 4 == 0, F.concat(F.lit('"'), F.substring(iso(t + 60), 1, 19), F.lit('.5+00:00"'))).otherwise((t + 60).cast("string"))
    # A push reading repeats: time and percents depend on the day and k only.
    day = t - F.pmod(t, F.lit(86400))
    api = F.concat(F.lit('"api":{"five_hour":{"utilization":'), pct, F.lit(',"resets_at":'), reset, F.lit("}}"))
    push = F.concat(F.lit('"observed_at":'), day.cast("string"), F.lit(',"five_hour_pct":'),
                    F.when(fault.isin(1, 2), pct).otherwise((k % 2).cast("string")),
                    F.lit(',"observed_by_session":"s-'), (F.col("user_id") % 50).cast("string"), F.lit('"'))
    value = F.concat(F.lit('{"ts":'), F.when(fault == 7, F.lit('"x"')).otherwise(t.cast("string")), F.lit(',"source":"'), source, F.lit('",'),
                     F.when(i % 2 == 0, api).otherwise(push), extra, F.when(fault == 8, F.lit("")).otherwise(F.lit("}")))
    return settle(e.select(i.alias("ingest_id"), value.alias("value")), "reading-lines")


#: How often the files of `grow` are written.
RUNS = 3


def run_of(lines: DataFrame, events_: DataFrame) -> DataFrame:
    """Lines with the run that writes them: a third of the events each."""
    n = events_.select((F.max("event_id") + 1).alias("n")).scalar()
    return lines.withColumn("run", F.floor(F.col("line") * RUNS / n).cast("int"))


def grow(lines: DataFrame, folder: str, run: int) -> DataFrame:
    """Writes one run's lines (path, block, line, value) to files that grow: of every four, one is replaced by another file
    in the second run and one is cut to nothing and written again in the third; the others are appended to. Returns the
    bytes written per path."""
    kind = F.pmod(F.regexp_extract("path", "[0-9]+", 0).cast("long"), F.lit(4))
    how = F.when((kind == 0) & F.lit(run == 1), "replace").when((kind == 1) & F.lit(run == 2), "rewrite").otherwise("append")
    rows = lines.where(F.col("run") == run).select("path", how.alias("how"), "block", "line", "value")
    root = local_path(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(root, exist_ok=True)
        begun: set[str] = set()
        for batch in batches:
            by_path: dict[tuple[str, str], list[str]] = {}
            for path, how_, value in zip(*(batch.column(c).to_pylist() for c in ("path", "how", "value"))):
                by_path.setdefault((path, how_), []).append(value)
            sizes = []
            for (path, how_), values in by_path.items():
                text, name = "".join(v + "\n" for v in values).encode(), f"{root}/{path}.jsonl"
                made = f"{name}.new" if how_ == "replace" and path not in begun else name
                with open(made, "wb" if how_ != "append" and path not in begun else "ab") as f:
                    f.write(text)
                if made != name:
                    os.replace(made, name)
                begun.add(path)
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in by_path], pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

    ordered = rows.repartition("path").sortWithinPartitions("path", "block", "line")
    return settle(ordered.mapInArrow(write, "path string, bytes long"), "grown")
