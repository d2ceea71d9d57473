"""New transcript lines to requests and turns: what was read is never read again, what is unfinished waits, and what a
file said before its new lines is remembered."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterloom import schemas
from meterloom.fixed_values import FINAL_AFTER_S
from meterloom.operators.dedup import largest_output
from meterloom.plans.jobs import store_requests, store_turns
from meterloom.session import settle
from meterloom.sinks import gates
from meterloom.sources.growing import growing_lines
from meterloom.sources.tables import stored
from meterloom.sources.readings import dated_payload_rows
from meterloom.sources.transcripts import answer_times, contexts, request_lines, turn_records, turns_of
from meterloom.streaming.dating import dated

_PENDING = """path STRING, block LONG, line LONG, ts LONG, request_id STRING, session_id STRING, folder STRING, entrypoint STRING,
    model STRING, input_tokens LONG, output_tokens LONG, cache_read_tokens LONG, cache_write_5m_tokens LONG, cache_write_1h_tokens LONG"""


def ingest_requests(spark: SparkSession, folder: str, requests_path: str, scans_path: str, pending_path: str, checkpoint: str,
                    now: int, files_per_batch: int = 1000):
    """The requests of transcript segments that landed since the last run (segments are written once; files that are
    appended to belong to follow_requests)."""
    text = (spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
            .option("maxFilesPerTrigger", files_per_batch).text(folder)
            .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")))
    return _requests(spark, text, requests_path, scans_path, pending_path, checkpoint, now)


def follow_requests(spark: SparkSession, folder: str, requests_path: str, scans_path: str, pending_path: str, checkpoint: str,
                    now: int):
    """The requests of what was appended to a transcript tree since the last run; files may also be replaced or cut."""
    lines = growing_lines(spark, folder, f"{checkpoint}-ledger")
    return _requests(spark, lines, requests_path, scans_path, pending_path, checkpoint, now)


def _requests(spark: SparkSession, text: DataFrame, requests_path: str, scans_path: str, pending_path: str, checkpoint: str, now: int):
    """A request whose first line is younger than 15 minutes keeps all its lines in the pending table of this batch, where
    the next batch finds them. A batch that runs twice writes the same pending table again and its requests meet their
    own ids, so nothing is added twice."""
    complete_before = now - FINAL_AFTER_S

    def one(batch: DataFrame, number: int) -> None:
        before = stored(spark, f"{pending_path}/batch={number - 1}", _PENDING)
        fresh = request_lines(batch if "line" in batch.columns else batch.withColumn("line", F.monotonically_increasing_id()))
        lines = gates.settle(fresh.unionByName(before), "request-lines")
        first = lines.groupBy("request_id").agg(F.min("ts").alias("_first"))
        young = first.where(F.col("_first") > complete_before).select("request_id")
        (lines.join(young, "request_id", "left_semi").select(*gates.column_names(_PENDING)).write.mode("overwrite")
         .parquet(f"{pending_path}/batch={number}"))
        store_requests(largest_output(lines).where(F.col("ts") <= complete_before), requests_path)

    held = stored(spark, requests_path, schemas.REQUESTS).count()
    query = (text.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    # Without a new segment no batch runs, yet what waits may have become old enough.
    waiting = stored(spark, pending_path, _PENDING + ", batch LONG")
    last = waiting.where(F.col("batch") == waiting.select(F.max("batch")).scalar()).drop("batch")
    store_requests(largest_output(last).where(F.col("ts") <= complete_before), requests_path)
    added = stored(spark, requests_path, schemas.REQUESTS).count() - held
    gates.add_scan(spark, scans_path, now, complete_before, added)
    return added


_CONTEXT = "path STRING, thread STRING, entrypoint STRING, folder STRING, model STRING"


def follow_turns(spark: SparkSession, folder: str, turns_path: str, scans_path: str, contexts_path: str, checkpoint: str,
                 machine: str, now: int, **prices) -> int:
    """The second agent's turns of what was appended since the last run. Each batch leaves every file's context for the
    next one; a batch that runs twice starts from the same contexts and adds no turn again."""
    lines = growing_lines(spark, folder, f"{checkpoint}-ledger")

    def one(batch: DataFrame, number: int) -> None:
        before = stored(spark, f"{contexts_path}/batch={number - 1}", _CONTEXT)
        records = settle(turn_records(batch, before), "turn-records")
        contexts(records, before).write.mode("overwrite").parquet(f"{contexts_path}/batch={number}")
        store_turns(turns_of(records, machine, **prices), turns_path)

    held = stored(spark, turns_path, schemas.TURNS).count()
    query = lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    added = stored(spark, turns_path, schemas.TURNS).count() - held
    gates.add_scan(spark, scans_path, now, now - 60, added)
    return added


def follow_payloads(spark: SparkSession, payloads: DataFrame, folder: str, account_path: str, errors_path: str, snapshots_path: str,
                    checkpoint: str, machine: str, now: int, delay: str = "10 minutes") -> None:
    """Display payloads (a stream of `value`, `ingest_id`, `arrived`) to both gates, each dated by what its transcript
    said when it arrived; the transcripts are followed as they grow. A payload waits in the stream's state until a run that
    follows one which saw rows `delay` past it. Needs the RocksDB store."""
    told = answer_times(growing_lines(spark, folder, f"{checkpoint}-ledger").withColumn("path", F.regexp_replace("path", "#[0-9]+$", "")))
    shown = payloads.select("value", "ingest_id", "arrived", F.get_json_object("value", "$.transcript_path").alias("path"))

    def one(batch: DataFrame, number: int) -> None:
        rows = settle(batch.select("ingest_id", "value", "observed_at"), "dated-payloads")
        account, session = dated_payload_rows(rows, F.lit(now), machine)
        gates.add_readings(account, account_path, errors_path, "claude", batch=f"payloads-{number}")
        gates.add_snapshots(session, snapshots_path, batch=f"payloads-{number}")

    query = (dated(shown, told, delay).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
