"""Table-to-table streams: rows go once, and a crash between two commits only sends them again."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterloom import schemas
from meterloom.fixed_values import PAGE_ROWS
from meterloom.sinks import gates


def new_rows(table: DataFrame, after: int, machine: str | None = None, limit: int = PAGE_ROWS) -> DataFrame:
    """A page of one machine's rows by arrival number. Each task keeps at most a page."""
    own = table if machine is None else table.where(F.col("machine") == machine)
    return own.where(F.col("ingest_id") > after).orderBy("ingest_id").limit(limit)


def next_watermark(table: DataFrame, page: DataFrame, after: int, limit: int = PAGE_ROWS) -> int:
    """Where the next page starts: a full page's last row; after a short one, the newest row of any machine."""
    n, last = page.agg(F.count(F.lit(1)), F.max("ingest_id")).first()
    if n == limit:
        return last
    return max(after, table.agg(F.max("ingest_id")).first()[0] or 0)


def send(table: DataFrame, after: int, machine: str | None, deliver: Callable[[DataFrame], None], limit: int = PAGE_ROWS) -> int:
    """Delivers one page and returns the new watermark; when delivery fails the old one stands and the page goes again."""
    page = new_rows(table, after, machine, limit)
    mark = next_watermark(table, page, after, limit)
    deliver(page)
    return mark


def replicate(spark: SparkSession, source: str, schema: str, checkpoint: str, deliver: Callable[[DataFrame, int], None],
              files_per_batch: int = 1000):
    """Everything new in a table folder, batch by batch, until there is nothing left. The checkpoint advances only after
    `deliver` (given a batch and its number) returned, and `deliver` is a gate, so a batch sent twice adds nothing."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (rows.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def replicate_slots(spark: SparkSession, source: str, target: str, checkpoint: str, machine: str | None = None):
    """One machine's slots to another store, through the slot gate."""
    def deliver(batch: DataFrame, _: int) -> None:
        own = batch if machine is None else batch.where(F.col("machine") == machine)
        gates.add_slots(own, target, machine)
    return replicate(spark, source, schemas.SLOTS, checkpoint, deliver)


def merge_both_ways(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> tuple[DataFrame, DataFrame]:
    """What each of two stores must receive: the other machine's own rows it does not hold. Rows learned from the other
    side carry its name, so nothing is echoed back."""
    to_b = a.where(F.col("machine") == name_a).join(b.select("row_hash"), "row_hash", "left_anti")
    to_a = b.where(F.col("machine") == name_b).join(a.select("row_hash"), "row_hash", "left_anti")
    return to_a, to_b


def ingest_readings(spark: SparkSession, source: str, path: str, errors_path: str, agent: str, checkpoint: str,
                    schema: str = "value STRING, ingest_id LONG"):
    """Landed reading lines through the readings gate as they come. The last reading of each session is looked up beside
    the table, for the sessions of the batch only; a session of any size is cut into chunks there. A batch that comes again
    is known by the stream's name and its number."""
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    return replicate(spark, source, schema, checkpoint,
                     lambda batch, n: gates.add_readings(batch, path, errors_path, agent, batch=f"{stream}-{n}"))
