"""Line-delimited logs: the scan itself, and arrival numbers for new rows."""

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def read_lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """Every line under a folder tree: value, path, block (start of its input split) and line. Inside a split `line`
    rises; a file's order is (block, line). Large files are split, so no file is one task."""
    text = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path))
    return with_place(text)


def with_place(text: DataFrame) -> DataFrame:
    return text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("line"))


def parsed(rows: DataFrame, schema: str, *keep: str, value: str = "value") -> DataFrame:
    """JSON text as columns, next to the columns to keep. As a generator of one row the parse runs once per line; as a
    projection its filters would be pushed below it and parse again. Text that is no object gives a row of NULLs."""
    return rows.select(*keep, F.inline(F.array(F.from_json(value, schema))))


def computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, whatever later filters and projections make of them. Spark copies a
    costly expression into every filter it pushes and every expression that uses it; a generator of one row stops that."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def number_rows(rows: DataFrame, after: int = 0) -> DataFrame:
    """Adds ingest_id: consecutive arrival numbers above `after` in (path, block, line) order. Each split is numbered
    on its own; a running total over one row per split says where it starts. Number a batch once, as it is stored."""
    place = W.orderBy("path", "block")
    per = rows.groupBy("path", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("line").alias("_first"), F.max("line").alias("_last"))
    starts = per.withColumn("_start", F.coalesce(F.sum("_n").over(place.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    within = W.partitionBy("path", "block").orderBy("line")
    return (rows.join(starts.select("path", "block", "_start"), ["path", "block"])
            .withColumn("ingest_id", F.lit(after) + F.col("_start") + F.row_number().over(within))
            .drop("_start"))


def next_ingest_id(table: DataFrame) -> int:
    """The highest arrival number a table holds (0 when empty)."""
    return table.agg(F.max("ingest_id").alias("v")).first()["v"] or 0
