"""Stored tables: columnar reads that prune columns and partitions."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from meterloom import schemas
from meterloom.operators.slots import countable_slots
from meterloom.operators.windows import readings as typed_readings


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table by its declared schema; a column older files lack is NULL. A path nothing was written to is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def all_slots(spark: SparkSession, path: str) -> DataFrame:
    """The slots of every machine, error stubs left out; `machine` is the partition column."""
    return countable_slots(stored(spark, path, schemas.SLOTS))


def all_readings(spark: SparkSession, path: str, **options) -> DataFrame:
    return typed_readings(stored(spark, path, schemas.ACCOUNT_QUOTAS), **options)
