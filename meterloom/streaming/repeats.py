"""Per-key last value in a stream: rows that repeat the last kept row of their key are dropped."""

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType


class RepeatFilter(StatefulProcessor):
    """Keeps a row when its values differ from the last kept row of the key, in arrival order. The state of a key is
    one row. A trigger's rows of a key come as Arrow batches in no order, so their order is settled first; how many
    they can be is what the source's maxFilesPerTrigger allows."""

    def __init__(self, values: list[str], by: str, state: StructType):
        self.values, self.by, self.state = values, by, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.by, ignore_index=True)
        now = batch[self.values].astype(object).where(batch[self.values].notna(), None)
        before = now.shift(1)
        if len(batch):
            before.iloc[0] = None
        same = ((now == before) | (now.isna() & before.isna())).all(axis=1)
        held = self.last.get() if self.last.exists() else None
        first = tuple(now.iloc[0])
        same.iloc[0] = held is not None and tuple(None if pd.isna(v) else v for v in held) == first
        self.last.update(tuple(now.iloc[-1]))
        yield batch[~same]

    def close(self) -> None:
        pass


def drop_repeats(rows: DataFrame, keys: list[str], values: list[str], by: str = "ingest_id") -> DataFrame:
    """The stream without rows that repeat the last kept row of their keys (NULLs equal). Needs the RocksDB store."""
    state = StructType([rows.schema[v] for v in values])
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=RepeatFilter(values, by, state), outputStructType=rows.schema, outputMode="Append", timeMode="None")


ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
