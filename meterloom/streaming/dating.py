"""Payloads dated as they arrive: each by the last answer its transcript had then, whatever is read in one batch."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "path STRING, ingest_id LONG, value STRING, arrived LONG, observed_at LONG"
_ROWS = 10_000
#: Transcripts share state by buckets; what a bucket holds is what waits of its transcripts, and an answer of each.
BUCKETS = 2048
_ANSWER = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("at", "block", "line", "ts")]])
_PAYLOAD = pa.schema([("path", pa.string()), ("at", pa.int64()), ("ingest_id", pa.int64()), ("value", pa.string())])


class Dating(StatefulProcessor):
    """Per bucket of transcripts: answers and payloads wait until the watermark has passed them; then every answer up to
    there is known, and the payloads up to there get their transcript's last one at or before their arrival (of two at one
    time the later line). Of the answers passed only each transcript's last is kept. Input comes in any order and in frames
    of any size: a frame's rows are one entry of a list, so state is spoken to once a frame, not once a row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.answers = handle.getListState("answers", "rows binary")
        self.waiting = handle.getListState("waiting", "rows binary")
        self.last = handle.getListState("last", "rows binary")
        self.through = handle.getValueState("through", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame = frame.assign(at=frame["at"].to_numpy("datetime64[us]").astype(np.int64))
            is_answer = frame["answer"].to_numpy(bool)
            told, shown = frame[is_answer], frame[~is_answer]
            if len(told):
                self.answers.appendList(_packed(told, _ANSWER))
            if len(shown):
                self.waiting.appendList(_packed(shown, _PAYLOAD))
                self._wake(int(shown["at"].min()))
            elif len(told):
                self._wake(int(told["at"].max()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        if self.through.exists() and self.through.get()[0] >= now:
            return
        self.through.update((now,))
        waiting, answers = _rows(self.waiting, _PAYLOAD), _rows(self.answers, _ANSWER)
        passed = answers["at"] <= now
        known = pd.concat([_rows(self.last, _ANSWER), answers[passed]]).sort_values(["at", "block", "line"], kind="stable")
        asked = waiting["at"] <= now
        out = pd.merge_asof(waiting[asked].sort_values("at", kind="stable"), known[["path", "at", "ts"]], on="at", by="path")
        kept = waiting[~asked]
        _put(self.last, known.drop_duplicates("path", keep="last"), _ANSWER)
        _put(self.answers, answers[~passed], _ANSWER)
        _put(self.waiting, kept, _PAYLOAD)
        if len(kept):
            self._wake(int(kept["at"].min()))
        out = out.assign(arrived=out["at"] // 1_000_000).rename(columns={"ts": "observed_at"})[["path", "ingest_id", "value", "arrived", "observed_at"]]
        for start in range(0, len(out), _ROWS):
            yield out[start:start + _ROWS]

    def _wake(self, at: int) -> None:
        """One timer a frame, for its first payload: it settles all that the watermark has passed and sets the next."""
        self.handle.registerTimer((at // 1_000_000 + 1) * 1000)

    def close(self) -> None:
        pass


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> list[tuple]:
    """The rows as Arrow streams of at most _ROWS each."""
    out = []
    for start in range(0, len(rows), _ROWS):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as made:
            made.write_table(pa.Table.from_pandas(rows[start:start + _ROWS][schema.names], schema=schema, preserve_index=False))
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _rows(state, schema: pa.Schema) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(bytes(rows)).read_all() for rows, in state.get()] if state.exists() else []
    made = pa.concat_tables([schema.empty_table(), *parts]).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
    return made.astype({"at": "int64"})


def _put(state, rows: pd.DataFrame, schema: pa.Schema) -> None:
    state.put(_packed(rows, schema)) if len(rows) else state.clear()


def dated(payloads: DataFrame, answers: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """payloads: a stream of (path, arrived TIMESTAMP, ingest_id, value); answers: one of (path, at TIMESTAMP, block, line,
    ts), ts NULL where the answer's stamp is no UTC one, which dates nothing. Each payload once, with `observed_at`, as
    soon as the watermark, `delay` behind the newest row, has passed it. Needs the RocksDB store."""
    path = F.coalesce(F.col("path"), F.lit("")).alias("path")
    zero = F.lit(0).cast("long")  # no NULL: pandas would make the column double
    a = answers.select(path, "at", F.lit(True).alias("answer"), F.col("block").cast("long"), F.col("line").cast("long"), F.col("ts").cast("long"),
                       zero.alias("ingest_id"), F.lit(None).cast("string").alias("value"))
    p = payloads.select(path, F.col("arrived").alias("at"), F.lit(False).alias("answer"), zero.alias("block"), zero.alias("line"),
                        F.lit(None).cast("long").alias("ts"), F.col("ingest_id").cast("long"), "value")
    both = a.unionByName(p).withWatermark("at", delay)
    return both.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(BUCKETS))).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Dating(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
