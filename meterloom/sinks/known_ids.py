"""Which files of a store may hold an id: a Bloom filter per file, kept beside the store.

A file's filter is as many segments of BITS bits as its rows ask for (a power of two, at least PER_ROW bits a row); an id
sets HASHES bits of one segment. Segments are built by aggregates and stored as rows, and a batch's ids are grouped by
segment too, so the batch meets the filters in one equi-join: each segment of each file is tested once, whatever the
number of ids. Filters never miss an id that a file holds; a file that is not in the table yet (a crash came before its
filter was built) is read. With each file goes its highest arrival number, so the next one is known without a scan. A batch of more than MOST ids would hit nearly every file: it is joined to the whole store."""

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterloom.session import settle
from meterloom.sources.tables import stored

BITS = 32_768
PER_ROW = 32
HASHES = 8
MOST = 200_000
_FILTERS = "file STRING, segments LONG, segment LONG, bits BINARY, top LONG"


def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key)


def _position(key: Column, n: int) -> Column:
    return F.pmod(_hash(key, n + 1), F.lit(BITS)).cast("int")


def _positions(key: Column) -> Column:
    return F.array(*[_position(key, n) for n in range(HASHES)])


def _segment(key: Column, segments: Column) -> Column:
    return F.pmod(_hash(key, 0), segments)


class KnownIds:
    """`store`: the folder of the table; `key`: its id column. Filters are in `<store>-known-<key>`."""

    def __init__(self, spark: SparkSession, store: str, schema: str, key: str):
        self.spark, self.store, self.schema, self.key, self.path = spark, store, schema, key, f"{store}-known-{key}"

    def files(self) -> set[str]:
        return set(stored(self.spark, self.store, self.schema).inputFiles())

    def _open(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*map(unquote, files))

    def filtered(self) -> set[str]:
        return {r["file"] for r in stored(self.spark, self.path, _FILTERS).select("file").distinct().collect()}

    def update(self) -> None:
        """Builds the filters of files that have none."""
        new = sorted(self.files() - self.filtered())
        if not new:
            return
        self.filters_of(new).write.mode("append").parquet(self.path)

    def filters_of(self, files: list[str]) -> DataFrame:
        """The filters of some files, a row per segment."""
        rows = self._open(files).select(
            F.input_file_name().alias("file"), F.col(self.key).alias("id"), "ingest_id")
        # A file travels as a number, and an id once, with all its bits: what a task sorts is a few longs a row.
        sizes = settle(rows.groupBy("file").agg(
            F.max("ingest_id").alias("top"),
            F.greatest(F.lit(1), F.pow(2, F.ceil(F.log2(F.count(F.lit(1)) * PER_ROW / BITS)))).cast("long").alias("segments"))
            .withColumn("file_no", F.monotonically_increasing_id()), "filter-sizes")
        placed = rows.join(sizes.select("file", "file_no", "segments"), "file").select(
            "file_no", _segment(F.col("id"), F.col("segments")).alias("segment"), "id")
        each = placed.groupBy("file_no", "segment").agg(F.array(*[
            F.bitmap_construct_agg(_position(F.col("id"), n).cast("long")) for n in range(HASHES)]).alias("each"))
        bits = (each.select("file_no", "segment", F.explode("each").alias("one")).groupBy("file_no", "segment")
                .agg(F.bitmap_or_agg("one").alias("bits")).join(sizes, "file_no"))
        return bits.select(*[c.split()[0] for c in _FILTERS.split(", ")])

    def highest(self) -> int:
        """The highest arrival number of the store, 0 when it is empty. Only files without a filter are read."""
        new = sorted(self.files() - self.filtered())
        tops = stored(self.spark, self.path, _FILTERS).select("top")
        if new:
            tops = tops.unionByName(self._open(new).select(F.col("ingest_id").alias("top")))
        return tops.agg(F.max("top")).first()[0] or 0

    def candidates(self, ids: DataFrame) -> list[str]:
        """The files that may hold one of these ids (`key`); all of them where the batch is too large to ask."""
        files = self.files()
        asked = settle(ids.select(F.col(self.key).alias("id")).where("id is not null").distinct(), "asked-ids")
        if asked.count() > MOST:
            return sorted(files)
        filters = stored(self.spark, self.path, _FILTERS)
        widths = [r["segments"] for r in filters.select("segments").distinct().collect()]  # powers of two, so a few dozen at most
        wanted = asked.select("id", F.explode(F.array(*map(F.lit, widths)).cast("array<bigint>")).alias("segments")).select(
            "segments", _segment(F.col("id"), F.col("segments")).alias("segment"), _positions(F.col("id")).alias("bits_of_id"))
        grouped = wanted.groupBy("segments", "segment").agg(F.flatten(F.collect_list("bits_of_id")).alias("asked"))
        hit = filters.join(grouped, ["segments", "segment"]).select("file", "bits", "asked").mapInArrow(_hits, "file string").distinct()
        return sorted((files - self.filtered()) | ({r["file"] for r in hit.collect()} & files))

    def holding(self, ids: DataFrame) -> DataFrame:
        """The rows of the files that may hold one of these ids."""
        files = self.candidates(ids)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self._open(files)


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of filters in which all bits of some asked id are set."""
    for batch in batches:
        found = []
        for file, bits, asked in zip(batch.column("file").to_pylist(), batch.column("bits").to_pylist(), batch.column("asked")):
            at = np.asarray(asked.values)
            held = np.frombuffer(bits, np.uint8)
            if ((held[at >> 3] >> (at & 7)) & 1).reshape(-1, HASHES).all(axis=1).any():
                found.append(file)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])
