"""The last stored row of each key, kept beside a store.

A gate that must know a session's last stored reading asks this table instead of the store. Keys are dealt to BUCKETS
buckets; each merge writes new versions of the buckets it touches, and then a commit: the version each bucket is at,
and `through`, the highest arrival number merged so far. Readers open the buckets of their batch only, by path, so what
they list and read does not grow with the store or the number of merges. A merge cut short leaves a version no commit
names, which the next one overwrites.

The store itself is what counts: rows it holds above `through` (a crash came between an append and its merge, or the
table is new) are folded in when the table is read, by a filter on the arrival number that files and row groups answer
from their statistics."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterloom.session import settle
from meterloom.sources.tables import stored

BUCKETS = 256
_COMMIT = "version LONG, through LONG, versions ARRAY<LONG>"


class LastValues:
    """`path`: the folder of the table. `keys`: columns of the store. `values`: the struct kept of a key's last row.
    `of`: which of the store's rows count. `by` is the store's arrival number."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], values: Column, of: Column | None = None, by: str = "ingest_id"):
        self.spark, self.path, self.keys, self.values, self.of, self.by = spark, path, keys, values, of, by

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def commit(self) -> tuple[int, int | None, list[int]]:
        """The newest commit: its version, `through`, and the version of each bucket (0: it has none)."""
        done = stored(self.spark, f"{self.path}/commits", _COMMIT)
        last = done.agg(F.max(F.struct("version", "through", "versions")).alias("c")).first()["c"]
        return (last["version"], last["through"], list(last["versions"])) if last else (0, None, [0] * BUCKETS)

    def lasts(self, rows: DataFrame) -> DataFrame:
        """keys, `at` and `last_values` of the last of these rows per key."""
        counted = rows if self.of is None else rows.where(self.of)
        kept = counted.groupBy(*self.keys).agg(F.max(self.by).alias("at"), F.max_by(self.values, self.by).alias("last_values"))
        return kept.select(*self.keys, F.col("at").cast("long").alias("at"), "last_values")

    def _held(self, buckets: list[int], versions: list[int], like: DataFrame) -> DataFrame:
        paths = [f"{self.path}/data/version={versions[b]}/bucket={b}" for b in buckets if versions[b]]
        schema = like.select(*self.keys, "at", "last_values").schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, batch: DataFrame, store: DataFrame) -> DataFrame:
        """keys and `last_values` for the keys of the batch, as the store holds them now."""
        _, through, versions = self.commit()
        asked = batch.select(*self.keys).distinct()
        buckets = sorted(r["b"] for r in asked.select(self.bucket().alias("b")).distinct().collect())
        tail = self.lasts(store if through is None else store.where(F.col(self.by) > through))
        newest = self._held(buckets, versions, tail).unionByName(tail).join(asked, self.keys, "left_semi")
        return newest.groupBy(*self.keys).agg(F.max_by("last_values", "at").alias("last_values"))

    def merge(self, store: DataFrame, batch: DataFrame) -> None:
        """Brings the table up to the store after `batch` was appended to it (whose numbers may be lower than others').
        Only the buckets of new rows are read and written."""
        version, through, versions = self.commit()
        new = store
        if through is not None:
            new = store.where(F.col(self.by) > through).unionByName(batch.select(*store.columns))
        top = new.agg(F.max(self.by)).first()[0]
        if top is None:
            return
        tail = settle(self.lasts(new), "last-values")
        buckets = sorted(r["b"] for r in tail.select(self.bucket().alias("b")).distinct().collect())
        both = self._held(buckets, versions, tail).unionByName(tail)
        rows = both.groupBy(*self.keys).agg(F.max("at").alias("at"), F.max_by("last_values", "at").alias("last_values"))
        made = version + 1
        (rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/data/version={made}"))
        for b in buckets:
            versions[b] = made
        told = self.spark.createDataFrame([(made, max(int(top), through or 0), versions)], _COMMIT)
        told.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
