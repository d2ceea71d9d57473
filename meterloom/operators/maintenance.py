"""Dataset maintenance: rebuild, label, seed, back up, repartition."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterloom import schemas
from meterloom.operators import digests
from meterloom.operators.reconcile import label_machine, missing_from
from meterloom.session import settle
from meterloom.sinks import gates
from meterloom.sources.tables import stored


def label_table(spark: SparkSession, path: str, shared: DataFrame, machine: str, out: str) -> DataFrame:
    """A readings table with its unlabelled rows named, written to a new folder (a table is never rewritten in place)."""
    label_machine(stored(spark, path, schemas.ACCOUNT_QUOTAS), shared, machine).write.parquet(out)
    return stored(spark, out, schemas.ACCOUNT_QUOTAS)


def seed(spark: SparkSession, source: DataFrame, path: str, shared: DataFrame, machine: str) -> int:
    """Copies a store's readings into another, labelled unless shared, skipping those it holds; raises if any is still
    missing afterwards. Returns how many were copied."""
    held = stored(spark, path, schemas.ACCOUNT_QUOTAS)
    named = label_machine(source.withColumn("machine", F.lit(None).cast("string")), shared, machine)
    new = settle(missing_from(named, held).dropDuplicates(["row_hash"]), "seed")
    gates.append_rows(new, path, schemas.ACCOUNT_QUOTAS)
    left = missing_from(source, stored(spark, path, schemas.ACCOUNT_QUOTAS)).count()
    if left:
        raise ValueError(f"{left} readings missing after the copy")
    return new.count()


def back_up(spark: SparkSession, tables: dict[str, tuple[str, str]], out: str) -> DataFrame:
    """Copies tables (name: path, schema) to a folder and returns the row count of each copy beside its source's."""
    counted = None
    for name, (path, schema) in tables.items():
        rows = stored(spark, path, schema)
        rows.write.parquet(f"{out}/{name}")
        copy = spark.read.schema(rows.schema).parquet(f"{out}/{name}")
        line = copy.agg(F.count(F.lit(1)).alias("copied")).select(
            F.lit(name).alias("table"), "copied", rows.select(F.count(F.lit(1))).scalar().alias("rows"))
        counted = line if counted is None else counted.unionByName(line)
    return counted


def foreign_machines(slots: DataFrame, machine: str) -> DataFrame:
    return slots.select("machine").distinct().where(~F.col("machine").eqNullSafe(machine))


def move_slots(spark: SparkSession, slots: DataFrame, path: str, machine: str | None = None) -> int:
    """Slots into a folder partitioned by machine. With `machine`, rows of any other refuse the whole move."""
    if machine is not None:
        other = foreign_machines(slots, machine).first()
        if other is not None:
            raise ValueError(f"slots of {other['machine']!r}, not only {machine!r}")
    slots.write.partitionBy("machine").parquet(path)
    return stored(spark, path, schemas.SLOTS).count()


def check_facts(old: DataFrame, new: DataFrame, values: list[str]) -> DataFrame:
    """Counts of old facts missing from or different in the new store; raises when there is any."""
    counted = settle(digests.compare_stores(old, new, values), "compared")
    row = counted.first()
    if row["missing"] or row["different"]:
        raise ValueError(f"facts differ: {row.asDict()}")
    return counted
