"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs for right results; sizes are left to the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "8", name: str = "meterloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g"))
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees. The cluster names it in spark.checkpoint.dir; a local master may go without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="meterloom-"))
    return context.getCheckpointDir()


def settle(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back. What is used several times is computed once, a lost
    executor costs one task, and Spark knows the table's true size when it plans the joins that follow."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for one run's intermediate table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
