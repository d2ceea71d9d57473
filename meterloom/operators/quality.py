"""Freshness, lateness and data-quality counts."""

from pyspark.sql import DataFrame, functions as F

from meterloom.fixed_values import STALE_AFTER_S


def latest(account_quotas: DataFrame, now: int) -> DataFrame:
    """The freshest reading, by when it was true, then by arrival. A window whose reset has passed reads 0 % and has no
    reset; one without a known reset keeps its percent. Spark keeps one row per task for this limit."""
    one = (account_quotas.where(F.col("five_hour_pct").isNotNull() | F.col("seven_day_pct").isNotNull())
           .orderBy(F.desc("ts"), F.desc("ingest_id")).limit(1))
    def passed(name):
        return F.coalesce(F.col(f"{name}_resets_ts") <= now, F.lit(False))
    columns = []
    for name in ("five_hour", "seven_day"):
        columns += [F.when(passed(name), F.lit(0.0)).otherwise(F.col(f"{name}_pct")).alias(f"{name}_pct"),
                    F.when(~passed(name), F.col(f"{name}_resets_ts")).alias(f"{name}_resets_ts")]
    return one.select("ts", "dt", "source", "machine", *columns)


def newest_age(account_quotas: DataFrame, now: int) -> DataFrame:
    return latest(account_quotas, now).select((F.lit(now) - F.col("ts")).alias("age_s"))


def last_attempt(account_quotas: DataFrame, poll_errors: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """The newest reading or failed attempt by write time; at the same second the failure counts."""
    if sources:
        account_quotas = account_quotas.where(F.col("source").isin(sources))
        poll_errors = poll_errors.where(F.col("source").isin(sources))
    read = account_quotas.agg(F.max("written_ts").alias("ts")).select("ts", F.lit(None).cast("string").alias("error"))
    failed = (poll_errors.orderBy(F.desc("ts"), F.desc("ingest_id")).limit(1)
              .select("ts", F.get_json_object("raw", "$.error").alias("error")))
    both = read.withColumn("_failed", F.lit(0)).unionByName(failed.withColumn("_failed", F.lit(1)))
    return both.where(F.col("ts").isNotNull()).orderBy(F.desc("ts"), F.desc("_failed")).limit(1).drop("_failed")


def staleness(scans: DataFrame, now: int, after: int = STALE_AFTER_S) -> DataFrame:
    """Whether the last successful run is too long ago. No run at all is stale."""
    last = F.max("ts")
    return scans.agg(last.alias("last_ok_ts")).select(
        "last_ok_ts", (F.lit(now) - F.coalesce("last_ok_ts", F.lit(0)) >= after).alias("stale"))


def key_sets(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Rows per set of top-level keys in their raw JSON."""
    keys = F.array_join(F.array_sort(F.json_object_keys(raw)), ",")
    return rows.groupBy(keys.alias("keys")).agg(F.count(F.lit(1)).alias("rows"))


def failure_rates(account_quotas: DataFrame, poll_errors: DataFrame) -> DataFrame:
    """Attempts and failures per source."""
    both = account_quotas.select("source", F.lit(0).alias("_f")).unionByName(poll_errors.select("source", F.lit(1).alias("_f")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("attempts"), F.sum("_f").alias("failures"),
                                      F.avg("_f").alias("failure_rate"))


def fractional_percents(account_quotas: DataFrame) -> DataFrame:
    def odd(c):
        return F.count_if(F.col(c) != F.floor(c))
    return account_quotas.agg(F.count(F.lit(1)).alias("rows"), odd("five_hour_pct").alias("five_hour_fractional"),
                              odd("seven_day_pct").alias("seven_day_fractional"))


def rows_per(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def lateness(rows: DataFrame, event: str = "ts", received: str = "received_ts") -> DataFrame:
    """How late events arrive: within a minute, over 15 minutes, at most."""
    late = F.col(received) - F.col(event)
    return rows.where(late.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(late <= 60).alias("within_60_s"),
        F.count_if(late > 900).alias("over_15_min"), F.max(late).alias("max_late_s"))


def lines_per_request(lines: DataFrame) -> DataFrame:
    """How many lines a request takes, and how long they span at most."""
    per = lines.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"), (F.max("ts") - F.min("ts")).alias("_span"))
    return per.agg(F.count(F.lit(1)).alias("requests"), F.sum("_n").alias("lines"),
                   (F.sum("_n") / F.count(F.lit(1))).alias("lines_per_request"), F.max("_span").alias("max_span_s"))
