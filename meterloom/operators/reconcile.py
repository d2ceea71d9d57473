"""Comparing stores and sources that should agree."""

from pyspark.sql import Column, DataFrame, functions as F

from meterloom.fixed_values import REQUEST_PRICES, TOKEN_COLUMNS
from meterloom.functions.numbers import difference, list_price_usd, tokens
from meterloom.operators.quantiles import exact_median
from meterloom.operators.slots import telemetry_requests
from meterloom.session import settle

REQUEST_TOKENS = ["input_tokens", "output_tokens", "cache_read_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens"]


def shared_hashes(a: DataFrame, b: DataFrame, key: str = "row_hash") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def shared_by_source(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many rows both stores hold, per source."""
    return (a.join(b.select("row_hash"), "row_hash", "left_semi").groupBy("source")
            .agg(F.count_distinct("row_hash").alias("shared")))


def missing_from(source: DataFrame, target: DataFrame, key: str = "row_hash") -> DataFrame:
    return source.join(target.select(key), key, "left_anti")


def label_machine(rows: DataFrame, shared: DataFrame, machine: str) -> DataFrame:
    """Names the machine on rows that have none, except those both stores hold: nobody knows who took these."""
    flag = shared.select("row_hash").distinct().withColumn("_shared", F.lit(True))
    own = F.col("machine").isNull() & F.col("_shared").isNull()
    return (rows.join(flag, "row_hash", "left")
            .withColumn("machine", F.when(own, F.lit(machine)).otherwise(F.col("machine"))).select(*rows.columns))


def compare_facts(old: DataFrame, new: DataFrame, values: list[str], key: str = "request_id") -> DataFrame:
    """Old rows that the new store misses or holds with other values, each with its state."""
    pack = lambda df, name: df.select(key, F.struct(*values).alias(name))
    both = pack(old, "old").join(pack(new, "new"), key, "left")
    state = (F.when(F.col("new").isNull(), F.lit("missing"))
             .when(~F.col("old").eqNullSafe(F.col("new")), F.lit("different")).otherwise(F.lit("same")))
    return both.withColumn("state", state)


def fact_counts(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count(F.lit(1)).alias("old_rows"), F.count_if(F.col("state") == "missing").alias("missing"),
                        F.count_if(F.col("state") == "different").alias("different"))


def slot_totals(slots: DataFrame) -> DataFrame:
    every = sum((F.col(c) for c in TOKEN_COLUMNS[1:]), F.col(TOKEN_COLUMNS[0]))
    return slots.agg(F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"), F.coalesce(F.sum(every), F.lit(0)).alias("tokens"),
                     F.round(F.coalesce(F.sum("usd"), F.lit(0.0)), 6).alias("usd"),
                     F.coalesce(F.sum("tokens_without_usd"), F.lit(0)).alias("tokens_without_usd"))


def recount(requests: DataFrame, telemetry: DataFrame, end: int) -> DataFrame:
    """The same four totals counted from the requests and the telemetry themselves, before `end`."""
    reported = telemetry_requests(telemetry, "ts", "cost_usd", "input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens").select(
        "request_id", F.col("ts").alias("_ts"), F.col("cost_usd"),
        (tokens(F.col("input_tokens")) + tokens(F.col("output_tokens")) + tokens(F.col("cache_read_tokens"))
         + tokens(F.col("cache_creation_tokens"))).alias("_tokens"))
    mine = requests.select("request_id", "ts", sum((F.col(c) for c in REQUEST_TOKENS[1:]), F.col(REQUEST_TOKENS[0])).alias("tokens"))
    both = mine.join(reported, "request_id", "full").where(F.coalesce("ts", "_ts") < end)
    n = F.coalesce("tokens", "_tokens")
    return both.agg(F.count(F.lit(1)).alias("requests"), F.coalesce(F.sum(n), F.lit(0)).alias("tokens"),
                    F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 6).alias("usd"),
                    F.coalesce(F.sum(F.when(F.col("cost_usd").isNull(), n)), F.lit(0)).alias("tokens_without_usd"))


def check_slots(slots: DataFrame, requests: DataFrame, telemetry: DataFrame, end: int) -> DataFrame:
    """Both counts side by side, and whether they agree."""
    a = slot_totals(slots).withColumn("counted", F.lit("slots"))
    b = recount(requests, telemetry, end).withColumn("counted", F.lit("requests"))
    return a.unionByName(b)


def require_agreement(checked: DataFrame) -> None:
    """Raises when the two counts of check_slots differ."""
    rows = checked.drop("counted").distinct().limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"slots and requests disagree: {rows[0].asDict()} / {rows[1].asDict()}")


def matched_requests(requests: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Requests both sources know, each one row, with the reported figures beside the counted ones."""
    reported = telemetry_requests(telemetry, "input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens", "cost_usd").select(
        "request_id", *[F.col(c).alias(f"reported_{c}") for c in
                        ("input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens", "cost_usd")])
    return requests.join(reported, "request_id")


def token_mismatches(matched: DataFrame) -> DataFrame:
    ours = F.struct(F.col("input_tokens").alias("a"), F.col("output_tokens").alias("b"), F.col("cache_read_tokens").alias("c"),
                    (F.col("cache_write_5m_tokens") + F.col("cache_write_1h_tokens")).alias("d"))
    theirs = F.struct(*[F.col(f"reported_{c}").alias(n) for c, n in
                        (("input_tokens", "a"), ("output_tokens", "b"), ("cache_read_tokens", "c"), ("cache_creation_tokens", "d"))])
    return matched.agg(F.count(F.lit(1)).alias("matched"), F.count_if(~ours.eqNullSafe(theirs)).alias("mismatches"))


def price_errors(matched: DataFrame, prices=REQUEST_PRICES) -> DataFrame:
    """Per model how well the price table reproduces the reported cost: exact median and total relative error, and how
    many requests are off by more than 1 %."""
    usd = list_price_usd(F.col("model"), *[F.col(c) for c in REQUEST_TOKENS], prices=prices)
    ref = F.col("reported_cost_usd")
    rows = (matched.withColumn("ours", usd).where(F.col("ours").isNotNull() & (ref > 0))
            .select("model", "ours", ref.alias("ref"), (F.abs(F.col("ours") - ref) / ref).alias("err")))
    rows = settle(rows, "price-errors")
    totals = rows.groupBy("model").agg(F.count_if(F.col("err") > 0.01).alias("off_by_1_percent"),
                                       (F.sum("ours") / F.sum("ref") - 1).alias("total_err"))
    return exact_median(rows, ["model"], "err", "median_err").join(totals, "model")


def telemetry_only_cost(requests: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Cost no transcript shows, by what the request was for, largest first, with its share of all reported cost."""
    reported = settle(telemetry_requests(telemetry, "query_source", "cost_usd"), "reported")
    whole = reported.select(F.sum("cost_usd")).scalar()
    return (reported.join(requests.select("request_id"), "request_id", "left_anti").groupBy("query_source")
            .agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("usd"), F.count(F.lit(1)).alias("requests"))
            .withColumn("share", F.col("usd") / F.greatest(whole, F.lit(1e-9))).orderBy(F.desc("usd")))


def monthly(requests: DataFrame, month: Column) -> DataFrame:
    """Tokens per month and model."""
    return requests.groupBy(month.alias("month"), "model").agg(*[F.sum(c).alias(c) for c in REQUEST_TOKENS])


def monthly_against(ours: DataFrame, reference: DataFrame, prices=REQUEST_PRICES) -> DataFrame:
    """A reference report's months and models with our totals (0 where we have none) and how far they are."""
    usd = list_price_usd(F.col("model"), *[F.col(c) for c in REQUEST_TOKENS], prices=prices)
    got = reference.join(ours, ["month", "model"], "left").fillna(0, REQUEST_TOKENS).withColumn("usd", usd)
    pairs = {"in": ("input_tokens", "ref_input"), "out": ("output_tokens", "ref_output"), "read": ("cache_read_tokens", "ref_cache_read")}
    extra = []
    for name, (a, b) in pairs.items():
        extra += [c.alias(f"{name}_{k}") for k, c in difference(F.col(a), F.col(b)).items()]
    written = F.col("cache_write_5m_tokens") + F.col("cache_write_1h_tokens")
    if "ref_cache_write" in reference.columns:
        extra += [c.alias(f"write_{k}") for k, c in difference(written, F.col("ref_cache_write")).items()]
    return got.select("month", "model", *REQUEST_TOKENS, "usd", *extra)
