"""Exact order statistics of groups of any size, by repeated histograms.

To find the value at a rank, a group's rows are counted in BINS bins of equal width between its least and largest value;
the bin that holds the rank is the next, narrower range, until a range holds one value only. A round is one aggregate
with partial sums, so a group with any share of the rows is counted where its rows lie; nothing is gathered, sorted or
ranked in one task, and what a round hands on is one row per group and rank. Bins run from the least to the largest value
seen, so every round splits its range. Rounds follow the spread of the values and not the number of rows: two or three for
most, more where values differ by many orders of magnitude."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.session import settle

BINS = 4096


def at_ranks(df: DataFrame, keys: list[str], value: Column, ranks: dict[str, Column]) -> DataFrame:
    """Per key n, how many values it has (NULLs left out), and per name the value at an index of the sorted values,
    from 0: an expression of `n`. Values are finite numbers; keys may be NULL."""
    named = [F.struct(F.lit(name).alias("name"), at.cast("long").alias("at")) for name, at in ranks.items()]
    rows = settle(df.select(*keys, value.cast("double").alias("_v")).where("_v is not null"), "values")
    ends = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    sought = settle(ends.withColumn("_r", F.explode(F.array(*named))).select(*keys, "n", "_lo", "_hi", "_r.*"), "ranks")
    while not (left := sought.where("_lo < _hi")).isEmpty():
        counted = _narrowed(rows, left, keys)
        sought = settle(sought.where("_lo = _hi").unionByName(counted), "ranks")
    return sought.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("name") == name, F.col("_lo"))).alias(name) for name in ranks])


def _narrowed(rows: DataFrame, left: DataFrame, keys: list[str]) -> DataFrame:
    """Each rank with the bin it lies in as its range, and its index among that bin's values."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    inside = _with(rows, left, keys).where(v.between(lo, hi))
    # Halves, so that the width of no range overflows; a width too small for a number leaves two bins.
    width = hi / 2 - lo / 2
    bin_ = F.when(width > 0, F.least(F.floor((v / 2 - lo / 2) / F.when(width > 0, width) * BINS), F.lit(BINS - 1))).otherwise(
        F.when(v > lo, BINS - 1).otherwise(0))
    bins = inside.groupBy(*keys, "n", "name", "at", bin_.cast("int").alias("_bin")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    upto = F.sum("_c").over(W.partitionBy(*keys, "name").orderBy("_bin").rowsBetween(W.unboundedPreceding, 0))
    held = bins.withColumn("_upto", upto).where((F.col("_upto") > F.col("at")) & (F.col("_upto") - F.col("_c") <= F.col("at")))
    return held.select(*keys, "n", "_lo", "_hi", "name", (F.col("at") - (F.col("_upto") - F.col("_c"))).alias("at"))


def nearest_rank(df: DataFrame, keys: list[str], value: Column, fractions: dict[str, float]) -> DataFrame:
    """Per key and fraction f the value at index round(f * (n - 1)), halves to the even index."""
    return at_ranks(df, keys, value, {name: F.bround(F.lit(f) * (F.col("n") - 1), 0) for name, f in fractions.items()})


def upper_median(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Per key the value at index n div 2 of the sorted values."""
    return at_ranks(df, keys, value, {name: F.floor(F.col("n") / 2)}).drop("n")


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median: the mean of the two middle values."""
    if not keys:
        return exact_median(df.withColumn("_all", F.lit(0)), ["_all"], value, name).drop("_all")
    n = F.col("n")
    middle = at_ranks(df, keys, F.col(value), {"_a": F.floor((n + 1) / 2) - 1, "_b": F.floor(n / 2)})
    return middle.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(name), "n")


def _with(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join that takes NULL keys as equal."""
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(renamed, on).drop(*[f"_k_{k}" for k in keys])
