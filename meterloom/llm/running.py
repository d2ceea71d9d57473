"""Running sums over an order of any length, without a window over a whole key."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.session import settle


def running(df: DataFrame, order: list[Column], total: str, by: list[str] = [], name: str = "dealt") -> DataFrame:
    """Adds `<total>_before`: the sum of `total` over the rows before this one in `order`, among rows with equal `by`
    (which must not be null). Rows are dealt out by range of by and order and written, so that a range keeps its number
    whatever is lost; sums run inside a range, and the ranges' own sums run over the ranges. Rows that tie in `order`
    get an arbitrary order among themselves."""
    dealt = settle(df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_range", F.spark_partition_id()), name)
    inside = W.partitionBy(*by, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranges = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    base = dealt.groupBy(*by, "_range").agg(F.sum(total).alias("_sum")).select(
        *by, "_range", F.coalesce(F.sum("_sum").over(ranges), F.lit(0)).alias("_base"))
    return (dealt.withColumn("_own", F.coalesce(F.sum(total).over(inside), F.lit(0))).join(base, [*by, "_range"])
            .withColumn(f"{total}_before", F.col("_own") + F.col("_base")).drop("_own", "_base", "_range"))
