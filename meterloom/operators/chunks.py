"""Ordered operators that split a hot key.

A window partitioned by a key alone puts all of that key's rows into one task. Here every key is cut into chunks of
consecutive rows; one partial aggregate per (key, chunk) says what the next chunks need to know from it, and goes into
them as a seed row in front of their own rows. So the largest window is one chunk, whatever the key's share of rows.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.session import settle

ID_CHUNK = 1_000_000
DAY = 86_400
_FIRST = -(1 << 62)


def id_chunk(unique_id: Column, size: int = ID_CHUNK) -> Column:
    """Chunks of a unique whole-number id: at most `size` rows each."""
    return F.floor(unique_id / size).cast("long")


def balanced_chunks(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """Adds `_chunk`, chunks of about equal size for an order no id gives: a range partitioning, then its partition
    number. `order` starts with the keys and ends with something unique, so a hot key or second is cut too. Written out,
    so that every later reader sees the same cut, also after a lost executor. The number of chunks is `parts`, or
    spark.sql.shuffle.partitions less what Spark merges because it is small."""
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return settle(ranged.withColumn("_chunk", F.spark_partition_id().cast("long")), "chunks")


def running(df: DataFrame, keys: list[str], order: list[Column], specs: dict[str, tuple[str, Column]], chunk: Column,
            initial: DataFrame | None = None) -> DataFrame:
    """Adds one column per spec, computed over the rows of the same keys in `order`:

      previous      the value of the row before (NULL included)
      last_known    the last value that is not NULL, this row's included
      known_before  the last value that is not NULL of the rows before
      max_before    the largest value of the rows before
      sum_through   the sum up to and including this row
      sum_before    the sum of the rows before

    `chunk` must rise with `order` inside a key. `initial` (keys and spec columns) stands before every row of its key.
    """
    work = df.withColumn("_chunk", chunk.cast("long")).withColumn("_o", F.struct(*order))
    partial, carry = [], {}
    for i, (name, (how, value)) in enumerate(specs.items()):
        v = f"_v{i}"
        work = work.withColumn(v, F.struct(value.alias("v")) if how == "previous" else value)
        c = F.col(v)
        if how == "previous":
            partial.append(F.max_by(c, F.col("_o")).alias(v))
        elif how in ("last_known", "known_before"):
            partial.append(F.max_by(c, F.when(c.isNotNull(), F.col("_o"))).alias(v))
        elif how == "max_before":
            partial.append(F.max(c).alias(v))
        else:
            partial.append(F.sum(c).alias(v))
        carry[v] = how
    summary = work.groupBy(*keys, "_chunk").agg(*partial)
    if initial is not None:
        first = [(F.struct(F.col(n).alias("v")) if how == "previous" else F.col(n)).alias(f"_v{i}")
                 for i, (n, (how, _)) in enumerate(specs.items())]
        summary = summary.unionByName(initial.select(*keys, F.lit(_FIRST).alias("_chunk"), *first))
    over = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    earlier = over.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    seeds = []
    for v, how in carry.items():
        c = F.col(v)
        if how == "previous":
            seeds.append(F.lag(c).over(over.orderBy("_chunk")).alias(v))
        elif how in ("last_known", "known_before"):
            seeds.append(F.last(c, ignorenulls=True).over(earlier).alias(v))
        elif how == "max_before":
            seeds.append(F.max(c).over(earlier).alias(v))
        else:
            seeds.append(F.sum(c).over(earlier).alias(v))
    seeded = summary.select(*keys, "_chunk", *seeds).where(F.col("_chunk") > _FIRST).withColumn("_row", F.lit(0))
    both = work.withColumn("_row", F.lit(1)).unionByName(seeded, allowMissingColumns=True)
    inside = W.partitionBy(*keys, "_chunk").orderBy("_row", "_o")
    before, through = inside.rowsBetween(W.unboundedPreceding, -1), inside.rowsBetween(W.unboundedPreceding, 0)
    for i, (name, (how, _)) in enumerate(specs.items()):
        c = F.col(f"_v{i}")
        if how == "previous":
            result = F.lag(c).over(inside)
        elif how in ("last_known", "known_before"):
            result = F.last(c, ignorenulls=True).over(through if how == "last_known" else before)
        elif how == "max_before":
            result = F.max(c).over(before)
        else:
            result = F.sum(c).over(through if how == "sum_through" else before)
        both = both.withColumn(f"_r{i}", result)
    out = [F.col(c) for c in df.columns if c not in specs]
    for i, (name, (how, _)) in enumerate(specs.items()):
        out.append((F.col(f"_r{i}.v") if how == "previous" else F.col(f"_r{i}")).alias(name))
    return both.where(F.col("_row") == 1).select(*out)


def asof(left: DataFrame, right: DataFrame, at: str, right_at: str, payload: list[str], out: str, keys: list[str] = (),
         forward: bool = False, equal: bool = True, tie: list[Column] = (), span: int = 30 * DAY,
         balanced: bool = False) -> DataFrame:
    """As-of join: to each left row the nearest right row at or before it (`forward`: at or after it), as struct `out`
    (NULL when there is none). Without `equal`, strictly before (after). One union and one ordered pass, no range join;
    `tie` orders right rows of one time, the last wins (default: the largest payload). A chunk is `span` seconds; sides whose rows per second have no
    bound ask for `balanced` chunks."""
    sign = -1 if forward else 1
    keys = list(keys)
    l = left.withColumn("_t", F.col(at).cast("long") * sign).withColumn("_side", F.lit(1))
    # Of right rows at one time only the last can be anyone's answer: one row per key and second is left.
    hit = F.struct(*payload)
    r = (right.groupBy(*keys, (F.col(right_at).cast("long") * sign).alias("_t"))
         .agg((F.max_by(hit, F.struct(*tie, *payload)) if tie else F.max(hit)).alias("_hit"))
         .withColumn("_side", F.lit(0 if equal else 2)))
    both = l.unionByName(r, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_side")]
    if balanced:
        both = balanced_chunks(both, [*[F.col(k) for k in keys], *order, F.xxhash64(*[F.col(c) for c in left.columns])])
        chunk = F.col("_chunk")
    else:
        chunk = F.floor(F.col("_t") / span)
    joined = running(both, keys, order, {out: ("last_known", F.col("_hit"))}, chunk)
    return joined.where(F.col("_side") == 1).select(*left.columns, out)


def counts_between(bounds: DataFrame, ids: list[str], sets: dict[str, tuple[DataFrame, str, Column, Column]],
                   span: int = 30 * DAY) -> DataFrame:
    """For each row of `bounds` and each named set (points, time column, low, high): how many points have
    low <= time < high, never less than 0. Points are first counted per second; then one ordered pass over the counts
    and the bounds of all sets gives running totals, and a count is the difference of two of them."""
    parts = []
    for name, (points, at, low, high) in sets.items():
        parts.append(points.groupBy(F.col(at).cast("long").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
                     .select(F.lit(name).alias("_set"), "_t", F.lit(1).alias("_side"), "_n"))
        for sign, bound in ((-1, low), (1, high)):
            parts.append(bounds.select(*ids, F.lit(name).alias("_set"), bound.cast("long").alias("_t"),
                                       F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_n"),
                                       F.lit(sign).alias("_sign")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    total = running(both, ["_set"], [F.col("_t"), F.col("_side")], {"_c": ("sum_through", F.col("_n"))},
                    F.floor(F.col("_t") / span))
    counted = total.where(F.col("_side") == 0).groupBy(*ids).agg(*[
        F.greatest(F.coalesce(F.sum(F.when(F.col("_set") == name, F.col("_sign") * F.coalesce("_c", F.lit(0)))), F.lit(0)),
                   F.lit(0)).cast("long").alias(name) for name in sets])
    return bounds.join(counted, ids, "left")
