"""Deduplication and stateful row selection."""

from pyspark.sql import Column, DataFrame, functions as F

from meterloom.operators.chunks import balanced_chunks, id_chunk, running


def first_by(df: DataFrame, keys: list[str], by: Column, *more: Column) -> DataFrame:
    """The first row of each key. An aggregate, so copies of one key are folded before the shuffle."""
    return _pick(df, keys, F.min_by, by, more)


def last_by(df: DataFrame, keys: list[str], by: Column, *more: Column) -> DataFrame:
    """The last row of each key."""
    return _pick(df, keys, F.max_by, by, more)


def _pick(df, keys, pick, by, more):
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(by, *more) if more else by
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_copies(df: DataFrame, key: str = "row_hash", by: str = "ingest_id") -> DataFrame:
    """Each hash once: its earliest row."""
    return first_by(df, [key], F.col(by))


def mark_repeats(df: DataFrame, keys: list[str], values: list[Column], by: str = "ingest_id",
                 stored: DataFrame | None = None, copy: Column | None = None, out: str = "redundant") -> DataFrame:
    """Flags a row whose values equal, NULLs included, those of the last kept row before it with the same keys. A row
    equal to a repeat equals what that repeat repeats, so the row before stands for the last one kept; only a `copy` of
    a stored row, never kept, is passed over. `stored` (keys and a struct `last_values` per key) is what an earlier run
    kept last."""
    now = F.struct(*[v.alias(f"f{i}") for i, v in enumerate(values)])
    first = stored.select(*keys, F.col("last_values").alias("_before")) if stored is not None else None
    kept = now if copy is None else F.when(~copy, now)
    seen = running(df, keys, [F.col(by)], {"_before": ("known_before", kept)}, id_chunk(F.col(by)), first)
    same = F.col("_before").isNotNull()
    for i, v in enumerate(values):
        same = same & F.col(f"_before.f{i}").eqNullSafe(v)
    return seen.withColumn(out, same).drop("_before")


def largest_output(lines: DataFrame) -> DataFrame:
    """Transcript lines to requests: one row per request_id. Its usage comes from the line with the largest output
    (ties: the earliest line), its time from its first line, wherever the copies lie."""
    usage = [c for c in lines.columns if c not in ("request_id", "ts", "path", "block", "line")]
    best = F.min_by(F.struct(*usage), F.struct((-F.col("output_tokens")).alias("_less"), "ts", "path", "block", "line"))
    return (lines.groupBy("request_id").agg(F.min("ts").alias("ts"), best.alias("_u"))
            .select("ts", "request_id", *[F.col(f"_u.{c}").alias(c) for c in usage]))


def counter_deltas(df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column], last: dict[str, Column],
                   chunk: Column, watch: list[str] | None = None) -> DataFrame:
    """A cumulative counter to the increase of each event. A repeated total is no event; when one of the `watch`ed
    totals (default all) is below the one before, the counter was reset and the event's own usage (`last`) counts."""
    now = F.struct(*[v.alias(n) for n, v in totals.items()])
    seen = running(df, keys, order, {"_before": ("previous", now)}, chunk)
    moved = seen.where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(now))
    watch = watch or list(totals)
    delta = {n: F.coalesce(totals[n], F.lit(0)) - F.coalesce(F.col(f"_before.{n}"), F.lit(0)) for n in watch}
    lowest = F.least(*delta.values()) if len(delta) > 1 else delta[watch[0]]
    return moved.select(*df.columns, *[F.when(lowest < 0, F.coalesce(last[n], F.lit(0))).otherwise(d).alias(f"{n}_delta")
                                       for n, d in delta.items()])


def session_spend(snapshots: DataFrame) -> DataFrame:
    """Spend of each session between consecutive snapshots by observed time; a cost that fell was reset to zero."""
    order = [F.col("ts"), F.col("ingest_id")]
    known = balanced_chunks(snapshots.where(F.col("session_cost_usd").isNotNull()), [F.col("session_id"), *order])
    seen = running(known, ["session_id"], order, {"prev_cost": ("previous", F.col("session_cost_usd"))}, F.col("_chunk"))
    cost, prev = F.col("session_cost_usd"), F.coalesce(F.col("prev_cost"), F.lit(0.0))
    return seen.select(*snapshots.columns, "prev_cost",
                       F.when(cost < prev, cost).otherwise(cost - prev).alias("spent_usd"))
