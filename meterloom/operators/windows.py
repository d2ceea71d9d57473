"""Meter windows rebuilt from readings, and what lies between them."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.fixed_values import ACROSS_READINGS, ACROSS_S, GRID_NOISE_S, POLL_SOURCE, SPAN_S
from meterloom.functions.numbers import half_even
from meterloom.functions.times import plan_at, plan_end, plan_start, snap
from meterloom.operators.chunks import DAY, asof, balanced_chunks, counts_between, running
from meterloom.session import settle

_MONTH = 30 * DAY


def readings(account_quotas: DataFrame, plans) -> DataFrame:
    """Every reading with its plan and its reset times on the grid. The order is (ts, ingest_id); readers that need it
    sort, so the scan itself stays a projection."""
    return account_quotas.select(
        "ingest_id", "ts", "source", "machine", plan_at(F.col("ts"), plans).alias("plan"),
        F.col("five_hour_pct").alias("pct_5h"), F.col("seven_day_pct").alias("pct_7d"),
        snap(F.col("five_hour_resets_ts")).alias("end_5h"), snap(F.col("seven_day_resets_ts")).alias("end_7d"))


def first_seen(read: DataFrame, kind: str) -> DataFrame:
    """Per window and percent the first second it was read: all that windows and steps need to know of the readings.
    Meters count in whole percents, so a window keeps about a hundred rows however many readings it has, folded before
    the shuffle. Written once, since every analysis reads it several times."""
    usable = read.where(F.col(f"pct_{kind}").isNotNull() & F.col(f"end_{kind}").isNotNull())
    return settle(usable.groupBy("plan", F.col(f"end_{kind}").alias("reset"), F.col(f"pct_{kind}").alias("pct"))
                  .agg(F.min("ts").alias("ts")), f"first-seen-{kind}")


def _cut(kind: str, plans) -> list[Column]:
    begin = F.col("reset") - SPAN_S[kind]
    start = F.greatest(begin, plan_start(F.col("plan"), plans))
    end = F.least(F.col("reset"), plan_end(F.col("plan"), plans))
    return [start.alias("start"), end.alias("end"), ((start != begin) | (end != F.col("reset"))).alias("cut")]


def steps(seen: DataFrame, kind: str, plans) -> DataFrame:
    """The first reading of each new highest percent of a window, with the window's bounds and peak."""
    over = W.partitionBy("plan", "reset")
    earlier = over.orderBy("ts", "pct").rowsBetween(W.unboundedPreceding, -1)
    kept = (seen.withColumn("_top", F.max("pct").over(earlier)).withColumn("peak", F.max("pct").over(over))
            .where(F.col("pct") > F.coalesce("_top", F.lit(-1.0))))
    return kept.select("plan", "reset", *_cut(kind, plans), "peak", "ts", "pct")


def windows(seen: DataFrame, kind: str, plans) -> DataFrame:
    """One row per plan and reset: start, end (cut to the plan's period), cut flag and peak."""
    return (seen.groupBy("plan", "reset").agg(F.greatest(F.max("pct"), F.lit(-1.0)).alias("peak"))
            .select("plan", "reset", *_cut(kind, plans), "peak"))


def first_activity(df: DataFrame, at: str, active: DataFrame, out: str = "first_active", balanced: bool = False) -> DataFrame:
    """Adds the first active slot start at or after `at`. `balanced`: where df may hold many rows of one month."""
    hit = asof(df, active.withColumnRenamed("ts", "_slot"), at, "_slot", ["_slot"], "_hit", forward=True, balanced=balanced)
    return hit.withColumn(out, F.col("_hit._slot")).drop("_hit")


def _with_previous(win: DataFrame, *columns: str) -> DataFrame:
    """Each window with the one before it in (end, start) order."""
    order = [F.col("end"), F.col("start"), F.col("plan")]
    before = F.struct(*columns)
    return running(win, [], order, {"prev": ("previous", before)}, F.floor(F.col("end") / _MONTH))


def gaps(read: DataFrame, seen: DataFrame, active: DataFrame, kind: str = "5h", *, plans) -> DataFrame:
    """Consecutive windows of one plan: the gap between them, the readings, the 'no window' answers and the active
    slots inside it, and the minutes from the next start to the first activity after the previous end."""
    pairs = settle(_with_previous(windows(seen, kind, plans), "plan", "end").where(F.col("prev.plan") == F.col("plan"))
                   .select("plan", F.col("reset"), F.col("prev.end").alias("prev_end"), F.col("start"),
                           (F.col("start") - F.col("prev.end")).alias("gap")), "window-pairs")
    none = read.where((F.col("source") == POLL_SOURCE) & F.col(f"end_{kind}").isNull())
    low, high = F.col("prev_end"), F.col("start")
    counted = settle(counts_between(pairs, ["plan", "reset"], {
        "readings": (read, "ts", low, high), "nulls": (none, "ts", low, high),
        "active": (active, "ts", low, high - 299)}), "gap-counts")
    first = first_activity(counted, "prev_end", active)
    return first.withColumn("lag_min", half_even((F.col("first_active") - F.col("start")) / 60)).drop("first_active")


def gap_summary(gap: DataFrame) -> DataFrame:
    """Back to back, within the grid's noise, idle, overlapping; and about the idle ones their length in hours and how
    many hold a 'no window' answer or no reading at all. One row per gap is few, so the median is the built-in one."""
    g = F.col("gap")
    idle = g > GRID_NOISE_S
    hours = F.when(idle, g / 3600)
    return gap.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.abs(g) < 60).alias("back_to_back"),
        F.count_if((g >= 60) & (g <= GRID_NOISE_S)).alias("within_20_min"), F.count_if(idle).alias("idle"),
        F.count_if(g < -GRID_NOISE_S).alias("overlaps"), F.median(hours).alias("median_idle_h"),
        F.max(hours).alias("max_idle_h"), F.count_if(idle & (F.col("nulls") > 0)).alias("idle_with_null"),
        F.count_if(idle & (F.col("readings") == 0)).alias("idle_without_reading"))


def gap_anomalies(gap: DataFrame) -> DataFrame:
    """Activity inside a gap (a window the readings missed), and windows opened with no activity seen in time."""
    odd = F.col("lag_min").isNotNull() & ~F.col("lag_min").between(-10, 15)
    return gap.withColumn("anomaly", F.when(F.col("active") > 0, F.lit("activity inside the gap"))
                          .when(odd, F.lit("opened with no activity seen"))).where(F.col("anomaly").isNotNull())


def outside_windows(win: DataFrame, active: DataFrame) -> DataFrame:
    """Active slots since the first window, and those outside every window: the last window that started before the
    slot ended had itself ended before the slot began."""
    first = win.select(F.min("start")).scalar()
    after = active.where(F.col("ts") >= first).withColumn("_until", F.col("ts") + 299)
    last = asof(after, win, "_until", "start", ["end"], "_win", tie=[F.col("end")])
    return last.agg(F.count(F.lit(1)).alias("active_slots"),
                    F.count_if(F.col("ts") >= F.col("_win.end")).alias("outside"))


def coverage(win: DataFrame) -> DataFrame:
    covered = F.sum(F.col("end") - F.col("start"))
    total = F.max("end") - F.min("start")
    return win.agg(F.count(F.lit(1)).alias("windows"), covered.alias("covered_s"), total.alias("elapsed_s"),
                   F.when(total != 0, covered / total).alias("share"))


def ledger(seen: DataFrame, active: DataFrame, kind: str = "7d", *, plans) -> DataFrame:
    """Windows in order: days since the previous end, weekday of the end, first activity after the previous end and the
    end a window opened then would have."""
    win = _with_previous(windows(seen, kind, plans), "end").withColumn("prev_end", F.col("prev.end")).drop("prev")
    first = first_activity(win, "prev_end", active)
    first = first.withColumn("first_active", F.when(F.col("prev_end").isNotNull(), F.col("first_active")))
    return first.select("plan", "start", "end", F.date_format(F.timestamp_seconds("end"), "EEE").alias("weekday"),
                        ((F.col("end") - F.col("prev_end")) / DAY).alias("step_days"), "peak", "first_active",
                        (F.col("first_active") + SPAN_S[kind]).alias("end_if_opened_then"))


def no_window_runs(read: DataFrame, active: DataFrame | None = None, kind: str = "7d") -> DataFrame:
    """Runs of server readings without a reset time, in reading order. A run's number is how many readings with one
    came before it; it ends at the next of those, or, still open, at its own start. A run of one is a server blip."""
    polled = read.where(F.col("source") == POLL_SOURCE).select("ts", "ingest_id", F.col(f"end_{kind}").alias("reset"))
    order = [F.col("ts"), F.col("ingest_id")]
    cut = balanced_chunks(polled, order)
    known = F.col("reset").isNotNull()
    numbered = running(cut, [], order, {"run": ("sum_through", known.cast("long"))}, F.col("_chunk"))
    per = numbered.groupBy("run").agg(F.min(F.when(~known, F.col("ts"))).alias("first"),
                                      F.count_if(~known).alias("readings"), F.min(F.when(known, F.col("ts"))).alias("_at"))
    # Run k + 1 starts with the reading that ended run k, so only neighbouring numbers meet.
    starts = per.select((F.col("run") - 1).alias("run"), F.col("_at").alias("_next"))
    runs = per.where(F.col("readings") > 0).join(starts, "run", "left").select(
        "first", F.coalesce("_next", "first").alias("end"), "readings", (F.col("readings") < 2).alias("blip"))
    runs = settle(runs, "no-window-runs")
    return first_activity(runs, "first", active, balanced=True) if active is not None else runs


def across_resets(read: DataFrame, seen: DataFrame, plans) -> DataFrame:
    """Around each 7-day end that was reached: the last of the 20 server readings before it (within 40 minutes) that
    shows a used 5-hour window running across the end, and the first reading after it. Readings meet the ends on a
    shared time cell, once for both sides; the nearest twenty are picked by rank, which Spark limits before the shuffle."""
    polled = read.where(F.col("source") == POLL_SOURCE)
    newest = polled.select(F.max("ts")).scalar()
    ends = settle(windows(seen, "7d", plans).where((F.col("peak") > 0) & (F.col("end") <= newest) & ~F.col("cut")).select(
        "plan", "end").distinct(), "reached-ends")
    cells = ends.withColumn("_cell", F.explode(F.sequence(F.floor((F.col("end") - ACROSS_S) / ACROSS_S),
                                                          F.floor((F.col("end") + ACROSS_S) / ACROSS_S))))
    near = (polled.withColumn("_cell", F.floor(F.col("ts") / ACROSS_S)).drop("plan").join(cells, "_cell")
            .where(F.abs(F.col("ts") - F.col("end")) <= ACROSS_S))
    near = settle(near, "near-ends")
    before = near.where(F.col("ts") < F.col("end"))
    late = W.partitionBy("plan", "end").orderBy(F.desc("ts"), F.desc("ingest_id"))
    before = before.withColumn("_rank", F.row_number().over(late)).where(F.col("_rank") <= ACROSS_READINGS)
    runs_on = (F.col("end_5h") > F.col("end")) & (F.coalesce("pct_5h", F.lit(0.0)) != 0)
    shown = F.struct("ts", "pct_5h", "end_5h", "pct_7d")
    b = before.where(runs_on).groupBy("plan", "end").agg(F.min_by(shown, "_rank").alias("before"))
    a = near.where(F.col("ts") >= F.col("end")).groupBy("plan", "end").agg(
        F.min_by(shown, F.struct("ts", "ingest_id")).alias("after"))
    return b.join(a, ["plan", "end"])


def saturation(step: DataFrame) -> DataFrame:
    """Windows that reached 100 % and the time left in each when they did."""
    return (step.where(F.col("pct") >= 100).groupBy("plan", "reset").agg(F.min("ts").alias("ts"), F.max("end").alias("end"))
            .select("plan", "reset", "ts", (F.col("end") - F.col("ts")).alias("capped_s")))


def jumps(step: DataFrame, points: float, within: int) -> DataFrame:
    """Consecutive steps of a window that rise by `points` or more within so many seconds."""
    over = W.partitionBy("plan", "reset").orderBy("ts", "pct")
    return (step.withColumn("prev_ts", F.lag("ts").over(over)).withColumn("prev_pct", F.lag("pct").over(over))
            .where((F.col("pct") - F.col("prev_pct") >= points) & (F.col("ts") - F.col("prev_ts") <= within))
            .select("plan", "reset", "prev_ts", "prev_pct", "ts", "pct"))


def compression(read: DataFrame, seen: DataFrame, kind: str, plans) -> DataFrame:
    """How many readings the steps stand for."""
    usable = read.where(F.col(f"pct_{kind}").isNotNull() & F.col(f"end_{kind}").isNotNull()).select(
        F.count(F.lit(1)).alias("n")).scalar()
    return steps(seen, kind, plans).agg(usable.alias("readings"), F.count(F.lit(1)).alias("steps"))
