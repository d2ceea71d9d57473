"""What a window's percent is worth: spend against percent, per window and per plan."""

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from meterloom.fixed_values import MAX_UNPRICED, MIN_PCT, MIN_PEAK, SPAN_S, TOKEN_COLUMNS
from meterloom.functions.times import slot_middle
from meterloom.operators.chunks import DAY, asof
from meterloom.operators.quantiles import nearest_rank, upper_median
from meterloom.operators.windows import steps, windows
from meterloom.session import settle

SPENT = ["usd", "unpriced", "requests", *TOKEN_COLUMNS, "tokens"]


def timeline(slots: DataFrame, *groups: str) -> DataFrame:
    """Spend per slot start (and group): what range joins read, so that they see five-minute totals, not slots."""
    every = sum((F.col(c) for c in TOKEN_COLUMNS[1:]), F.col(TOKEN_COLUMNS[0]))
    line = (slots.groupBy("ts", *groups).agg(
        F.coalesce(F.sum("usd"), F.lit(0.0)).alias("usd"), F.sum("tokens_without_usd").alias("unpriced"),
        F.sum("requests").alias("requests"), *[F.sum(c).alias(c) for c in TOKEN_COLUMNS], F.sum(every).alias("tokens"))
        .withColumn("mid", slot_middle(F.col("ts"))))
    return settle(line, "timeline")


def inside(win: DataFrame, line: DataFrame, span: int) -> DataFrame:
    """Windows with the timeline rows whose middle is in [start, end). No window is longer than `span`, so each meets
    at most two cells of that length, and the join is an equality on the cell."""
    cells = win.where(F.col("end") > F.col("start")).withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("start") / span), F.floor((F.col("end") - 1) / span))))
    return (cells.join(line.withColumn("_cell", F.floor(F.col("mid") / span)).withColumnRenamed("ts", "slot_ts"), "_cell")
            .where((F.col("mid") >= F.col("start")) & (F.col("mid") < F.col("end"))).drop("_cell"))


def spent_in_windows(win: DataFrame, line: DataFrame, kind: str) -> DataFrame:
    """Windows with what was spent in them (0 where nothing was)."""
    keys = ["plan", "reset"]
    total = inside(win.select(*keys, "start", "end"), line, SPAN_S[kind]).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SPENT])
    return win.join(total, keys, "left").fillna(0, SPENT)


def spent_at_steps(step: DataFrame, line: DataFrame, kind: str) -> DataFrame:
    """Each step with what its window had spent before it, as a running sum over the window's own five-minute totals."""
    keys = ["plan", "reset"]
    win = step.select(*keys, "start", "end").distinct()
    # A step can be dated after its window's end (a late copy): what was spent up to the step counts.
    last = step.groupBy(*keys).agg(F.max("ts").alias("_last"))
    reach = win.join(last, keys).withColumn("end", F.greatest("end", "_last")).where(F.col("end") > F.col("start"))
    span = SPAN_S[kind]
    cells = reach.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / span),
                                                           F.floor((F.col("end") - 1) / span))))
    usage = (cells.join(line.withColumn("_cell", F.floor(F.col("mid") / span)), "_cell")
             .where((F.col("mid") >= F.col("start")) & (F.col("mid") < F.col("end")))
             .select(*keys, F.col("mid").alias("_t"), F.lit(1).alias("_side"), *[F.col(c).alias(f"_{c}") for c in SPENT]))
    marks = step.withColumn("_t", F.col("ts")).withColumn("_side", F.lit(0))
    over = W.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, 0)
    both = marks.unionByName(usage, allowMissingColumns=True)
    for c in SPENT:
        both = both.withColumn(c, F.coalesce(F.sum(f"_{c}").over(over), F.lit(0)))
    return both.where(F.col("_side") == 0).select(*step.columns, *SPENT)


def fits(seen: DataFrame, line: DataFrame, kind: str, plans) -> DataFrame:
    """Per window the budget B (USD at 100 %) of a line through the origin, pct = 100 usd / B, over its steps of 5 % or
    more, and R²; or why there is none. The residuals' squares come from moments about the means, which Spark merges
    without cancellation: with s the slope, n (s mean(x) - mean(y))² + Syy - 2 s Sxy + s² Sxx."""
    at = spent_at_steps(steps(seen, kind, plans), line, kind)
    x, y = F.col("usd"), F.col("pct")
    used = y >= MIN_PCT
    keys = ["plan", "reset", "start", "end", "cut", "peak"]
    on = F.when(used, F.lit(1))
    sums = at.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("steps"), F.count(on).alias("_n"),
        F.coalesce(F.sum(on * x * y), F.lit(0.0)).alias("_xy"), F.coalesce(F.sum(on * x * x), F.lit(0.0)).alias("_xx"),
        F.avg(on * y).alias("_mean"), F.avg(on * x).alias("_mean_x"), F.var_pop(on * y).alias("_vy"), F.var_pop(on * x).alias("_vx"),
        F.covar_pop(on * x, on * y).alias("_cov"), F.count_if(used & (x != 0)).alias("_spent"),
        F.max_by("usd", F.struct("ts", "pct")).alias("usd"), F.max_by("tokens", F.struct("ts", "pct")).alias("tokens"),
        F.max_by("unpriced", F.struct("ts", "pct")).alias("_unpriced"),
        F.max_by("cache_read_tokens", F.struct("ts", "pct")).alias("_read"))
    share = lambda c: F.when(F.col("tokens") != 0, F.col(c) / F.col("tokens")).otherwise(F.lit(0.0))
    slope, n = F.col("_xy") / F.col("_xx"), F.col("_n")
    off = slope * F.col("_mean_x") - F.col("_mean")
    sst = n * F.col("_vy")
    sse = n * F.greatest(off * off + F.col("_vy") - 2 * slope * F.col("_cov") + slope * slope * F.col("_vx"), F.lit(0.0))
    why = (F.when(F.col("unpriced") > MAX_UNPRICED, F.concat(F.bround(F.col("unpriced") * 100, 0).cast("int").cast("string"),
                                                            F.lit("% of tokens without $")))
           .when((F.col("_n") < 3) | (F.col("_spent") == 0), F.lit("fewer than 3 readings at 5%+")))
    out = sums.withColumn("unpriced", share("_unpriced")).withColumn("cache_read", share("_read")).withColumn("why", why)
    fit = F.col("why").isNull() & (F.col("_xx") != 0) & (F.col("_xy") != 0)
    return settle(out.select(*keys, "steps", "usd", "tokens", "unpriced", "cache_read", "why",
                      F.when(fit, F.col("_xx") * 100 / F.col("_xy")).alias("b"),
                      F.when(fit & (sst != 0), F.lit(1.0) - sse / sst).alias("r2")), f"fits-{kind}")


def budget_table(fit: DataFrame) -> DataFrame:
    """The windows worth listing: used to 5 % or more, and with some cost reported."""
    return fit.where((F.col("peak") >= MIN_PCT) & ~((F.col("tokens") != 0) & (F.col("unpriced") == 1)))


def unpriced_windows(fit: DataFrame) -> DataFrame:
    """How many windows have no reported cost at all, and the span they cover."""
    return (fit.where((F.col("peak") >= MIN_PCT) & (F.col("tokens") != 0) & (F.col("unpriced") == 1))
            .agg(F.count(F.lit(1)).alias("windows"), F.min("start").alias("first_start"), F.max("end").alias("last_end")))


def percent_reached(points: DataFrame, at: str, seen: DataFrame, out: str, kind: str = "7d", *, plans) -> DataFrame:
    """Adds the percent the meter had reached at a time, in the window running then under the same plan: NULL where
    none ran, 0 before its first step. Windows of one plan end in the order they start, so the running one is the next
    to end, if it has begun."""
    win = windows(seen, kind, plans).groupBy("plan", "end").agg(F.min_by("start", F.struct("start", "reset")).alias("start"),
                                                          F.min_by("reset", F.struct("start", "reset")).alias("reset"))
    hit = asof(points, win, at, "end", ["start", "reset"], "_win", keys=["plan"], forward=True, equal=False, span=90 * DAY)
    ran = settle(hit.withColumn("_reset", F.when(F.col("_win.start") <= F.col(at), F.col("_win.reset"))).drop("_win"), "running")
    step = steps(seen, kind, plans).select("plan", F.col("reset").alias("_reset"), "ts", "pct")
    got = asof(ran, step, at, "ts", ["pct"], "_step", keys=["plan", "_reset"], tie=[F.col("pct")], span=90 * DAY)
    return (got.withColumn(out, F.when(F.col("_reset").isNotNull(), F.greatest(F.coalesce("_step.pct", F.lit(0.0)), F.lit(0.0))))
            .drop("_step", "_reset"))


def windows_per_week(seen_5h: DataFrame, seen_7d: DataFrame, plans) -> DataFrame:
    """Per 5-hour window the percent it gained and the 7-day percent gained meanwhile: their ratio says how many fill a
    week. Needs two steps, ten points gained, and a 7-day meter that moved."""
    first, last = F.struct("ts", "pct"), F.struct("ts", "pct")
    ends = steps(seen_5h, "5h", plans).groupBy("plan", "reset", "start", "end").agg(
        F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"), F.max(last).alias("_last")).where(F.col("_n") >= 2)
    gain = (F.col("_last.pct") - F.col("_first.pct")).alias("gain_5h")
    # Both times of a window in one pass: two rows each, told apart by their sign.
    times = ends.select("plan", "reset", "start", gain, F.explode(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("_first.ts").alias("at")), F.struct(F.lit(1).alias("sign"), F.col("_last.ts").alias("at")))).alias("_t"))
    flat = settle(times.select("plan", "reset", "start", "gain_5h", "_t.sign", "_t.at").where(F.col("gain_5h") >= 10), "gains")
    reached = percent_reached(flat, "at", seen_7d, "q", plans=plans).where(F.col("q").isNotNull())
    both = reached.groupBy("plan", "reset", "start", "gain_5h").agg(F.sum(F.col("sign") * F.col("q")).alias("gain_7d"), F.count(F.lit(1)).alias("_both"))
    got = (both.where((F.col("_both") == 2) & (F.col("gain_7d") > 0))
            .select("plan", "reset", "start", "gain_5h", "gain_7d", (F.col("gain_5h") / F.col("gain_7d")).alias("ratio")))
    return settle(got, "per-week")


def _high(fit: DataFrame) -> DataFrame:
    return fit.where(F.col("b").isNotNull() & (F.col("b") != 0) & (F.col("peak") >= MIN_PEAK))


def plan_summary(fit_5h: DataFrame, fit_7d: DataFrame, ratios: DataFrame) -> DataFrame:
    """Per plan: median, 10th and 90th percentile of both budgets and of the ratio, and the ratio of the summed gains."""
    told = {"b_5h": ("n_5h", _high(fit_5h).select("plan", F.col("b").alias("v"))), "b_7d": ("n_7d", _high(fit_7d).select("plan", F.col("b").alias("v"))),
            "per_week": ("n_ratio", ratios.select("plan", F.col("ratio").alias("v")))}
    every = reduce(DataFrame.unionByName, [rows.withColumn("what", F.lit(name)) for name, (_, rows) in told.items()])
    marks = settle(nearest_rank(every, ["what", "plan"], F.col("v"), {"p50": 0.5, "p10": 0.1, "p90": 0.9}), "marks")
    five, week, per = (marks.where(F.col("what") == name).select("plan", F.col("n").alias(n), *[F.col(p).alias(f"{name}_{p}") for p in ("p50", "p10", "p90")])
                       for name, (n, _) in told.items())
    gains = ratios.groupBy("plan").agg((F.sum("gain_5h") / F.sum("gain_7d")).alias("per_week_summed"))
    plans = (fit_5h.select("plan").unionByName(fit_7d.select("plan"))).distinct()
    out = plans
    for part in (five, week, per, gains):
        out = out.join(part, "plan", "left")
    return out.fillna(0, ["n_5h", "n_7d", "n_ratio"])


def one_percent_mix(fit_5h: DataFrame, line: DataFrame) -> DataFrame:
    """What one percent of a 5-hour window holds per plan, at the average mix: each token column per USD, times the
    upper-median budget of one percent."""
    high = _high(fit_5h)
    spent = spent_in_windows(high.select("plan", "reset", "start", "end"), line, "5h")
    mix = spent.groupBy("plan").agg(F.sum("usd").alias("_usd"), *[F.sum(c).alias(c) for c in TOKEN_COLUMNS])
    one = upper_median(high, ["plan"], F.col("b"), "_b")
    return mix.join(one, "plan").select("plan", *[
        F.when(F.col("_usd") != 0, F.col(c) / F.col("_usd") * F.col("_b") / 100).alias(c) for c in TOKEN_COLUMNS])
