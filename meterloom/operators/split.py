"""Where the cost of a period goes: by project, kind of use, machine or model."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.fixed_values import TOKEN_COLUMNS
from meterloom.functions.text import kind_of_use, project
from meterloom.functions.times import plan_at, slot_middle, slot_start
from meterloom.operators.chunks import DAY, asof
from meterloom.operators.windows import windows
from meterloom.session import settle

GROUPS = {
    "project": lambda: project(F.col("folder")),
    "kind": lambda: kind_of_use(F.col("folder"), F.col("entrypoint")),
    "machine": lambda: F.col("machine"),
    "model": lambda: F.col("model"),
}
MEASURES = ["usd", "tokens", "unpriced", "requests"]


def _grouped(slots: DataFrame, group: Column) -> DataFrame:
    """Spend per slot start and group, folded before anything else is asked of it."""
    every = sum((F.col(c) for c in TOKEN_COLUMNS[1:]), F.col(TOKEN_COLUMNS[0]))
    return slots.groupBy("ts", group.alias("g")).agg(
        F.coalesce(F.sum("usd"), F.lit(0.0)).alias("usd"), F.sum(every).alias("tokens"),
        F.sum("tokens_without_usd").alias("unpriced"), F.sum("requests").alias("requests"),
        F.count(F.lit(1)).alias("slots"))


def periods(seen: DataFrame, span: str, since: int = 0, *, plans) -> DataFrame:
    """The 5-hour or 7-day windows that end after `since`."""
    return windows(seen, span, plans).where(F.col("end") > since)


def placed_in_windows(slots: DataFrame, group: Column, period: DataFrame) -> DataFrame:
    """Each slot start and group with the period it falls in: the next to end after the slot's middle, if it has begun
    by then; NULL otherwise."""
    ends = period.groupBy("end").agg(F.min(F.struct("start", "plan", "peak")).alias("_p")).select("end", "_p.*")
    spent = settle(_grouped(slots, group), "grouped-slots")
    times = spent.select("ts").distinct().withColumn("mid", slot_middle(F.col("ts")))
    hit = asof(times, ends, "mid", "end", ["start", "end", "plan", "peak"], "_p", forward=True, equal=False)
    inside = hit.withColumn("_p", F.when(F.col("_p.start") <= F.col("mid"), F.col("_p"))).select("ts", "mid", "_p.*")
    return spent.join(inside, "ts")


def placed_in_days(slots: DataFrame, group: Column, since: int = 0, *, plans) -> DataFrame:
    """Each slot start and group with its UTC day. A slot before `since` belongs to no day shown; one whose middle is in
    a day belongs to it (slots do not cross midnight)."""
    day = slot_start(F.col("ts"), DAY)
    return (_grouped(slots.where(F.col("ts") >= since), group).withColumn("mid", slot_middle(F.col("ts")))
            .withColumn("start", day).withColumn("end", day + DAY).withColumn("plan", plan_at(day, plans))
            .withColumn("peak", F.lit(None).cast("double")))


def cost_split(placed: DataFrame, top: int = 8) -> DataFrame:
    """Per period its groups, largest cost first: the `top` ones, then the others added up. Ranking keeps only the top
    rows of each task before the shuffle; the others never need to be ordered."""
    keys = ["plan", "start", "end", "peak"]
    per = settle(placed.where(F.col("start").isNotNull()).groupBy(*keys, "g").agg(*[F.sum(c).alias(c) for c in MEASURES]), "per-group")
    rank = W.partitionBy("start", "end").orderBy(F.desc("usd"), F.desc("tokens"), F.col("g"))
    best = (per.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= top)
            .select("start", "end", "g", "_rank"))
    named = per.join(best, ["start", "end", "g"], "left")
    kept = (named.groupBy(*keys, F.coalesce("_rank", F.lit(top + 1)).alias("position"),
                          F.when(F.col("_rank").isNotNull(), F.col("g")).alias("g"))
            .agg(*[F.sum(c).alias(c) for c in MEASURES], F.count(F.lit(1)).alias("_groups")))
    whole = kept.withColumn("_total", F.sum("usd").over(W.partitionBy("start", "end")))
    return whole.select(*keys, "position",
                        F.coalesce("g", F.concat(F.lit("("), F.col("_groups").cast("string"), F.lit(" others)"))).alias("g"),
                        *MEASURES, F.when(F.col("_total") != 0, F.col("usd") / F.col("_total")).alias("share"))


def period_totals(placed: DataFrame) -> DataFrame:
    """Per period, per group over all periods, and overall, in one pass: which is told by `level`."""
    inside = placed.where(F.col("start").isNotNull())
    sets = (inside.groupingSets([[F.col("start"), F.col("end"), F.col("plan")], [F.col("g")], []],
                                F.col("start"), F.col("end"), F.col("plan"), F.col("g"))
            .agg(*[F.sum(c).alias(c) for c in MEASURES], F.grouping("start").alias("_s"), F.grouping("g").alias("_g")))
    level = (F.when(F.col("_s") == 0, F.lit("period")).when(F.col("_g") == 0, F.lit("group")).otherwise(F.lit("all")))
    return sets.select(level.alias("level"), "start", "end", "plan", "g", *MEASURES)


def group_totals(placed: DataFrame) -> DataFrame:
    """Every group over all periods, with its share of the whole."""
    per = placed.where(F.col("start").isNotNull()).groupBy("g").agg(*[F.sum(c).alias(c) for c in MEASURES])
    whole = per.select(F.sum("usd")).scalar()
    return per.withColumn("share", F.when(whole != 0, F.col("usd") / whole))


def outside_periods(slots: DataFrame, period: DataFrame) -> DataFrame:
    """How many slot rows fall in no period, counted from the first period's start on."""
    first = period.orderBy("end", "start").limit(1).select("start").scalar()
    placed = placed_in_windows(slots, F.lit("all"), period)
    return placed.where(F.col("start").isNull() & (F.col("mid") >= first)).agg(
        F.coalesce(F.sum("slots"), F.lit(0)).cast("long").alias("slots_outside"))
