"""Windows, budgets and cost split on a month made here, whose answers follow from how it is made."""

import pytest
from pyspark.sql import functions as F

from meterloom import schemas
from meterloom.functions.text import kind_of_use, project
from meterloom.operators import budgets, split, windows
from meterloom.operators.slots import active_starts, countable_slots

H = 3_600
D = 1_600_000_200                       # on the grid of resets: Sunday 2020-09-13 12:30
PLANS = [(0, "old"), (D + 60_000, "new")]
WEEK_END = D + 504_000
# Two windows of five hours, two hours apart. In the first a percent costs 1/8 of a dollar.
FIRST, SECOND = (D, D + 5 * H), (D + 7 * H, D + 12 * H)
SPENT = [(D + 300, 1.0), (D + 2_400, 2.0), (D + 6_000, 2.0)]


def spent_before(second):
    return sum(usd for at, usd in SPENT if at + 150 < second)


def quota_rows():
    first = [(D + s, 8 * spent_before(D + s), FIRST[1] + j, week) for s, j, week in ((1_200, 1, 1), (4_000, -1, 3), (9_000, 0, 5))]
    stale = [(D + 9_100, 36.0, FIRST[1], 5)]
    between = [(D + 20_000, 0.0, None, 5)]
    second = [(SECOND[0] + 1_800, 6.0, SECOND[1], 6), (SECOND[0] + 4_800, 13.0, SECOND[1], 7)]
    later = [(D + 70_000, 2.0, D + 81_000, 9)]
    return [(i, ts, None, "claude_api", five, end, float(week), WEEK_END + (1 if i % 2 else 0), None, ts, "{}", str(i), "node-3")
            for i, (ts, five, end, week) in enumerate(first + stale + between + second + later)]


def slot_rows():
    def slot(at, folder, usd, entrypoint="cli", tokens=900, model="big"):
        return (at // 300 * 300, None, "node-3", folder, entrypoint, model, 1, 0, 0, tokens, 0, 0, 0, usd, 0 if usd is not None else tokens, at)
    return [*(slot(at, "/home/ann/dev/kite/src", usd) for at, usd in SPENT), slot(D + 6_000, "/Users/bo/opt/crane", 0.0, "sdk-go", 0),
            slot(SECOND[0] + 300, "/private/tmp/claude-77/-home-ann-dev-heron/t", 3.0), slot(D + 900, "/home/ann/dev/kite", None, model="<synthetic>")]


@pytest.fixture(scope="module")
def month(spark):
    class Month:
        read = windows.readings(spark.createDataFrame(quota_rows(), schemas.ACCOUNT_QUOTAS), PLANS)
        five, week = windows.first_seen(read, "5h"), windows.first_seen(read, "7d")
        slots = countable_slots(spark.createDataFrame(slot_rows(), schemas.SLOTS))
        line, active = budgets.timeline(slots), active_starts(slots)
    return Month


def test_windows_start_a_span_before_their_reset_and_end_with_the_plan(month, rows):
    assert rows(windows.windows(month.five, "5h", PLANS), "start", "end", "plan", "cut", "peak") == [
        (*FIRST, "old", False, 40.0), (*SECOND, "old", False, 13.0), (D + 63_000, D + 81_000, "new", False, 2.0)]
    assert rows(windows.windows(month.week, "7d", PLANS), "plan", "start", "end", "cut", "peak") == [
        ("new", D + 60_000, WEEK_END, True, 9.0), ("old", WEEK_END - 604_800, D + 60_000, True, 7.0)]


def test_a_stale_reading_is_no_step(month, rows):
    steps = windows.steps(month.five, "5h", PLANS)
    assert rows(steps.where(F.col("reset") == FIRST[1]), "ts", "pct") == [(D + 1_200, 8.0), (D + 4_000, 24.0), (D + 9_000, 40.0)]
    assert rows(windows.jumps(steps, 15, 4_000), "ts") == [(D + 4_000,)]


def test_what_lies_between_windows(month, rows):
    gap = windows.gaps(month.read, month.five, month.active, plans=PLANS)
    assert rows(gap, "prev_end", "start", "gap", "readings", "nulls", "active", "lag_min") == [(FIRST[1], SECOND[0], 2 * H, 1, 1, 0, 5)]
    assert rows(windows.gap_anomalies(gap)) == []
    spans = windows.windows(month.five, "5h", PLANS)
    assert rows(windows.coverage(spans), "windows", "covered_s", "elapsed_s") == [(3, 15 * H, 81_000)]
    assert windows.outside_windows(spans, month.active).first()[1] == 0


def test_the_ledger_names_the_weekday_of_the_reset(month, rows):
    got = windows.ledger(month.week, month.active, plans=PLANS)
    assert rows(got.where("plan = 'new'"), "end", "weekday") == [(WEEK_END, "Sat")]


def test_budgets_are_the_slope_through_the_origin(month):
    got = {r["start"]: r for r in budgets.budget_table(budgets.fits(month.five, month.line, "5h", PLANS)).collect()}
    one = got[FIRST[0]]
    assert (one["peak"], one["usd"], one["steps"]) == (40.0, 5.0, 3) and abs(one["b"] - 12.5) < 1e-9 and abs(one["r2"] - 1) < 1e-9
    assert got[SECOND[0]]["b"] is None and "fewer than 3" in got[SECOND[0]]["why"]


def test_windows_per_week_and_the_plans_summary(month, rows):
    ratio = budgets.windows_per_week(month.five, month.week, PLANS)
    assert rows(ratio, "gain_5h", "gain_7d", "ratio") == [(32.0, 4.0, 8.0)]
    fits = budgets.fits(month.five, month.line, "5h", PLANS)
    old = budgets.plan_summary(fits, budgets.fits(month.week, month.line, "7d", PLANS), ratio).where("plan = 'old'").first()
    assert (old["n_5h"], round(old["b_5h_p50"], 9), old["per_week_p50"], old["per_week_summed"], old["n_ratio"]) == (1, 12.5, 8.0, 8.0, 1)
    mix = budgets.one_percent_mix(fits, month.line).first()
    assert mix["plan"] == "old" and abs(mix["cache_read_tokens"] - 3 * 900 / 5 * 0.125) < 1e-9


def test_costs_by_project_kind_and_day(month, rows):
    periods = split.periods(month.five, "5h", plans=PLANS)
    by_project = split.placed_in_windows(month.slots, split.GROUPS["project"](), periods)
    assert rows(split.cost_split(by_project), "start", "g", "usd", "requests") == sorted(
        [(FIRST[0], "kite", 5.0, 3), (FIRST[0], "crane", 0.0, 1), (SECOND[0], "heron", 3.0, 1)], key=repr)
    assert rows(split.cost_split(by_project, top=1).where(F.col("start") == FIRST[0]), "position", "g", "usd") == [(1, "kite", 5.0), (2, "(1 others)", 0.0)]
    kinds = split.placed_in_windows(month.slots, split.GROUPS["kind"](), periods)
    assert (FIRST[0], "scheduled run", 1) in rows(split.cost_split(kinds), "start", "g", "requests")
    day = split.period_totals(split.placed_in_days(month.slots, split.GROUPS["project"](), plans=PLANS)).where("level = 'period'")
    assert rows(day, "start", "plan", "usd") == [(D - D % 86_400, "old", 8.0)]
    assert rows(split.outside_periods(month.slots, periods)) == [(0,)]


FOLDERS = {"/Users/eve/opt/owl/a/b": "owl", "/home/eve/dev/wren": "wren", "/home/eve": "~", "/home/eve/notes/x": "~/notes/x", "/srv/data": "/srv/data", "": "?",
           "/private/tmp/claude-3/-Users-eve-opt-jay/q": "jay"}


def test_folders_and_kinds(spark, rows):
    df = spark.createDataFrame(list(FOLDERS.items()), "f string, want string")
    assert df.where(project(F.col("f")) != F.col("want")).count() == 0
    uses = [("/home/eve/opt/owl", "sdk-go", "scheduled run"), ("/home/eve/dev/wren", "sdk-go", "test run"), ("/home/eve/opt/owl", "cli", "development"),
            ("/x", None, "?"), (None, "sdk-py", "test run")]
    df = spark.createDataFrame(uses, "f string, e string, want string")
    assert rows(df.where(kind_of_use(F.col("f"), F.col("e")) != F.col("want"))) == []
