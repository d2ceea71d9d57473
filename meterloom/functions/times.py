"""Time expressions: epochs, ISO text, slots, snapped resets, plan periods."""

from pyspark.sql import Column, functions as F

from meterloom.fixed_values import GRID_S, SLOT_S


def epoch_seconds(value: Column) -> Column:
    """Epoch from an integer, a numeric text or ISO 8601 with fraction and zone; NULL, '' and anything else are NULL."""
    text = value.cast("string")
    return (F.when(text.rlike(r"^-?\d{1,18}$"), text.try_cast("long"))
            .when(text.rlike(r"^-?\d+\.\d+$"), text.try_cast("double").try_cast("long"))
            .when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.unix_seconds(F.try_to_timestamp(text))))


def zoned_epoch(value: Column) -> Column:
    """Epoch of an ISO text that says UTC ('Z' or '+00:00'); any other zone is no date at all."""
    return F.when(value.endswith("Z") | value.endswith("+00:00"), epoch_seconds(value))


def event_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp with or without zone (the session zone is UTC)."""
    return F.unix_seconds(ts.cast("timestamp"))


def iso(ts: Column) -> Column:
    return F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def minute_label(ts: Column) -> Column:
    return F.coalesce(F.date_format(F.timestamp_seconds(ts), "MM-dd HH:mm"), F.lit("-"))


def month_of(iso_text: Column) -> Column:
    return F.substring(iso_text, 1, 7)


def slot_start(ts: Column, size: int = SLOT_S) -> Column:
    return ts - F.pmod(ts, F.lit(size))


def slot_middle(ts: Column) -> Column:
    return ts + SLOT_S // 2


def snap(reset: Column, grid: int = GRID_S) -> Column:
    """Nearest multiple of the grid, halves to the even multiple, in whole numbers (no double rounding)."""
    rest = F.pmod(reset, F.lit(grid))
    low = ((reset - rest) / grid).cast("long")
    up = (F.when(rest * 2 > grid, F.lit(1)).when(rest * 2 == grid, F.pmod(low, F.lit(2))).otherwise(F.lit(0)))
    return (low + up) * grid


def plan_at(ts: Column, plans) -> Column:
    """Name of the plan running at ts: the last period that started at or before it."""
    found = F.lit(None).cast("string")
    for start, name in plans:
        found = F.when(ts >= start, F.lit(name)).otherwise(found)
    return found


def plan_start(plan: Column, plans) -> Column:
    return _by_plan(plan, {name: start for start, name in plans})


def plan_end(plan: Column, plans) -> Column:
    """First second after the plan's period; NULL for the running one."""
    return _by_plan(plan, {a[1]: b[0] for a, b in zip(plans, plans[1:])})


def _by_plan(plan: Column, values: dict) -> Column:
    found = F.lit(None).cast("long")
    for name, value in values.items():
        found = F.when(plan == name, F.lit(value).cast("long")).otherwise(found)
    return found


def shift_if(ts: Column, late: Column, seconds: int = 3600) -> Column:
    """Historic correction: rows for which `late` holds were dated `seconds` too late."""
    return F.when(late, ts - seconds).otherwise(ts)


def in_summer_time(ts: Column, zone: str) -> Column:
    """Whether the zone's offset at ts is larger than in mid-winter of that year."""
    def offset(moment: Column) -> Column:
        return F.unix_seconds(F.from_utc_timestamp(moment, zone)) - F.unix_seconds(moment)
    moment = F.timestamp_seconds(ts)
    return offset(moment) > offset(F.date_trunc("year", moment))
