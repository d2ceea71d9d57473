"""Number expressions: percents, rounding, tokens, list prices, differences."""

from pyspark.sql import Column, functions as F

from meterloom.fixed_values import TURN_PRICES, WRITE_1H_RATIO, WRITE_5M_RATIO

def is_number(value: Column) -> Column:
    """Whether a VARIANT holds a JSON number (a bool or a numeric text is none): only numbers print like one."""
    return F.coalesce(F.to_json(value).rlike("^-?[0-9]"), F.lit(False))


def is_missing(value: Column) -> Column:
    """A VARIANT that is absent or JSON null."""
    return value.isNull() | F.is_variant_null(value)


def number(value: Column, to: str = "double") -> Column:
    """The VARIANT's number, or NULL when it holds anything else."""
    return F.when(is_number(value), F.try_variant_get(value, "$", "double").try_cast(to))


def whole_percent(pct: Column) -> Column:
    """Percent for display: halves go up, a missing one is 0."""
    return F.floor(F.coalesce(pct, F.lit(0.0)) + 0.5)


def half_even(value: Column) -> Column:
    return F.bround(value, 0).cast("long")


def tokens(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("long")


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("long"))


def list_price_usd(model: Column, inp: Column, out: Column, cache_read: Column, write_5m: Column, write_1h: Column,
                   prices=TURN_PRICES) -> Column:
    """List-price cost of one request; NULL for a model without a price."""
    def rate(i: int) -> Column:
        found = F.lit(None).cast("double")
        for name, row in prices.items():
            found = F.when(model == name, F.lit(float(row[i]))).otherwise(found)
        return found
    return priced_usd(rate(0), rate(1), rate(2), inp, out, cache_read, write_5m, write_1h)


def priced_usd(price_in: Column, price_out: Column, read_ratio: Column, inp: Column, out: Column, cache_read: Column,
               write_5m: Column, write_1h: Column) -> Column:
    return (inp * price_in + out * price_out + cache_read * price_in * read_ratio
            + write_5m * price_in * WRITE_5M_RATIO + write_1h * price_in * WRITE_1H_RATIO) / 1e6


def difference(ours: Column, ref: Column) -> dict[str, Column]:
    """How far `ours` is from a reference value: equal or not, absolute, and relative where the reference is not 0."""
    return {"is_equal": ours.eqNullSafe(ref), "abs_diff": ours - ref,
            "rel_diff": F.when(ref != 0, (ours - ref) / ref)}
