"""Exact rounding: two-place results come from integers, so ties never depend on the engine."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
LARGEST_UNITS = 9e18


def half_up_div(numerator: Column, denominator: Column) -> Column:
    """Integer quotient rounded half away from zero; the denominator must be positive."""
    twice = F.abs(numerator) * F.lit(2) + denominator
    return F.sign(numerator).cast("bigint") * F.call_function("div", twice, denominator * F.lit(2))


def to_units(value: Column, digits: int) -> Column:
    """A double as a whole number of 10**-digits units; null if not finite or too large."""
    scale = float(10**digits)
    return F.when(F.abs(value) < F.lit(LARGEST_UNITS / scale), F.rint(value * F.lit(scale)).cast("bigint"))


def from_hundredths(hundredths: Column) -> Column:
    return hundredths.cast("double") / F.lit(100.0)


def hour_hundredths(start: Column, end: Column) -> Column:
    """Hours from start to end in hundredths, rounded half away from zero."""
    return half_up_div((F.unix_micros(end) - F.unix_micros(start)) * F.lit(100), F.lit(MICROS_PER_HOUR))


def mean_2dp(value: Column, unit_digits: int = 6) -> Column:
    """Aggregate: mean to two places, summed exactly. Non-finite input gives the plain mean."""
    units = to_units(value, unit_digits)
    # A bigint sum could overflow on a hot group, so the buffer is a decimal(30,0).
    total = F.sum(units.cast("decimal(20,0)"))
    return _mean(F.count(value), F.count(units), total, F.avg(value), unit_digits)


def _mean(seen: Column, exact: Column, total: Column, plain: Column, unit_digits: int) -> Column:
    hundredths = half_up_div(total, seen * F.lit(10 ** (unit_digits - 2)))
    return F.when(seen == 0, F.lit(None).cast("double")).when(exact == seen, from_hundredths(hundredths)).otherwise(plain)


def mean_parts(value: Column, name: str, unit_digits: int = 6) -> list[Column]:
    """Aggregates from which `mean_of_parts` makes the mean of `mean_2dp`; those of several parts are added up."""
    units = to_units(value, unit_digits)
    return [
        F.count(value).alias(f"{name}_seen"),
        F.count(units).alias(f"{name}_exact"),
        F.coalesce(F.sum(units.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"{name}_units"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias(f"{name}_plain"),
    ]


def mean_of_parts(name: str, unit_digits: int = 6) -> Column:
    """Aggregate: the mean of all parts."""
    seen, exact, units, plain = (F.sum(f"{name}_{part}") for part in ("seen", "exact", "units", "plain"))
    return _mean(seen, exact, units, F.try_divide(plain, seen), unit_digits)


def percent_2dp(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; null when whole is 0."""
    return F.when(whole > 0, from_hundredths(half_up_div(part * F.lit(10_000), whole)))


def mean_of_hundredths(value: Column) -> Column:
    """Aggregate: unrounded mean of a column of two decimal places, summed exactly."""
    total = F.sum(to_units(value, 2).cast("decimal(20,0)"))
    return total.cast("double") / (F.count(value) * F.lit(100)).cast("double")
