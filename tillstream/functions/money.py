"""Sums of money that do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts below this are summed exactly, in whole ones and billionths.
EXACT_BELOW = float(1 << 42)
_BILLION = 1_000_000_000
_WHOLE_BITS, _FRACTION_BITS = 21, 15
# A double carries any 15 decimal digits. Billionths that are left of them, by size of the amount.
_DIGITS = 15
_STEPS = {10.0**n: 10.0 ** (n + 9 - _DIGITS) for n in range(_DIGITS - 8, 14)}


def is_finite(amount: Column) -> Column:
    """True of a number that is neither missing nor NaN nor infinite."""
    return F.coalesce(F.abs(amount) < float("inf"), F.lit(False))


def _billionths(value: Column, whole: Column) -> Column:
    """The fraction of an amount in billionths, as the decimal number that was meant.

    A double is near a decimal number, and its fraction has more digits than that number. Of a
    large amount only those billionths count that the digits reach.
    """
    size, fraction = F.abs(value), (value - whole) * _BILLION
    rounded = F.when(size < min(_STEPS) / 10, F.rint(fraction))
    for below, step in _STEPS.items():
        rounded = rounded.when(size < below, F.rint(fraction / step) * step)
    return rounded.cast("bigint")


def exact_total(amount: Column) -> Column:
    """Aggregate: the sum of ``amount`` as a struct ``exact DECIMAL(38,9), other DOUBLE``.

    Amounts are the decimal numbers of at most nine places and 15 digits that are nearest, so sums
    of cents are exact.

    A sum of doubles depends on the order in which partitions arrive, so a retried task can
    change it, and over many rows the error reaches whole cents. Sums of long integers are
    exact, and as fast. The whole part and the billionths of each amount are each split into
    high and low bits that are summed apart, so that no sum overflows before 2**42 rows.

    Amounts of 2**42 and more, NaN and infinite ones are summed as doubles into ``other``, so
    that they come through as they would in any sum; ``other`` is NULL if there are none, and
    both are NULL if there are no amounts.
    """
    small = F.abs(amount) < EXACT_BELOW
    value = F.when(small, amount)
    whole = F.floor(value)
    fraction = _billionths(value, whole)

    def summed(part: Column, bits: int) -> Column:
        high = F.sum(F.shiftright(part, bits)).cast("decimal(20,0)")
        low = F.sum(part.bitwiseAND(F.lit((1 << bits) - 1))).cast("decimal(20,0)")
        return high * F.lit(1 << bits).cast("decimal(8,0)") + low

    billionths = F.lit("0.000000001").cast("decimal(9,9)")
    wholes = summed(whole, _WHOLE_BITS).cast("decimal(28,0)")
    fractions = summed(fraction, _FRACTION_BITS).cast("decimal(28,0)")
    exact = (wholes + fractions * billionths).cast("decimal(38,9)")
    return F.struct(exact.alias("exact"), F.sum(F.when(~small, amount)).alias("other"))


def total_of(totals: Column) -> Column:
    """Aggregate: the total of totals that :func:`exact_total` gave, in the same form."""
    return F.struct(
        F.sum(totals["exact"]).cast("decimal(38,9)").alias("exact"),
        F.sum(totals["other"]).alias("other"),
    )


def as_double(total: Column) -> Column:
    """A total of :func:`exact_total` as one number. NULL if there were no amounts."""
    exact, other = total["exact"].cast("double"), total["other"]
    return F.coalesce(exact + other, exact, other)


def money_sum(amount: Column) -> Column:
    """Aggregate: the sum of ``amount``, as DOUBLE. NULL if there is none."""
    return as_double(exact_total(amount))


def zero_if_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def two_places(value: Column) -> Column:
    """Money as it is shown: two decimals, a missing amount reads as 0."""
    return F.round(F.coalesce(value, F.lit(0.0)), 2)
