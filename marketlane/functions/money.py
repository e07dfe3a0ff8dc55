"""Aggregates over money and ratios that give the same bits on every run.

A sum of doubles depends on the order in which partial sums meet, and that
order changes when a task is retried. Amounts are therefore added as decimals
of whole millionths and ratios of whole billionths, so nothing of a cent is
lost and no sum overflows. Single values stay below 9e12 and 9e9.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS_PER_UNIT = 100.0
# Steps of a unit that sums of amounts and of ratios keep.
AMOUNT_STEPS = 1_000_000.0
RATIO_STEPS = 1_000_000_000.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    """Nearest whole cent as BIGINT."""
    return F.floor(_col(amount) * F.lit(CENTS_PER_UNIT) + F.lit(0.5))


def steps(amount: Column | str) -> Column:
    """The amount as a whole number of AMOUNT_STEPS, for sums."""
    return F.floor(_col(amount) * F.lit(AMOUNT_STEPS) + F.lit(0.5)).cast("decimal(20,0)")


def of_steps(total: Column) -> Column:
    """A sum of ``steps`` as an amount."""
    return total.cast("double") / F.lit(AMOUNT_STEPS)


def money_sum(amount: Column | str) -> Column:
    """Exact sum of an amount; NULL when there is nothing to add."""
    return of_steps(F.sum(steps(amount)))


def money_sum_where(condition: Column, amount: Column | str) -> Column:
    """Sum of the amount over rows that meet ``condition``, 0 when none does."""
    return of_steps(F.sum(F.when(condition, steps(amount)).otherwise(F.lit(0).cast("decimal(20,0)"))))


def money_avg(amount: Column | str) -> Column:
    """Exact mean of an amount; NULL when every value is NULL."""
    return money_sum(amount) / F.count(_col(amount))


def ratio_avg(ratio: Column | str) -> Column:
    """Mean of a ratio, each value taken to nine decimals."""
    c = _col(ratio)
    whole = F.floor(c * F.lit(RATIO_STEPS) + F.lit(0.5)).cast("decimal(20,0)")
    return F.sum(whole).cast("double") / F.lit(RATIO_STEPS) / F.count(c)


def percent_where(condition: Column) -> Column:
    """Share of the group's rows that meet ``condition``, in percent."""
    hits = F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("double")
    return hits * F.lit(100.0) / F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows that meet ``condition``."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))
