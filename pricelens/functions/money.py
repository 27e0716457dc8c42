"""Exact money arithmetic.

Averages of doubles depend on summation order, and ``round(x, 2)`` of a
double differs between engines at ties.  Prices are therefore aggregated as
integer cents (exact, order independent, mergeable across panes) and an
average is rounded half-up in integer space before converting back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(usd: Column) -> Column:
    return F.round(usd * 100).cast("bigint")


def cents_to_usd(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100).cast("double")


def avg_cents_half_up(sum_cents: Column, n: Column) -> Column:
    """round-half-up(sum / n) in cents, as bigint; NULL when n is 0/NULL."""
    twice, by = sum_cents * 2 + n, n * 2
    return F.when(n > 0, F.call_function("div", twice - F.pmod(twice, by), by))  # integers throughout


def avg_usd(sum_cents: Column, n: Column) -> Column:
    """Average price rounded to 2 decimals, exactly."""
    return cents_to_usd(avg_cents_half_up(sum_cents, n))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL when ``den`` is 0 or NULL (SAFE_DIVIDE)."""
    return F.try_divide(num.cast("double"), den.cast("double"))
