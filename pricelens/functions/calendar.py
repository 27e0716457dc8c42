"""Calendar attributes of a date column (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelens.functions.lookups import US_HOLIDAYS_2026


def date_key(d: Column) -> Column:
    """``yyyyMMdd`` as int."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def date_str(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def day_number(d: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(d).cast("int")


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(d) >= 5


def season(d: Column) -> Column:
    m = F.month(d)
    return (F.when(m.isin(12, 1, 2), F.lit("Winter"))
            .when(m.isin(3, 4, 5), F.lit("Spring"))
            .when(m.isin(6, 7, 8), F.lit("Summer"))
            .otherwise(F.lit("Fall")))


def is_holiday(d: Column, holidays: list[str] | None = None) -> Column:
    days = US_HOLIDAYS_2026 if holidays is None else holidays
    return F.coalesce(date_str(d).isin(days), F.lit(False))


def severity(z: Column) -> Column:
    """Banding of a z-score: normal < 1 <= elevated <= 3 < anomaly."""
    return (F.when(z.isNull(), F.lit(None).cast("string"))
            .when(z < 1, F.lit("normal"))
            .when(z <= 3, F.lit("elevated"))
            .otherwise(F.lit("anomaly")))
