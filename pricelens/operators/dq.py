"""Data-quality checks, late-rate decision and audit row.

Each check is a one-row aggregate over the run day's rows, unpivoted to
``check, value, threshold, passed`` rows.  The run time is a parameter; "today"
is a half-open range on the timestamp, filtered first, so it can prune files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.money import safe_ratio
from pricelens.functions.timefn import hours_between, same_day

# --- fixed values: check thresholds ---
FRESHNESS_HOURS = 2
MIN_SILVER_ROWS_TODAY = 100
MAX_NULL_RATE = 0.01
MAX_LATE_RATE = 0.10
EMPTY_AGE_HOURS = 999
NULL_FIELDS = ["flight_number", "avg_price_usd", "window_start", "airline_code"]
# --- end of fixed values ---


def _row(check: str, value: Column, threshold: float, passed: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), value.cast("double").alias("value"),
                    F.lit(float(threshold)).alias("threshold"), passed.alias("passed"))


def silver_checks(silver: DataFrame, run_ts: str, ts_col: str = "processing_timestamp",
                  fields: list[str] | None = None) -> DataFrame:
    """Freshness (P8), today's row count (P9) and null rates (P10) of Silver.
    The day's filter reaches the scan; freshness is a separate max over the one
    column ``ts_col`` of the table.  Empty table -> 999 h; a NULL rate (no rows today)
    passes."""
    fields = NULL_FIELDS if fields is None else fields
    run = F.to_timestamp(F.lit(run_ts))
    today = same_day(F.col(ts_col), F.to_date(run))
    aggs = [F.count(F.lit(1)).alias("today")]
    aggs += [F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in fields]
    a = silver.filter(today).agg(*aggs).withColumn("latest", silver.agg(F.max(ts_col).alias("t")).scalar())
    age = F.when(F.col("latest").isNull(), F.lit(EMPTY_AGE_HOURS)).otherwise(
        hours_between(run, F.col("latest")))
    rows = [_row("silver_freshness_hours", age, FRESHNESS_HOURS, age <= FRESHNESS_HOURS),
            _row("silver_rows_today", F.col("today"), MIN_SILVER_ROWS_TODAY,
                 F.col("today") >= MIN_SILVER_ROWS_TODAY)]
    for f in fields:
        rate = safe_ratio(F.col(f"null_{f}"), F.col("today"))
        rows.append(_row(f"null_rate_{f}", rate, MAX_NULL_RATE,
                         F.coalesce(rate <= MAX_NULL_RATE, F.lit(True))))
    return a.select(F.inline(F.array(*rows)))


def gold_checks(fact: DataFrame, run_ts: str, created_col: str = "created_at") -> DataFrame:
    """Gold received rows on the run date."""
    run = F.to_timestamp(F.lit(run_ts))
    today = fact.filter(same_day(F.col(created_col).cast("timestamp"), F.to_date(run)))
    return today.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(
        _row("gold_rows_today", F.col("n"), 0, F.col("n") > 0))))


def late_metrics(silver: DataFrame, late: DataFrame, run_ts: str,
                 ts_col: str = "processing_timestamp", per: str = "rows") -> DataFrame:
    """One row: today's silver rows, late rows, late rate (SAFE_DIVIDE then 0)
    and whether reconciliation runs (rate > 10 %, strict) (P12).  The rate is
    ``per`` silver "rows", or per "messages": those in the windows and the
    late ones.  The one-row aggregates are combined as scalar subqueries."""
    if per not in ("rows", "messages"):
        raise ValueError(f"unknown denominator {per!r}")
    day = F.to_date(F.to_timestamp(F.lit(run_ts)))
    s = silver.filter(same_day(F.col(ts_col), day)).agg(F.count(F.lit(1)).alias("v")).scalar()
    lt = late.filter(same_day(F.col(ts_col), day)).agg(F.count(F.lit(1)).alias("v")).scalar()
    one = silver.sparkSession.range(1)
    out = one.select(s.alias("total"), lt.alias("late_total"))
    below = F.col("total")
    if per == "messages":
        below = silver.filter(same_day(F.col(ts_col), day)).agg(F.coalesce(F.sum("message_count"), F.lit(0)).alias("v")).scalar() + F.col("late_total")
    rate = F.coalesce(safe_ratio(F.col("late_total"), below), F.lit(0.0))
    return (out.withColumn("late_rate", rate)
            .withColumn("reconcile", F.col("late_rate") > F.lit(MAX_LATE_RATE)))


def late_checks(metrics: DataFrame) -> DataFrame:
    return metrics.select(F.inline(F.array(
        _row("late_rate_today", F.col("late_rate"), MAX_LATE_RATE, ~F.col("reconcile")))))


def audit_row(metrics: DataFrame, gold_rows: Column, run_ts: str,
              status: str = "SUCCESS") -> DataFrame:
    """The run's audit-log row (P14, 8 columns); a missing metric is 0."""
    run = F.to_timestamp(F.lit(run_ts))
    return metrics.select(
        F.date_format(run, "yyyy-MM-dd").alias("run_date"),
        F.date_format(run, "yyyy-MM-dd'T'HH:mm:ss").alias("run_timestamp"),
        F.coalesce(F.col("total"), F.lit(0)).cast("bigint").alias("silver_rows"),
        F.coalesce(gold_rows, F.lit(0)).cast("bigint").alias("gold_rows"),
        F.coalesce(F.col("late_total"), F.lit(0)).cast("bigint").alias("late_arrivals"),
        F.coalesce(F.col("late_rate"), F.lit(0.0)).alias("late_rate"),
        F.when(F.col("reconcile"), F.col("late_total")).otherwise(F.lit(0))
        .cast("bigint").alias("reconciled_count"),
        F.lit(status).alias("status"))
