"""Data-quality gate, late-rate decision and audit row."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.operators.dq import (MAX_NULL_RATE, NULL_FIELDS, audit_row, gold_checks,
                                    late_checks, late_metrics, silver_checks)
from pricelens.plans.catalog import SQL_LATE, SQL_ON_TIME, SQL_TICKS, register, ticks, with_
from pricelens.plans.q_star import RUN_TS, _GOLD_CTES, gold
from pricelens.plans.q_ticks import SQL_SILVER_5MIN
from pricelens.plans.silver import late_table, silver_5min
from pricelens.session import store

DQ_RUN_TS = "2024-01-30 23:59:59"   # the DAG run the checks describe
_DAY = DQ_RUN_TS[:10]
_TODAY = (f"(processing_timestamp >= TIMESTAMP '{_DAY} 00:00:00' AND "
          f"processing_timestamp < TIMESTAMP '{_DAY} 00:00:00' + INTERVAL 1 DAY)")

SQL_A = "a AS (SELECT count(*) AS n, max(processing_timestamp) AS latest, " + \
    f"count_if({_TODAY}) AS today, " + ", ".join(
        f"count_if({_TODAY} AND {f} IS NULL) AS null_{f}" for f in NULL_FIELDS) + " FROM silver5)"
_AGE = f"CASE WHEN n = 0 THEN 999 ELSE date_sub('hour', latest, TIMESTAMP '{DQ_RUN_TS}') END"
SQL_SILVER_CHECKS = (
    f"SELECT 'silver_freshness_hours' AS check_name, CAST({_AGE} AS DOUBLE) AS value, "
    f"CAST(2 AS DOUBLE) AS threshold, {_AGE} <= 2 AS passed FROM a\n"
    "UNION ALL SELECT 'silver_rows_today', CAST(today AS DOUBLE), CAST(100 AS DOUBLE), today >= 100 FROM a\n" +
    "".join(f"UNION ALL SELECT 'null_rate_{f}', CAST(null_{f} AS DOUBLE) / "
            f"nullif(CAST(today AS DOUBLE), 0), CAST({MAX_NULL_RATE} AS DOUBLE), coalesce(CAST(null_{f} AS DOUBLE)"
            f" / nullif(CAST(today AS DOUBLE), 0) <= {MAX_NULL_RATE}, true) FROM a\n"
            for f in NULL_FIELDS))

SQL_LATE_M = f"""m AS (
  SELECT (SELECT count(*) FROM silver5 WHERE {_TODAY}) AS total,
         (SELECT count(*) FROM late
          WHERE make_timestamp(ingestion_timestamp * 1000000) >= TIMESTAMP '{_DAY} 00:00:00'
            AND make_timestamp(ingestion_timestamp * 1000000)
                < TIMESTAMP '{_DAY} 00:00:00' + INTERVAL 1 DAY) AS late_total),
mr AS (SELECT *, coalesce(CAST(late_total AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0), 0.0)
              AS late_rate FROM m)"""


def _rename(df):
    return df.withColumnRenamed("check", "check_name")


@register("dq_silver_checks", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN, SQL_A) +
          SQL_SILVER_CHECKS)
def dq_silver_checks(spark, sf_dir):
    """Freshness (truncated hours, empty -> 999),
    today's rows and four null rates of Silver -- one scan."""
    return _rename(silver_checks(silver_5min(ticks(spark, sf_dir)), DQ_RUN_TS))


@register("dq_gold_rows", with_(*_GOLD_CTES) + f"""
SELECT 'gold_rows_today' AS check_name, CAST(n AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold,
       n > 0 AS passed
FROM (SELECT count_if(CAST(CAST(created_at AS TIMESTAMP) AS DATE) = DATE '{RUN_TS[:10]}') AS n
      FROM fact) t""")
def dq_gold_rows(spark, sf_dir):
    """The fact received rows on the load's run date."""
    return _rename(gold_checks(gold(spark, sf_dir).fact, RUN_TS))


@register("dq_late_rate_today", with_(SQL_TICKS, SQL_ON_TIME, SQL_LATE, SQL_SILVER_5MIN,
                                      SQL_LATE_M) + """
SELECT total, late_total, late_rate, late_rate > 0.1 AS reconcile FROM mr""")
def dq_late_rate_today(spark, sf_dir):
    """today's late rate (SAFE_DIVIDE -> 0) and the branch."""
    t = ticks(spark, sf_dir)
    return late_metrics(silver_5min(t), late_table(t), DQ_RUN_TS)


@register("dq_checks_all", with_(*_GOLD_CTES, SQL_LATE, SQL_A, SQL_LATE_M) +
          SQL_SILVER_CHECKS + f"""
UNION ALL SELECT 'gold_rows_today', CAST(n AS DOUBLE), CAST(0 AS DOUBLE), n > 0
FROM (SELECT count_if(CAST(CAST(created_at AS TIMESTAMP) AS DATE) = DATE '{RUN_TS[:10]}') AS n
      FROM fact) g
UNION ALL SELECT 'late_rate_today', late_rate, CAST(0.1 AS DOUBLE), NOT (late_rate > 0.1) FROM mr""")
def dq_checks_all(spark, sf_dir):
    """The DAG's gate as one frame: every check with value, threshold and
    pass flag (check, value, threshold, passed)."""
    t = ticks(spark, sf_dir)
    s5 = store(silver_5min(t), "silver5")
    parts = [silver_checks(s5, DQ_RUN_TS), gold_checks(gold(spark, sf_dir, s5).fact, RUN_TS),
             late_checks(late_metrics(s5, late_table(t), DQ_RUN_TS))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _rename(out)


@register("audit_row", with_(*_GOLD_CTES, SQL_LATE, SQL_LATE_M) + f"""
SELECT '{DQ_RUN_TS[:10]}' AS run_date, '{DQ_RUN_TS.replace(' ', 'T')}' AS run_timestamp,
       CAST(total AS BIGINT) AS silver_rows, (SELECT count(*) FROM fact) AS gold_rows,
       CAST(late_total AS BIGINT) AS late_arrivals, late_rate,
       CAST(CASE WHEN late_rate > 0.1 THEN late_total ELSE 0 END AS BIGINT) AS reconciled_count,
       'SUCCESS' AS status
FROM mr""")
def audit_row_q(spark, sf_dir):
    """The run's 8-column audit row built from the run's metrics."""
    t = ticks(spark, sf_dir)
    s5 = store(silver_5min(t), "silver5")
    m = late_metrics(s5, late_table(t), DQ_RUN_TS)
    gold_rows = gold(spark, sf_dir, s5).fact.agg(F.count(F.lit(1))).scalar()
    return audit_row(m, gold_rows, DQ_RUN_TS)
