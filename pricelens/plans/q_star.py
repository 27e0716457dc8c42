"""Star-schema queries: dimensions, SCD2, point-in-time join, fact load."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from pricelens.functions.lookups import ALLIANCES, DOMESTIC_CARRIERS, US_HOLIDAYS_2026
from pricelens.functions.money import avg_usd, to_cents
from pricelens.operators.dedup import keep_best
from pricelens.operators.dims import (date_rows, dim_airlines_new, join_point_in_time, new_members,
                                      scd2_apply, scd2_build)
from pricelens.plans.catalog import (SQL_ON_TIME, SQL_TICKS, register, schedule,
                                     sql_avg, sql_schedule, ticks, with_)
from pricelens.plans.daily import (DIM_AIRLINE_SCHEMA, DIM_DATE_SCHEMA, DIM_FLIGHT_SCHEMA, MOMENTS_SCHEMA,
                                   check_and_audit, committed, gold_frames, read_baselines, read_fact,
                                   read_flights, read_runs, run_daily)
from pricelens.plans.q_ticks import SQL_SCORED, SQL_SILVER_1HR, SQL_SILVER_5MIN
from pricelens.plans.silver import late_table, silver_1hr, silver_5min
from pricelens.session import cut_lineage, scratch_dir, store
from pricelens.sources.tables import read_increment, read_table

# Run parameters of the registered queries (the reference uses "now").
RUN_TS = "2024-01-31 06:00:00"
SPLIT_DATE = "1996-01-01"   # end of the first of two daily runs over orders
NEXT_DATE = "1997-01-01"    # end of the second


def _q(xs):
    return ", ".join(f"'{x}'" for x in xs)


SQL_SEASON = """CASE (month({d}) % 12) // 3 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'Fall' END"""


def sql_date_rows(d: str) -> str:
    return f"""CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key,
  strftime({d}, '%Y-%m-%d') AS date, dayname({d}) AS day_of_week,
  CAST(isodow({d}) - 1 AS INTEGER) AS day_number, isodow({d}) >= 6 AS is_weekend,
  CAST(month({d}) AS INTEGER) AS month, CAST(quarter({d}) AS INTEGER) AS quarter,
  strftime({d}, '%Y-%m-%d') IN ({_q(US_HOLIDAYS_2026)}) AS is_us_holiday,
  {SQL_SEASON.format(d=d)} AS season"""


SQL_ALLIANCE = "CASE {c} " + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in ALLIANCES.items()) + " ELSE 'None' END"


@register("dim_date", f"""
SELECT {sql_date_rows('d')}
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL) t""")
def dim_date(spark, sf_dir):
    """Date dimension over every order date (new members of an
    empty dimension)."""
    o = read_table(spark, sf_dir, "orders")
    dates = o.select(F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("date"))
    empty = spark.createDataFrame([], DIM_DATE_SCHEMA)
    return date_rows(new_members(dates, empty, "date"), "date")


@register("dim_airline", with_(sql_schedule()) + f"""
SELECT CAST(999 + row_number() OVER (ORDER BY airline_code) AS INTEGER) AS airline_key,
       airline_code, airline_name, {SQL_ALLIANCE.format(c='airline_code')} AS alliance,
       coalesce(airline_code IN ({_q(DOMESTIC_CARRIERS)}), false) AS is_domestic
FROM (SELECT airline_iata AS airline_code, min(airline_name) AS airline_name
      FROM sched WHERE airline_iata IS NOT NULL GROUP BY 1) t""")
def dim_airline(spark, sf_dir):
    """Carrier dimension with surrogate keys from 1000, alliance
    lookup with default "None" and domestic flag."""
    s = schedule(spark, sf_dir).select(F.col("airline_iata").alias("airline_code"),
                                       "airline_name")
    return dim_airlines_new(s, spark.createDataFrame([], DIM_AIRLINE_SCHEMA))


# -------------------------------------------------------------------- SCD2
def _order_history(spark, sf_dir, lo=None, hi=None):
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey",
        F.to_date("o_orderdate").alias("o_orderdate"))
    if hi is not None:
        o = read_increment(o, "o_orderdate", F.to_date(F.lit(lo)) if lo else None,
                           F.to_date(F.lit(hi)))
    return o


SCD_NAT, SCD_TRACKED = ["o_custkey"], ["o_orderpriority", "o_orderstatus"]


def _scd2_sql(where: str = "") -> str:
    return f"""d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d,
         arg_max(o_orderpriority, o_orderkey) AS p, arg_max(o_orderstatus, o_orderkey) AS s
  FROM orders WHERE o_custkey IS NOT NULL {where} GROUP BY 1, 2),
l AS (SELECT *, lag(p) OVER w AS pp, lag(s) OVER w AS ps, row_number() OVER w AS rn
      FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY d)),
v AS (SELECT * FROM l WHERE rn = 1 OR p IS DISTINCT FROM pp OR s IS DISTINCT FROM ps),
scd AS (SELECT CAST(1999 + row_number() OVER (ORDER BY o_custkey, d) AS INTEGER) AS customer_key,
       o_custkey, p AS o_orderpriority, s AS o_orderstatus,
       strftime(d, '%Y-%m-%d') AS effective_date,
       coalesce(strftime(lead(d) OVER (PARTITION BY o_custkey ORDER BY d), '%Y-%m-%d'),
                '9999-12-31') AS expiry_date,
       lead(d) OVER (PARTITION BY o_custkey ORDER BY d) IS NULL AS is_current
FROM v)"""


def _scd2_full(spark, sf_dir):
    h = _order_history(spark, sf_dir).filter(F.col("o_custkey").isNotNull())
    return scd2_build(h, SCD_NAT, SCD_TRACKED, "o_orderdate", "customer_key", 2000,
                      tie="o_orderkey")


@register("dim_scd2", with_(_scd2_sql()) + "SELECT * FROM scd")
def dim_scd2(spark, sf_dir):
    """P5: type-2 history of each customer's (priority, status) by order
    date -- one row per customer-day (largest order key), a new version only
    when an attribute changes (NULL-safe), validity [effective, expiry)."""
    return _scd2_full(spark, sf_dir).select(
        "customer_key", "o_custkey", "o_orderpriority", "o_orderstatus",
        "effective_date", "expiry_date", "is_current")


@register("scd2_incremental", with_(_scd2_sql()) + """
SELECT o_custkey, o_orderpriority, o_orderstatus, effective_date, expiry_date, is_current
FROM scd""")
def scd2_incremental(spark, sf_dir):
    """P5 applied as three daily runs (up to SPLIT_DATE, up to NEXT_DATE,
    the rest): intermediate versions kept, old rows closed at the change
    date; equals the one-shot history (keys aside, which continue per run)."""
    def batch(lo, hi):
        h = _order_history(spark, sf_dir, lo, hi).filter(F.col("o_custkey").isNotNull())
        h = h.withColumn("_day", F.col("o_orderdate"))
        return keep_best(h, ["o_custkey", "_day"], [("o_orderkey", True)]).drop(
            "o_orderkey", "o_orderdate")
    empty = spark.createDataFrame(
        [], "customer_key int, o_custkey bigint, o_orderpriority string, o_orderstatus string,"
            " effective_date string, expiry_date string, is_current boolean")
    dim = empty
    for lo, hi in ((None, SPLIT_DATE), (SPLIT_DATE, NEXT_DATE), (NEXT_DATE, "9999-12-31")):
        dim = scd2_apply(dim, batch(lo, hi), SCD_NAT, SCD_TRACKED, "_day", "customer_key")
        dim = cut_lineage(dim)  # each run's dimension is a stored table
    return dim.select("o_custkey", "o_orderpriority", "o_orderstatus", "effective_date",
                      "expiry_date", "is_current")


@register("scd2_point_in_time", with_(_scd2_sql()) + """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       strftime(l.l_shipdate, '%Y-%m-%d') AS ship_date, scd.customer_key,
       scd.o_orderpriority AS priority_at_ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN scd ON scd.o_custkey = o.o_custkey
  AND scd.effective_date <= strftime(l.l_shipdate, '%Y-%m-%d')
  AND strftime(l.l_shipdate, '%Y-%m-%d') < scd.expiry_date""")
def scd2_point_in_time(spark, sf_dir):
    """Each line item joined to its customer's version valid on the
    ship date (effective <= date < expiry; never more than one match)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    fact = li.join(o, "l_orderkey")
    dim = _scd2_full(spark, sf_dir).select(
        "o_custkey", "customer_key", F.col("o_orderpriority").alias("priority_at_ship"),
        "effective_date", "expiry_date")
    return join_point_in_time(fact, dim, ["o_custkey"], "ship_date").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ship_date",
        "customer_key", "priority_at_ship")


# --------------------------------------------------------- increments, D5/D6
@register("incremental_slice", f"""
SELECT * FROM orders
WHERE o_orderdate > CAST('{SPLIT_DATE}' AS TIMESTAMP) AND o_orderdate <= CAST('{NEXT_DATE}' AS TIMESTAMP)""")
def incremental_slice(spark, sf_dir):
    """A3 C4: the run's increment (mark, hi] -- strict lower bound, inclusive
    upper bound fixed before the run; pushed into the parquet scan."""
    o = read_table(spark, sf_dir, "orders")
    return read_increment(o, "o_orderdate", F.lit(SPLIT_DATE).cast("timestamp_ntz"),
                          F.lit(NEXT_DATE).cast("timestamp_ntz"))


@register("new_members", f"""
SELECT DISTINCT o.o_custkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderdate > CAST('{SPLIT_DATE}' AS TIMESTAMP) AND o.o_orderdate <= CAST('{NEXT_DATE}' AS TIMESTAMP)
  AND o.o_custkey NOT IN (SELECT o_custkey FROM orders
                          WHERE o_orderdate <= CAST('{SPLIT_DATE}' AS TIMESTAMP)
                            AND o_custkey IS NOT NULL)""")
def new_members_q(spark, sf_dir):
    """Customers first seen in the increment (left anti join against
    the members known before it)."""
    o = read_table(spark, sf_dir, "orders")
    known = o.filter(F.col("o_orderdate") <= F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    inc = read_increment(o, "o_orderdate", F.lit(SPLIT_DATE).cast("timestamp_ntz"),
                         F.lit(NEXT_DATE).cast("timestamp_ntz"))
    new = new_members(inc, known, "o_custkey")
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name")
    return new.join(c, "o_custkey")


@register("changed_members", f"""
WITH before AS (
  SELECT o_custkey, arg_max(o_orderpriority, {{'d': o_orderdate, 'k': o_orderkey}}) AS p,
         arg_max(o_orderstatus, {{'d': o_orderdate, 'k': o_orderkey}}) AS s
  FROM orders WHERE o_orderdate <= CAST('{SPLIT_DATE}' AS TIMESTAMP) GROUP BY 1),
inc AS (
  SELECT o_custkey, arg_max(o_orderpriority, {{'d': o_orderdate, 'k': o_orderkey}}) AS p,
         arg_max(o_orderstatus, {{'d': o_orderdate, 'k': o_orderkey}}) AS s
  FROM orders WHERE o_orderdate > CAST('{SPLIT_DATE}' AS TIMESTAMP)
    AND o_orderdate <= CAST('{NEXT_DATE}' AS TIMESTAMP) GROUP BY 1)
SELECT i.o_custkey, b.p AS old_priority, b.s AS old_status, i.p AS new_priority,
       i.s AS new_status
FROM inc i JOIN before b ON i.o_custkey = b.o_custkey
WHERE b.p IS DISTINCT FROM i.p OR b.s IS DISTINCT FROM i.s""")
def changed_members(spark, sf_dir):
    """Members whose tracked attributes differ (NULL-safe) between their
    last state before the increment and their last state inside it."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_orderkey")
    order = [("o_orderdate", True), ("o_orderkey", True)]
    before = keep_best(o.filter(F.col("o_orderdate") <= F.lit(SPLIT_DATE).cast("timestamp_ntz")),
                       ["o_custkey"], order)
    inc = keep_best(read_increment(o, "o_orderdate", F.lit(SPLIT_DATE).cast("timestamp_ntz"),
                                   F.lit(NEXT_DATE).cast("timestamp_ntz")), ["o_custkey"], order)
    b = before.select("o_custkey", F.col("o_orderpriority").alias("old_priority"),
                      F.col("o_orderstatus").alias("old_status"))
    i = inc.select("o_custkey", F.col("o_orderpriority").alias("new_priority"),
                   F.col("o_orderstatus").alias("new_status"))
    j = i.join(b, "o_custkey")
    changed = (~F.col("old_priority").eqNullSafe(F.col("new_priority"))) | \
        (~F.col("old_status").eqNullSafe(F.col("new_status")))
    return j.filter(changed).select("o_custkey", "old_priority", "old_status",
                                    "new_priority", "new_status")


# ------------------------------------------------------------ fact / star
def gold(spark, sf_dir, silver5=None):
    """Gold from Silver, which is a stored table in the job: every dimension
    and the fact read it (``silver5``: where the caller has stored it)."""
    t = ticks(spark, sf_dir)
    empty = spark.createDataFrame
    return gold_frames(silver5 or store(silver_5min(t), "silver5"), store(silver_1hr(t), "silver1h"), empty([], DIM_DATE_SCHEMA),
                       empty([], DIM_AIRLINE_SCHEMA), empty([], DIM_FLIGHT_SCHEMA), RUN_TS)


SQL_GOLD = f"""fl AS (SELECT flight_number, strftime(min(CAST(window_start AS DATE)), '%Y-%m-%d') AS eff,
                  arg_min(route_id, window_start) AS route_id
           FROM silver5 GROUP BY 1),
flk AS (SELECT *, CAST(1999 + row_number() OVER (ORDER BY flight_number, eff) AS INTEGER) AS flight_key
        FROM fl),
al AS (SELECT airline_code, min(airline_name) AS airline_name,
              CAST(999 + row_number() OVER (ORDER BY airline_code) AS INTEGER) AS airline_key
       FROM silver5 GROUP BY airline_code),
fact AS (
  SELECT flk.flight_key, al.airline_key, CAST(strftime(s.window_start, '%Y%m%d') AS INTEGER) AS date_key,
         s.window_start, s.window_end, s.avg_price_usd, s.min_price_usd, s.max_price_usd,
         s.message_count, s.is_anomaly, s.z_score, '{RUN_TS}' AS created_at
  FROM scored s
  LEFT JOIN flk ON s.flight_number = flk.flight_number AND flk.eff <= strftime(s.window_start, '%Y-%m-%d')
  LEFT JOIN al ON s.airline_code = al.airline_code)"""

_GOLD_CTES = (SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN, SQL_SILVER_1HR, SQL_SCORED, SQL_GOLD)


@register("fact_star_load", with_(*_GOLD_CTES) + "SELECT * FROM fact")
def fact_star_load(spark, sf_dir):
    """Dedup -> dims (date, carrier, SCD2 flights) -> score ->
    fact rows with surrogate keys via three left joins."""
    return gold(spark, sf_dir).fact


@register("star_top_anomalies", with_(*_GOLD_CTES) + """
SELECT flk.flight_number, al.airline_name, flk.route_id, f.window_start, f.avg_price_usd, f.z_score
FROM fact f JOIN flk ON f.flight_key = flk.flight_key JOIN al ON f.airline_key = al.airline_key
WHERE f.is_anomaly
ORDER BY f.z_score DESC, flk.flight_number, f.window_start LIMIT 10""")
def star_top_anomalies(spark, sf_dir):
    """Inner star join fact x flights x carriers, top anomalies."""
    g = gold(spark, sf_dir)
    air = g.dim_airlines.select("airline_key", "airline_name")
    fl = g.dim_flights.filter(F.col("is_current")).select("flight_key", "flight_number", "route_id")
    j = g.fact.filter(F.col("is_anomaly")).join(fl, "flight_key").join(air, "airline_key")
    return (j.orderBy(F.col("z_score").desc(), "flight_number", "window_start").limit(10)
            .select("flight_number", "airline_name", "route_id", "window_start",
                    "avg_price_usd", "z_score"))


@register("cheapest_carrier", with_(*_GOLD_CTES) + f"""
SELECT al.airline_name, count(*) AS windows,
       {sql_avg('sum(CAST(round(f.avg_price_usd * 100) AS BIGINT))', 'count(*)')} AS avg_price_usd
FROM fact f JOIN al ON f.airline_key = al.airline_key
GROUP BY al.airline_name ORDER BY avg_price_usd, al.airline_name""")
def cheapest_carrier(spark, sf_dir):
    """Average window price per carrier over the star join, cheapest
    first."""
    g = gold(spark, sf_dir)
    j = g.fact.join(g.dim_airlines.select("airline_key", "airline_name"), "airline_key")
    agg = j.groupBy("airline_name").agg(F.count(F.lit(1)).alias("windows"),
                                        F.sum(to_cents(F.col("avg_price_usd"))).alias("_c"))
    return agg.select("airline_name", "windows",
                      avg_usd(F.col("_c"), F.col("windows")).alias("avg_price_usd")) \
        .orderBy("avg_price_usd", "airline_name")


SQL_DAILY = """SELECT s.flight_number, flk.route_id, s.airline_code, al.airline_name,
  strftime(s.window_start, '%Y-%m-%d') AS date, s.window_start, s.window_end, s.avg_price_usd,
  s.message_count, s.is_anomaly, s.z_score
FROM scored s JOIN flk ON s.flight_number = flk.flight_number JOIN al ON s.airline_code = al.airline_code"""


def daily_tables(spark, sf_dir, runs: int = 3) -> str:
    """Silver written from the ticks, then ``runs`` daily runs over equal
    parts of its processing time; returns the tables' folder."""
    t = ticks(spark, sf_dir)
    root = scratch_dir(spark, "daily")
    silver_5min(t).write.parquet(os.path.join(root, "silver", "price_5min"))
    silver_1hr(t).write.parquet(os.path.join(root, "silver", "price_1hr"))
    late_table(t).write.parquet(os.path.join(root, "silver", "late_arrivals"))
    done = spark.read.parquet(os.path.join(root, "silver", "price_5min")).agg(
        F.min(F.unix_timestamp("processing_timestamp")), F.max(F.unix_timestamp("processing_timestamp"))).first()
    for k in range(1, runs + 1):
        upto = None if k == runs or done[0] is None else time.strftime(
            "%Y-%m-%d %H:%M:%S", time.gmtime(done[0] + (done[1] - done[0]) * k // runs))
        run_daily(spark, root, f"2024-01-31 0{k}:00:00", upto=upto)
    return root


@register("daily_incremental", with_(*_GOLD_CTES) + SQL_DAILY)
def daily_incremental(spark, sf_dir):
    """Three increments through the written tables equal one full run;
    the stored fact joined back to the stored dimensions by its keys."""
    root = daily_tables(spark, sf_dir)
    runs = committed(spark, root, "daily_batch")
    fact = read_fact(spark, root)
    flights = read_flights(spark, root, runs, "2024-01-31 03:00:00").select("flight_key", "route_id")
    airlines = read_runs(spark, root, "dim_airlines", DIM_AIRLINE_SCHEMA, runs).select("airline_key", "airline_code", "airline_name")
    dates = read_runs(spark, root, "dim_date", DIM_DATE_SCHEMA, runs).select("date_key", "date")
    joined = fact.join(flights, "flight_key").join(airlines, "airline_key").join(dates, "date_key")
    return joined.select("flight_number", "route_id", "airline_code", "airline_name", "date", "window_start", "window_end",
                         "avg_price_usd", "message_count", "is_anomaly", "z_score")


def arriving_tables(spark, sf_dir, runs: int = 3) -> str:
    """Silver that grows between ``runs`` daily runs: before each, the windows
    that changed since the last are appended as they then are, so a window that
    fired again has several rows; returns the tables' folder."""
    t, root = ticks(spark, sf_dir), scratch_dir(spark, "arriving")
    on_time = t.where("ingestion_timestamp - event_timestamp <= 120")
    lo, hi = on_time.agg(F.min("ingestion_timestamp"), F.max("ingestion_timestamp")).first()
    cuts = [] if lo is None else [lo + (hi - lo) * k // runs for k in range(1, runs)] + [hi]
    for k, cut in enumerate(cuts):
        for name, silver in (("price_5min", silver_5min), ("price_1hr", silver_1hr)):
            windows = silver(t.where(F.col("ingestion_timestamp") <= cut))
            if k:
                windows = windows.where(F.unix_timestamp("processing_timestamp") > cuts[k - 1])
            windows.write.mode("append").parquet(os.path.join(root, "silver", name))
        run_daily(spark, root, f"2024-01-31 0{k + 1}:00:00")
    return root


@register("daily_baselines", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_1HR) + """
SELECT flight_number, count(avg_price_usd) AS windows, round(avg(avg_price_usd), 6) AS rolling_mean,
       round(coalesce(stddev_samp(avg_price_usd), -1), 6) AS rolling_stddev
FROM silver1h GROUP BY flight_number""")
def daily_baselines(spark, sf_dir):
    """Each flight's baseline after three daily runs over Silver that
    grew in between, from stored moments to which every run added only what was
    new; equal to a recount of all history."""
    root = arriving_tables(spark, sf_dir)
    last = "2024-01-31 03:00:00"
    state = read_runs(spark, root, "baseline_moments", MOMENTS_SCHEMA, committed(spark, root, "daily_batch").where(F.col("run") == last))
    return state.select("flight_number", F.col("n").alias("windows")).join(read_baselines(spark, root, last), "flight_number").select(
        "flight_number", "windows", F.round("rolling_mean", 6).alias("rolling_mean"), F.round(F.coalesce("rolling_stddev", F.lit(-1.0)), 6).alias("rolling_stddev"))


@register("daily_checks", with_(*_GOLD_CTES) + """, m AS (SELECT
  (SELECT count(*) FROM silver5 WHERE CAST(processing_timestamp AS DATE) = DATE '2024-01-30') AS total,
  (SELECT count(*) FROM ticks WHERE ingestion_timestamp - event_timestamp > 120
     AND CAST(make_timestamp(ingestion_timestamp * 1000000) AS DATE) = DATE '2024-01-30') AS late_total)
SELECT '2024-01-30' AS run_date, total AS silver_rows, CAST(0 AS BIGINT) AS gold_rows, late_total AS late_arrivals,
  CASE WHEN total = 0 THEN 0.0 ELSE CAST(late_total AS DOUBLE) / total END AS late_rate, 'SUCCESS' AS status FROM m""")
def daily_checks(spark, sf_dir):
    """The audit log after the checks of a run on the last day of the
    ticks (the fact was loaded the day after, so that day has no Gold rows)."""
    root = daily_tables(spark, sf_dir, runs=1)
    check_and_audit(spark, root, "2024-01-30 12:00:00")
    return spark.read.parquet(os.path.join(root, "control", "audit_log")).select(
        "run_date", "silver_rows", "gold_rows", "late_arrivals", "late_rate", "status")


@register("daily_checks_loaded", with_(*_GOLD_CTES) + """, m AS (SELECT
  (SELECT count(*) FROM silver5 WHERE CAST(processing_timestamp AS DATE) = DATE '2024-01-31') AS total,
  (SELECT count(*) FROM ticks WHERE ingestion_timestamp - event_timestamp > 120
     AND CAST(make_timestamp(ingestion_timestamp * 1000000) AS DATE) = DATE '2024-01-31') AS late_total)
SELECT '2024-01-31' AS run_date, total AS silver_rows, (SELECT count(*) FROM fact) AS gold_rows, late_total AS late_arrivals,
  CASE WHEN total = 0 THEN 0.0 ELSE CAST(late_total AS DOUBLE) / total END AS late_rate, 'SUCCESS' AS status FROM m""")
def daily_checks_loaded(spark, sf_dir):
    """The audit log after the checks on the day of the load, when
    the fact has rows of that day."""
    root = daily_tables(spark, sf_dir, runs=2)
    check_and_audit(spark, root, "2024-01-31 12:00:00")
    return spark.read.parquet(os.path.join(root, "control", "audit_log")).select(
        "run_date", "silver_rows", "gold_rows", "late_arrivals", "late_rate", "status")


ROUTE = "ORD-7"


@register("cheapest_carrier_on_route", with_(*_GOLD_CTES) + f"""
SELECT al.airline_name, count(*) AS windows,
       {sql_avg('sum(CAST(round(f.avg_price_usd * 100) AS BIGINT))', 'count(*)')} AS avg_price_usd
FROM fact f JOIN flk ON f.flight_key = flk.flight_key JOIN al ON f.airline_key = al.airline_key
WHERE flk.route_id = '{ROUTE}' GROUP BY al.airline_name ORDER BY avg_price_usd, al.airline_name""")
def cheapest_carrier_on_route(spark, sf_dir):
    """Carriers on one route (through the flight dimension), cheapest first."""
    g = gold(spark, sf_dir)
    flights = g.dim_flights.filter(F.col("route_id") == ROUTE).select("flight_key")
    j = g.fact.join(flights, "flight_key").join(g.dim_airlines.select("airline_key", "airline_name"), "airline_key")
    agg = j.groupBy("airline_name").agg(F.count(F.lit(1)).alias("windows"),
                                        F.sum(to_cents(F.col("avg_price_usd"))).alias("_c"))
    return agg.select("airline_name", "windows",
                      avg_usd(F.col("_c"), F.col("windows")).alias("avg_price_usd")) \
        .orderBy("avg_price_usd", "airline_name")


@register("weekend_morning_prices", with_(*_GOLD_CTES) + f"""
SELECT flk.route_id, count(*) AS windows,
       {sql_avg('sum(CAST(round(f.avg_price_usd * 100) AS BIGINT))', 'count(*)')} AS avg_price_usd
FROM fact f JOIN flk ON f.flight_key = flk.flight_key
WHERE isodow(f.window_start) >= 6 AND hour(f.window_start) BETWEEN 6 AND 11
  AND month(f.window_start) = 1
GROUP BY flk.route_id""")
def weekend_morning_prices(spark, sf_dir):
    """E24: "cheapest on weekend mornings in January" -- fact x dim_date
    (weekend flag, month) x current flights, morning hours of the window."""
    g = gold(spark, sf_dir)
    dd = g.dim_date.select("date_key", "is_weekend", "month")
    fl = g.dim_flights.filter(F.col("is_current")).select("flight_key", "route_id")
    j = (g.fact.join(dd, "date_key").join(fl, "flight_key")
         .filter(F.col("is_weekend") & (F.col("month") == 1)
                 & F.hour("window_start").between(6, 11)))
    agg = j.groupBy("route_id").agg(F.count(F.lit(1)).alias("windows"),
                                    F.sum(to_cents(F.col("avg_price_usd"))).alias("_c"))
    return agg.select("route_id", "windows",
                      avg_usd(F.col("_c"), F.col("windows")).alias("avg_price_usd"))
