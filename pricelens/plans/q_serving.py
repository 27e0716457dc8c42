"""Serving queries: summaries, refreshing route summary, semantic layer,
query pack (P17-P21, E11-E16, E21, E23, G1, A11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions.lookups import INTERNATIONAL_AIRPORTS, route_type
from pricelens.functions.money import avg_usd, cents_to_usd, to_cents
from pricelens.operators.semantic import MODEL, semantic_query
from pricelens.operators.serving import (HOURLY_SCHEMA, distinct_estimate, distinct_sketches, flight_day_summary, refresh_changed, refresh_if_stale,
                                         route_day_stats, route_summary, score_schedule)
from pricelens.plans.catalog import register, schedule, sql_avg, sql_schedule, sql_usd, with_
from pricelens.session import scratch_dir, store
from pricelens.sinks.versions import read_live
from pricelens.sinks.writers import append
from pricelens.sources.tables import columns
from pricelens.sources.views import SCHEDULE_POSITION
from pricelens.plans.q_star import RUN_TS, SQL_ALLIANCE, SQL_SEASON

POS = "{'o': pos_orderkey, 'l': pos_linenumber, 'p': pos_partkey, 's': pos_suppkey}"


def _q(xs):
    return ", ".join(f"'{x}'" for x in xs)


SUMMARY_COLUMNS = ["flight_iata", "route_id", "departure_iata", "arrival_iata", "airline_name", "airline_iata", "flight_date", "price_usd"]


def scored(spark, sf_dir, more=()):
    """The four-table join is stored once, as statistics and rows both read
    it, with the columns that its readers need."""
    return score_schedule(store(schedule(spark, sf_dir).select(*SUMMARY_COLUMNS, *more), "schedule"))


def stats(spark, sf_dir):
    return route_day_stats(scored(spark, sf_dir, ["departure_scheduled", *SCHEDULE_POSITION]), RUN_TS)


def summary(spark, sf_dir):
    return flight_day_summary(scored(spark, sf_dir), RUN_TS)


def hourly(spark, sf_dir):
    return route_summary(summary(spark, sf_dir))


SQL_SCORED_S = """st AS (SELECT flight_iata, avg(price_usd) AS m, stddev_samp(price_usd) AS sd
       FROM sched GROUP BY flight_iata),
scored_s AS (
  SELECT s.*, CASE WHEN s.price_usd IS NULL THEN NULL
                   ELSE (CASE WHEN st.sd IS NULL OR st.sd = 0 THEN 0.0
                              ELSE abs(s.price_usd - st.m) / st.sd END) > 3.0 END AS is_anomaly
  FROM sched s LEFT JOIN st ON s.flight_iata = st.flight_iata)"""

SQL_FPS = f"""fps AS (
  SELECT coalesce(flight_iata, 'UNKNOWN') AS flight_number, route_id,
         departure_iata AS origin, arrival_iata AS destination, airline_name,
         {SQL_ALLIANCE.format(c='airline_iata')} AS alliance, flight_date AS date,
         isodow(CAST(flight_date AS DATE)) >= 6 AS is_weekend,
         {SQL_SEASON.format(d='CAST(flight_date AS DATE)')} AS season,
         {sql_avg('sum(cents)', 'count(price_usd)')} AS avg_price_usd,
         {sql_usd('min(cents)')} AS min_price_usd, {sql_usd('max(cents)')} AS max_price_usd,
         CAST(count_if(is_anomaly) AS INTEGER) AS anomaly_count,
         CAST(count(*) AS INTEGER) AS window_count,
         TIMESTAMP '{RUN_TS}' AS loaded_at
  FROM scored_s WHERE arrival_iata IS NOT NULL AND flight_iata IS NOT NULL
  GROUP BY ALL)"""

SQL_HRS = f"""hrs AS (
  SELECT route_id, origin, destination, date, season, is_weekend,
         count(DISTINCT airline_name) AS airline_count,
         {sql_avg('sum(CAST(round(avg_price_usd * 100) AS BIGINT))', 'count(avg_price_usd)')} AS avg_price,
         min(min_price_usd) AS min_price, max(max_price_usd) AS max_price,
         CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies, max(loaded_at) AS last_updated
  FROM fps GROUP BY route_id, origin, destination, date, season, is_weekend)"""

_CTES = (sql_schedule(), SQL_SCORED_S, SQL_FPS, SQL_HRS)


@register("flight_price_summary", with_(*_CTES) + "SELECT * FROM fps")
def flight_price_summary(spark, sf_dir):
    """Per flight, route and day -- carrier, alliance
    (IN-list CASE), weekend, season, exact prices from real fares,
    anomalies and priced rows."""
    return summary(spark, sf_dir)


@register("route_stats", with_(*_CTES) + f"""
SELECT route_id, departure_iata AS origin, arrival_iata AS destination, flight_date AS date,
       CAST(count(DISTINCT airline_iata) AS INTEGER) AS airline_count,
       arg_min(airline_name, {{'c': cents, 'o': pos_orderkey, 'l': pos_linenumber,
                              'p': pos_partkey, 's': pos_suppkey}}) AS cheapest_airline,
       arg_min(airline_name, {{'d': departure_scheduled, 'o': pos_orderkey,
                              'l': pos_linenumber, 'p': pos_partkey, 's': pos_suppkey}})
         AS first_departing_airline,
       {sql_usd('min(cents)')} AS min_price_usd,
       {sql_avg('sum(cents)', 'count(price_usd)')} AS avg_price_usd,
       {sql_usd('max(cents)')} AS max_price_usd,
       CAST(count_if(is_anomaly) AS INTEGER) AS anomaly_count,
       TIMESTAMP '{RUN_TS}' AS loaded_at
FROM scored_s WHERE arrival_iata IS NOT NULL AND airline_iata IS NOT NULL
GROUP BY route_id, departure_iata, arrival_iata, flight_date""")
def route_stats(spark, sf_dir):
    """Per route and day -- exact distinct carriers, cheapest
    carrier by price (arg-min), first departing carrier, prices, anomalies."""
    return stats(spark, sf_dir)


@register("route_carriers_estimate", with_(sql_schedule()) + """
SELECT route_id, count(DISTINCT airline_iata) AS distinct_estimate FROM sched GROUP BY route_id""")
def route_carriers_estimate(spark, sf_dir):
    """Carriers per route from day sketches that are stored once and
    unioned (16 carriers at most, where a sketch is exact)."""
    rows = schedule(spark, sf_dir).select("route_id", "flight_date", "airline_iata")
    return distinct_estimate(store(distinct_sketches(rows, ["route_id", "flight_date"], "airline_iata"), "sketches"), ["route_id"])


@register("hourly_route_summary", with_(*_CTES) + "SELECT * FROM hrs")
def hourly_route_summary(spark, sf_dir):
    """The refreshing six-key route summary."""
    return hourly(spark, sf_dir)


@register("semantic_avg_by_route_season", with_(*_CTES) + f"""
SELECT route_id, season,
       {sql_avg('sum(CAST(round(avg_price * 100) AS BIGINT))', 'count(avg_price)')} AS avg_price,
       min(min_price) AS min_price, max(max_price) AS max_price,
       max(airline_count) AS airline_count, sum(total_anomalies) AS total_anomalies
FROM hrs GROUP BY route_id, season""")
def semantic_avg_by_route_season(spark, sf_dir):
    """Metrics x dimensions through the semantic model (default
    aggregations avg/min/max/max/sum)."""
    return semantic_query(hourly(spark, sf_dir), MODEL["hourly_route_summary"],
                          ["avg_price", "min_price", "max_price", "airline_count",
                           "total_anomalies"], ["route_id", "season"])


@register("semantic_cheapest_routes", with_(*_CTES) + f"""
SELECT route_id, season,
       {sql_avg('sum(CAST(round(avg_price * 100) AS BIGINT))', 'count(avg_price)')} AS avg_price
FROM hrs GROUP BY route_id, season ORDER BY avg_price, route_id, season LIMIT 10""")
def semantic_cheapest_routes(spark, sf_dir):
    """The semantic view's sample report -- cheapest 10 (route,
    season) pairs by average price."""
    return semantic_query(hourly(spark, sf_dir), MODEL["hourly_route_summary"], ["avg_price"],
                          ["route_id", "season"],
                          order=[("avg_price", False), ("route_id", False), ("season", False)],
                          limit=10)


@register("semantic_route_stats_total", with_(*_CTES) + f"""
SELECT min(min_price_usd) AS min_price_usd,
       {sql_avg('sum(CAST(round(avg_price_usd * 100) AS BIGINT))', 'count(avg_price_usd)')}
         AS avg_price_usd,
       max(airline_count) AS airline_count
FROM (SELECT route_id, flight_date,
        {sql_usd('min(cents)')} AS min_price_usd,
        {sql_avg('sum(cents)', 'count(price_usd)')} AS avg_price_usd,
        CAST(count(DISTINCT airline_iata) AS INTEGER) AS airline_count
      FROM scored_s WHERE arrival_iata IS NOT NULL AND airline_iata IS NOT NULL
      GROUP BY route_id, departure_iata, arrival_iata, flight_date) t""")
def semantic_route_stats_total(spark, sf_dir):
    """A metrics-only query (no dimensions -> one row) over the second
    semantic table."""
    return semantic_query(stats(spark, sf_dir), MODEL["route_stats"],
                          ["min_price_usd", "avg_price_usd", "airline_count"])


@register("intl_vs_domestic", with_(*_CTES) + f"""
SELECT CASE WHEN destination IN ({_q(INTERNATIONAL_AIRPORTS)}) THEN 'International'
            ELSE 'Domestic' END AS route_type,
       {sql_avg('sum(CAST(round(avg_price * 100) AS BIGINT))', 'count(avg_price)')} AS avg_price,
       count(DISTINCT route_id) AS route_count
FROM hrs GROUP BY 1""")
def intl_vs_domestic(spark, sf_dir):
    """Group by a derived CASE key."""
    h = hourly(spark, sf_dir)
    return h.groupBy(route_type(F.col("destination")).alias("route_type")).agg(
        avg_usd(F.sum(to_cents(F.col("avg_price"))), F.count("avg_price")).alias("avg_price"),
        F.countDistinct("route_id").alias("route_count"))


@register("weekend_vs_weekday", with_(*_CTES) + f"""
SELECT is_weekend,
       {sql_avg('sum(CAST(round(avg_price * 100) AS BIGINT))', 'count(avg_price)')} AS avg_price,
       count(*) AS data_points
FROM hrs GROUP BY is_weekend""")
def weekend_vs_weekday(spark, sf_dir):
    """Group by a boolean."""
    return hourly(spark, sf_dir).groupBy("is_weekend").agg(
        avg_usd(F.sum(to_cents(F.col("avg_price"))), F.count("avg_price")).alias("avg_price"),
        F.count(F.lit(1)).alias("data_points"))


@register("most_competitive", with_(*_CTES) + """
SELECT route_id, max(airline_count) AS airlines FROM hrs
GROUP BY route_id ORDER BY airlines DESC, route_id LIMIT 10""")
def most_competitive(spark, sf_dir):
    """Max per key, top 10 (ties by route)."""
    return (hourly(spark, sf_dir).groupBy("route_id").agg(F.max("airline_count").alias("airlines"))
            .orderBy(F.col("airlines").desc(), "route_id").limit(10))


@register("price_range", with_(*_CTES) + f"""
SELECT destination, {sql_usd('CAST(round(min(min_price) * 100) AS BIGINT)')} AS cheapest,
       {sql_avg('sum(CAST(round(avg_price * 100) AS BIGINT))', 'count(avg_price)')} AS typical,
       {sql_usd('CAST(round(max(max_price) * 100) AS BIGINT)')} AS most_expensive
FROM hrs GROUP BY destination ORDER BY typical DESC, destination""")
def price_range(spark, sf_dir):
    """Min / avg / max spread per destination, fully sorted."""
    h = hourly(spark, sf_dir)
    return h.groupBy("destination").agg(
        cents_to_usd(to_cents(F.min("min_price"))).alias("cheapest"),
        avg_usd(F.sum(to_cents(F.col("avg_price"))), F.count("avg_price")).alias("typical"),
        cents_to_usd(to_cents(F.max("max_price"))).alias("most_expensive"),
    ).orderBy(F.col("typical").desc(), "destination")


def month_of(date):
    return F.lit(None if date is None else date[:7])


@register("cheapest_today", with_(*_CTES) + """
SELECT route_id, avg_price, min_price, airline_count FROM hrs
WHERE date = (SELECT max(date) FROM hrs)
ORDER BY avg_price, route_id LIMIT 10""")
def cheapest_today(spark, sf_dir):
    """Cheapest routes on the serving date (the newest one), top
    10, from the stored summary: only the newest month's folder is read."""
    path = scratch_dir(spark, "hourly_route_summary")
    month = F.substring("date", 1, 7)
    refresh_if_stale(spark, lambda: hourly(spark, sf_dir).withColumn("month", month), path, 3600, RUN_TS, partition_by="month")
    h = spark.read.schema(HOURLY_SCHEMA).parquet(path)
    today = h.agg(F.max("date")).first()[0]
    return (h.filter((F.col("date") == F.lit(today)) & (F.col("month") == month_of(today))).orderBy("avg_price", "route_id").limit(10)
            .select("route_id", "avg_price", "min_price", "airline_count"))


# three loads of the summary: the days up to LOAD_CUT, those after, and last the weekends of one month
LOAD_CUT, HELD_MONTH = "1996-01-01", "1995-03"
LOADS = ["1999-01-01 01:00:00", "1999-01-01 02:00:00", "1999-01-01 03:00:00"]
SQL_LOADS = f"""loads AS (SELECT * REPLACE (CASE WHEN is_weekend AND date[:7] = '{HELD_MONTH}' THEN TIMESTAMP '{LOADS[2]}'
  WHEN date > '{LOAD_CUT}' THEN TIMESTAMP '{LOADS[1]}' ELSE TIMESTAMP '{LOADS[0]}' END AS loaded_at) FROM fps)"""


def refreshed(spark, sf_dir, path):
    """The summary loaded in three parts, the route summary refreshed after
    each; returns the number of months rebuilt each time."""
    source, marks = f"{path}-source", f"{path}-marks"
    rows = store(summary(spark, sf_dir).withColumn("month", F.substring("date", 1, 7)), "summary")
    held = F.col("is_weekend") & (F.col("month") == HELD_MONTH)
    late = F.col("date") > LOAD_CUT
    rebuilt = []
    for part, at in zip((~held & ~late, ~held & late, held), LOADS, strict=True):
        append(rows.filter(part).withColumn("loaded_at", F.to_timestamp(F.lit(at))), source, "month")
        rebuilt.append(refresh_changed(spark, spark.read.schema(rows.schema).parquet(source),
                                       lambda r: route_summary(r).withColumn("month", F.substring("date", 1, 7)), path, "month", marks, "hourly", at))
    return rebuilt


@register("hourly_refresh_incremental", with_(*_CTES[:-1], SQL_LOADS, SQL_HRS.replace("FROM fps", "FROM loads")) + "SELECT * FROM hrs")
def hourly_refresh_incremental(spark, sf_dir):
    """The route summary kept up by three refreshes, each of which
    rebuilds only the months that got rows; equal to a full rebuild."""
    path = scratch_dir(spark, "hourly")
    refreshed(spark, sf_dir, path)
    return read_live(spark, path, columns(HOURLY_SCHEMA), "month").drop("month")


@register("top_anomaly_routes", with_(*_CTES) + """
SELECT route_id, date, total_anomalies FROM hrs WHERE total_anomalies > 0
ORDER BY total_anomalies DESC, route_id, date LIMIT 10""")
def top_anomaly_routes(spark, sf_dir):
    """Routes and days with anomalies, most first."""
    return (hourly(spark, sf_dir).filter("total_anomalies > 0")
            .orderBy(F.col("total_anomalies").desc(), "route_id", "date").limit(10)
            .select("route_id", "date", "total_anomalies"))


@register("summer_weekend_routes", with_(*_CTES) + f"""
SELECT route_id,
       {sql_avg('sum(CAST(round(avg_price * 100) AS BIGINT))', 'count(avg_price)')} AS avg_price,
       count(*) AS days
FROM hrs WHERE season = 'Summer' AND is_weekend GROUP BY route_id
ORDER BY avg_price, route_id""")
def summer_weekend_routes(spark, sf_dir):
    """Filtered dimensional average -- summer weekends by route."""
    h = hourly(spark, sf_dir).filter((F.col("season") == "Summer") & F.col("is_weekend"))
    return h.groupBy("route_id").agg(
        avg_usd(F.sum(to_cents(F.col("avg_price"))), F.count("avg_price")).alias("avg_price"),
        F.count(F.lit(1)).alias("days")).orderBy("avg_price", "route_id")
