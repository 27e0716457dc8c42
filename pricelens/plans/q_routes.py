"""Route refresh and schedule-document queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pricelens.functions.lookups import INTERNATIONAL_AIRPORTS, route_type
from pricelens.functions.timefn import local_to_utc
from pricelens.operators.dedup import first_per_key, semi_join, top_keys
from pricelens.plans.catalog import register, schedule, sql_schedule, with_
from pricelens.sources.documents import (SCHEDULE_PATHS, project_text_documents,
                                         schedule_document)
from pricelens.sources.tables import read_table
from pricelens.sources.views import SCHEDULE_POSITION

POS_SQL = "{'o': pos_orderkey, 'l': pos_linenumber, 'p': pos_partkey, 's': pos_suppkey}"
TOP_N = 20
ACTIVE_AT = "1999-01-01 00:00:00"   # run time of the not-yet-departed filter
ZONE = "America/Chicago"


def _q(xs):
    return ", ".join(f"'{x}'" for x in xs)


def documents(spark, sf_dir):
    """Schedule rows encoded as nested JSON documents, plus an extra key
    (``position``) that the typed schedule schema does not know."""
    s = schedule(spark, sf_dir)
    pos = F.struct(*[F.col(c) for c in SCHEDULE_POSITION])
    return s.select(schedule_document(s, {"position": pos}).alias("text"))


POS_PATHS = [(c, f"$.position.{c}", "int" if c == "pos_linenumber" else "bigint")
             for c in SCHEDULE_POSITION]


@register("json_path_project", with_(sql_schedule()) + """
SELECT flight_date, flight_status, departure_iata, arrival_iata, departure_scheduled,
       airline_name, airline_iata, flight_iata AS flight_number, flight_iata,
       CAST(NULL AS VARCHAR) AS codeshared_airline,
       pos_orderkey, pos_linenumber, pos_partkey, pos_suppkey
FROM sched""")
def json_path_project(spark, sf_dir):
    """Typed projection of nested document paths (three
    levels deep); the unknown ``position`` key is still reachable."""
    out = project_text_documents(documents(spark, sf_dir), paths=SCHEDULE_PATHS + POS_PATHS)
    return out.select("flight_date", "flight_status", "departure_iata", "arrival_iata",
                      "departure_scheduled", "airline_name", "airline_iata", "flight_number",
                      "flight_iata", "codeshared_airline", *SCHEDULE_POSITION)


def _valid(d):
    req = ["departure_iata", "arrival_iata", "airline_iata", "airline_name", "flight_iata",
           "departure_scheduled"]
    cond = F.lit(True)
    for c in req:
        cond = cond & (F.coalesce(F.col(c).cast("string"), F.lit("")) != F.lit(""))
    return d.filter(cond)


@register("valid_flights", with_(sql_schedule()) + """
SELECT route_id, pos_orderkey, pos_linenumber, pos_partkey, pos_suppkey FROM sched
WHERE coalesce(departure_iata, '') <> '' AND coalesce(arrival_iata, '') <> ''
  AND coalesce(airline_iata, '') <> '' AND coalesce(airline_name, '') <> ''
  AND coalesce(flight_iata, '') <> '' AND departure_scheduled IS NOT NULL""")
def valid_flights(spark, sf_dir):
    """Documents whose six critical nested fields are all present and
    non-empty."""
    d = project_text_documents(documents(spark, sf_dir), paths=[
        ("departure_iata", "$.departure.iata", "string"),
        ("arrival_iata", "$.arrival.iata", "string"),
        ("airline_iata", "$.airline.iata", "string"),
        ("airline_name", "$.airline.name", "string"),
        ("flight_iata", "$.flight.iata", "string"),
        ("departure_scheduled", "$.departure.scheduled", "string")] + POS_PATHS)
    v = _valid(d)
    return v.select(F.concat(F.col("departure_iata"), F.lit("-"), F.col("arrival_iata"))
                    .alias("route_id"), *SCHEDULE_POSITION)


SQL_TOP = f"""top AS (SELECT route_id, count(*) AS frequency, min({POS_SQL}) AS first_pos
  FROM sched GROUP BY route_id ORDER BY frequency DESC, first_pos LIMIT {TOP_N})"""


@register("route_frequency_top20", with_(sql_schedule(), SQL_TOP) +
          "SELECT route_id, frequency FROM top")
def route_frequency_top20(spark, sf_dir):
    """The 20 most frequent routes, ties by first occurrence."""
    return top_keys(schedule(spark, sf_dir), "route_id", SCHEDULE_POSITION, TOP_N)


@register("semi_top_routes", with_(sql_schedule(), SQL_TOP) + """
SELECT route_id, pos_orderkey, pos_linenumber, pos_partkey, pos_suppkey FROM sched
WHERE route_id IN (SELECT route_id FROM top)""")
def semi_top_routes(spark, sf_dir):
    """Every scheduled flight on a top-20 route (left semi join against
    a 20-row key set)."""
    s = schedule(spark, sf_dir)
    top = top_keys(s, "route_id", SCHEDULE_POSITION, TOP_N).select("route_id")
    return semi_join(s, F.broadcast(top), "route_id").select("route_id", *SCHEDULE_POSITION)


@register("first_per_route", with_(sql_schedule(), SQL_TOP) + f"""
SELECT route_id,
  arg_min(departure_iata, {POS_SQL}) AS origin, arg_min(arrival_iata, {POS_SQL}) AS destination,
  arg_min(airline_iata, {POS_SQL}) AS airline_code, arg_min(airline_name, {POS_SQL}) AS airline_name,
  arg_min(flight_iata, {POS_SQL}) AS flight_number,
  arg_min(strftime(departure_scheduled, '%Y-%m-%dT%H:%M:%S'), {POS_SQL}) AS scheduled_departure,
  arg_min(flight_date, {POS_SQL}) AS flight_date
FROM sched WHERE route_id IN (SELECT route_id FROM top) GROUP BY route_id""")
def first_per_route(spark, sf_dir):
    """One active-route entry per top route -- its first flight in
    file order (semi join, then first per key)."""
    s = schedule(spark, sf_dir)
    top = top_keys(s, "route_id", SCHEDULE_POSITION, TOP_N).select("route_id")
    rows = semi_join(s, F.broadcast(top), "route_id").select(
        "route_id", F.col("departure_iata").alias("origin"),
        F.col("arrival_iata").alias("destination"), F.col("airline_iata").alias("airline_code"),
        "airline_name", F.col("flight_iata").alias("flight_number"),
        F.date_format("departure_scheduled", "yyyy-MM-dd'T'HH:mm:ss").alias("scheduled_departure"),
        "flight_date", *SCHEDULE_POSITION)
    return first_per_key(rows, ["route_id"], SCHEDULE_POSITION).drop(*SCHEDULE_POSITION)


@F.pandas_udf(StringType())
def classify_route(dest: pd.Series) -> pd.Series:
    """Scalar UDF form of the route classification (U3), Arrow-batched."""
    intl = set(INTERNATIONAL_AIRPORTS)
    return dest.map(lambda d: "International" if d in intl else "Domestic")


@register("classify_udf", with_(sql_schedule()) + f"""
SELECT DISTINCT route_id, arrival_iata AS destination,
  CASE WHEN arrival_iata IN ({_q(INTERNATIONAL_AIRPORTS)}) THEN 'International'
       ELSE 'Domestic' END AS route_type,
  CASE WHEN arrival_iata IN ({_q(INTERNATIONAL_AIRPORTS)}) THEN 'International'
       ELSE 'Domestic' END AS route_type_udf
FROM sched""")
def classify_udf(spark, sf_dir):
    """Route classification as a built-in CASE and as a pandas UDF
    (the UDF runs after DISTINCT, so it sees one row per route)."""
    r = schedule(spark, sf_dir).select("route_id", F.col("arrival_iata").alias("destination")) \
        .distinct()
    return r.select("route_id", "destination", route_type(F.col("destination")).alias("route_type"),
                    classify_route(F.col("destination")).alias("route_type_udf"))


@register("local_to_utc_active", f"""
SELECT o_orderkey, departure_local,
       (departure_local AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC' AS departure_utc
FROM (SELECT o_orderkey, o_orderdate + to_hours(CAST(6 + o_orderkey % 16 AS INTEGER)) AS departure_local
      FROM orders) t
WHERE (departure_local AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC' > TIMESTAMP '{ACTIVE_AT}'""")
def local_to_utc_active(spark, sf_dir):
    """Departures given as Chicago wall-clock times (order date at
    06:00-21:00), converted to UTC, kept if not yet departed at ACTIVE_AT."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    local = (F.col("o_orderdate").cast("timestamp")
             + F.make_dt_interval(hours=(F.lit(6) + F.col("o_orderkey") % 16).cast("int")))
    d = o.select("o_orderkey", local.alias("departure_local"))
    d = d.withColumn("departure_utc", local_to_utc(F.col("departure_local"), ZONE))
    return d.filter(F.col("departure_utc") > F.to_timestamp(F.lit(ACTIVE_AT)))
