"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver's tables and returns
a DataFrame over the whole tables.  Output timestamps are ``timestamp_ntz``
(UTC wall clock) so they compare equal to the oracle's naive timestamps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from pricelens.session import ensure_utc
from pricelens.sources.tables import read_table
from pricelens.sources.views import schedule_view, tick_view

Builder = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return ntz_out(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run
    return deco


def ntz_out(df: DataFrame) -> DataFrame:
    """Cast instant columns to UTC wall-clock ``timestamp_ntz``."""
    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # importing the query modules registers them
    from pricelens.plans import (q_ticks, q_star, q_dq, q_routes, q_serving,  # noqa: F401
                                 q_load, q_monitoring, q_streams, q_tables)


# --------------------------------------------------------------------- inputs
def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_view(read_table(spark, sf_dir, "events"))


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read_table(spark, sf_dir, n)
    return schedule_view(t("lineitem"), t("orders"), t("customer"), t("supplier"))


# ------------------------------------------------------------- oracle pieces
# DuckDB equivalents of the views and operators, shared by the oracle SQL.
SQL_TICKS = """ticks AS (
  SELECT event_id,
         'F' || CAST(user_id AS VARCHAR) AS flight_number,
         'ORD-' || CAST(user_id % 20 AS VARCHAR) AS route_id,
         'ORD' AS origin,
         CAST(user_id % 20 AS VARCHAR) AS destination,
         'A' || CAST(user_id % 5 AS VARCHAR) AS airline_code,
         'Airline ' || CAST(user_id % 5 AS VARCHAR) AS airline_name,
         value AS price_usd,
         strftime(ts, '%Y-%m-%d') AS flight_date,
         CAST(floor(epoch(ts)) AS BIGINT) AS event_timestamp,
         CAST(floor(epoch(ts)) AS BIGINT)
           + CASE WHEN event_id % 20 = 0 THEN 180 + event_id % 121
                  WHEN event_id % 20 = 1 THEN 120 ELSE 0 END AS ingestion_timestamp,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events)"""

SQL_ON_TIME = "on_time AS (SELECT * FROM ticks WHERE ingestion_timestamp - event_timestamp <= 120)"
SQL_LATE = "late AS (SELECT * FROM ticks WHERE ingestion_timestamp - event_timestamp > 120)"


def sql_ts(epoch_expr: str) -> str:
    return f"make_timestamp(CAST({epoch_expr} AS BIGINT) * 1000000)"


def sql_avg(sum_expr: str, n_expr: str) -> str:
    return f"CAST(floor((2 * ({sum_expr}) + ({n_expr})) / (2 * ({n_expr}))) AS DOUBLE) / 100"


def sql_usd(cents_expr: str) -> str:
    return f"CAST({cents_expr} AS DOUBLE) / 100"





def sql_schedule() -> str:
    from pricelens.sources.views import AIRPORTS, CARRIERS
    ap = "[" + ", ".join(f"'{a}'" for a in AIRPORTS) + "]"
    cr = "[" + ", ".join(f"'{c}'" for c in CARRIERS) + "]"
    return f"""sched0 AS (
  SELECT strftime(l.l_shipdate, '%Y-%m-%d') AS flight_date,
         CASE WHEN l.l_linestatus = 'F' THEN 'landed' ELSE 'scheduled' END AS flight_status,
         ({ap})[c.c_nationkey + 1] AS departure_iata,
         ({ap})[s.s_nationkey + 1] AS arrival_iata,
         CAST(l.l_shipdate AS TIMESTAMP) AS departure_scheduled,
         'Carrier ' || ({cr})[l.l_suppkey % 16 + 1] AS airline_name,
         ({cr})[l.l_suppkey % 16 + 1] AS airline_iata,
         ({cr})[l.l_suppkey % 16 + 1] || CAST(l.l_suppkey AS VARCHAR) AS flight_iata,
         l.l_extendedprice AS price_usd,
         l.l_orderkey AS pos_orderkey, l.l_linenumber AS pos_linenumber,
         l.l_partkey AS pos_partkey, l.l_suppkey AS pos_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey),
sched AS (SELECT *, departure_iata || '-' || arrival_iata AS route_id,
                 CAST(round(price_usd * 100) AS BIGINT) AS cents FROM sched0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
