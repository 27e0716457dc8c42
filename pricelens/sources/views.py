"""Domain views over the driver's tables.

* ``tick_view``: price ticks from ``events`` (one tick per event).
* ``schedule_view``: scheduled flights from ``lineitem`` joined to the order's
  customer (origin) and the supplier (carrier and destination).

Both are pure column expressions + equi-joins, so Catalyst prunes every
unused column down to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.lookups import ALLIANCES, INTERNATIONAL_AIRPORTS, route_id
from pricelens.functions.timefn import epoch_seconds

# --- fixed values of the test views ---
# Airport code of nation key k is AIRPORTS[k]: the hub, the international
# destinations of the lookups, then further US airports.
AIRPORTS = ["ORD", *INTERNATIONAL_AIRPORTS,
            "LAX", "SFO", "SEA", "DEN", "MIA", "JFK", "BOS", "ATL", "DFW", "PHX",
            "IAH", "MSP", "DTW", "CLT", "LAS"]
# Carrier code of supplier s is CARRIERS[s % 16].
CARRIERS = list(ALLIANCES) + ["AS", "SY"]
# Share of ticks delivered late: event_id % 20 == 0 -> 180..300 s late,
# == 1 -> exactly 120 s (on the strict bound), otherwise on time.
# --- end of fixed values ---

TICK_COLUMNS = ["event_id", "flight_number", "route_id", "origin", "destination",
                "airline_code", "airline_name", "price_usd", "flight_date",
                "event_timestamp", "ingestion_timestamp"]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def tick_view(events: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    ev = epoch_seconds(F.col("ts"))
    eid = F.col("event_id")
    delay = (F.when(eid % 20 == 0, F.lit(180) + eid % 121)
             .when(eid % 20 == 1, F.lit(120))
             .otherwise(F.lit(0)))
    dest = (uid % 20).cast("string")
    return events.select(
        eid.alias("event_id"),
        F.concat(F.lit("F"), uid.cast("string")).alias("flight_number"),
        route_id(F.lit("ORD"), dest).alias("route_id"),
        F.lit("ORD").alias("origin"),
        dest.alias("destination"),
        F.concat(F.lit("A"), (uid % 5).cast("string")).alias("airline_code"),
        F.concat(F.lit("Airline "), (uid % 5).cast("string")).alias("airline_name"),
        F.col("value").alias("price_usd"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("flight_date"),
        ev.alias("event_timestamp"),
        (ev + delay).alias("ingestion_timestamp"),
    )


SCHEDULE_POSITION = ["pos_orderkey", "pos_linenumber", "pos_partkey", "pos_suppkey"]


def schedule_view(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                  supplier: DataFrame) -> DataFrame:
    """One scheduled flight per line item.

    lineitem x orders is the large join (shuffle on the order key); customer
    is joined to orders first, so that line items are not shuffled once more
    by customer, and supplier on its key.  Both are left to the planner, which
    broadcasts them only when their measured size is under the threshold.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_extendedprice", "l_linestatus", "l_shipdate")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = li.join(o.join(c, "o_custkey"), "l_orderkey").join(s, "l_suppkey")
    code = _pick(CARRIERS, F.col("l_suppkey") % 16)
    origin = _pick(AIRPORTS, F.col("c_nationkey"))
    dest = _pick(AIRPORTS, F.col("s_nationkey"))
    return j.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("flight_date"),
        F.when(F.col("l_linestatus") == "F", F.lit("landed"))
         .otherwise(F.lit("scheduled")).alias("flight_status"),
        origin.alias("departure_iata"),
        dest.alias("arrival_iata"),
        F.col("l_shipdate").cast("timestamp").alias("departure_scheduled"),
        F.concat(F.lit("Carrier "), code).alias("airline_name"),
        code.alias("airline_iata"),
        F.concat(code, F.col("l_suppkey").cast("string")).alias("flight_iata"),
        F.col("l_extendedprice").alias("price_usd"),
        F.col("l_orderkey").alias("pos_orderkey"),
        F.col("l_linenumber").alias("pos_linenumber"),
        F.col("l_partkey").alias("pos_partkey"),
        F.col("l_suppkey").alias("pos_suppkey"),
    ).withColumn("route_id", route_id(F.col("departure_iata"), F.col("arrival_iata")))


def position(prefix: str = "pos_") -> Column:
    """Unique, totally ordered position of a schedule row (file order)."""
    return F.struct(*[F.col(c) for c in SCHEDULE_POSITION])
