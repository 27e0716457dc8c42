"""Silver layer built in batch from ticks (the streaming job's tables, P1).

``silver_5min``  tumbling 5-minute windows of on-time ticks per key,
``silver_1hr``   sliding 1-hour / 15-minute windows of on-time ticks,
``late_table``   the late side output.
``processing_timestamp`` of a window row is its last tick's ingestion time;
``priced_count`` its ticks that carry a price, which late corrections need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.timefn import instant
from pricelens.operators.late import late_rows, split_late
from pricelens.operators.windows import sliding_agg, window_agg

ATTRS_5MIN = ["flight_number", "route_id", "origin", "destination", "airline_code",
              "airline_name"]
ATTRS_1HR = ["flight_number", "route_id", "origin", "destination", "airline_code"]
TICK_ORDER = ["event_timestamp", "event_id"]


def _silver(ticks: DataFrame, keys, width, attrs) -> DataFrame:
    """One row per (keys, window) at any grain; the attributes are those of
    the window's earliest tick."""
    on_time, _ = split_late(ticks)
    agg = window_agg(on_time, keys, "event_timestamp", "price_usd", width,
                     attrs=[a for a in attrs if a not in keys], order_cols=TICK_ORDER,
                     extra={"_proc": F.max("ingestion_timestamp")},
                     priced=True)
    return agg.withColumn("processing_timestamp", instant(F.col("_proc"))).drop("_proc")


def silver_5min(ticks: DataFrame, keys: list[str] | None = None,
                width: str = "5 minutes") -> DataFrame:
    return _silver(ticks, keys or ["flight_number"], width, ATTRS_5MIN)


def silver_1hr(ticks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["flight_number"]
    on_time, _ = split_late(ticks)
    windows = sliding_agg(on_time, keys, "event_timestamp", "price_usd", 3600, 900, [a for a in ATTRS_1HR if a not in keys],
                          TICK_ORDER, latest={"_proc": "ingestion_timestamp"})
    return windows.withColumn("processing_timestamp", instant(F.col("_proc"))).drop("_proc")


def late_table(ticks: DataFrame) -> DataFrame:
    _, late = split_late(ticks)
    return late_rows(late)
