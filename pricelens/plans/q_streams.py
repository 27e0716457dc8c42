"""Streaming queries, run to completion with ``availableNow`` over tick
messages that Spark writes from ``events``; each result equals the batch
aggregate of the same ticks (stream/batch equivalence)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pricelens.operators.dedup import keep_best
from pricelens.plans.catalog import SQL_LATE, SQL_ON_TIME, SQL_TICKS, register, sql_ts, ticks, with_
from pricelens.plans.q_ticks import SQL_SILVER_1HR, SQL_SILVER_5MIN, _sql_windows
from pricelens.session import scratch_dir
from pricelens.streaming.accounted import late_by_window, read_routed, read_windows, start_accounted
from pricelens.streaming.ticks import (await_all, files_per_slice, start_dedup, start_file_pipe,
                                       read_upserted, start_tick_queries, start_upsert, write_messages,
                                       write_slices)

COLS_5MIN = ["flight_number", "route_id", "origin", "destination", "airline_code",
             "airline_name", "window_start", "window_end", "avg_price_usd", "min_price_usd",
             "max_price_usd", "message_count", "sum_cents"]
COLS_1HR = ["flight_number", "route_id", "origin", "destination", "airline_code",
            "window_start", "window_end", "avg_price_usd", "message_count", "sum_cents"]
COLS_LATE = ["route_id", "flight_number", "origin", "destination", "airline_code",
             "price_usd", "flight_date", "event_timestamp", "ingestion_timestamp",
             "lateness_seconds"]
COLS_TICK = ["route_id", "origin", "destination", "airline_code", "airline_name",
             "flight_number", "price_usd", "flight_date", "event_timestamp",
             "ingestion_timestamp"]


def _messages(spark, sf_dir, copies: int = 1) -> str:
    src = scratch_dir(spark, "ticks-src")
    write_messages(ticks(spark, sf_dir), src, copies=copies)
    return src


def _silver_stream(spark, sf_dir) -> str:
    """Run the three-branch tick stream over the table's messages."""
    src = _messages(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "silver"), scratch_dir(spark, "silver-ckpt")
    await_all(start_tick_queries(spark, src, out, ckpt))
    return out


def _final_panes(df, cols):
    best = keep_best(df, ["flight_number", "window_start"],
                     [("message_count", True), ("processing_timestamp", True), ("batch_id", True)])
    return best.select(*cols)


def _sel(cte: str, cols: list[str]) -> str:
    return f"SELECT {', '.join(cols)} FROM {cte}"


@register("stream_fixed_5min", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN) +
          _sel("silver5", COLS_5MIN))
def stream_fixed_5min(spark, sf_dir):
    """Event-time tumbling windows in update mode;
    the final pane per window (F1) equals the batch window aggregate."""
    out = _silver_stream(spark, sf_dir)
    return _final_panes(spark.read.parquet(os.path.join(out, "price_5min")), COLS_5MIN)


@register("stream_sliding_1h", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_1HR) +
          _sel("silver1h", COLS_1HR))
def stream_sliding_1h(spark, sf_dir):
    """The sliding branch of the same source."""
    out = _silver_stream(spark, sf_dir)
    return _final_panes(spark.read.parquet(os.path.join(out, "price_1hr")), COLS_1HR)


@register("stream_late", with_(SQL_TICKS, SQL_LATE) + f"""
SELECT route_id, flight_number, origin, destination, airline_code, price_usd, flight_date,
       {sql_ts('event_timestamp')} AS event_timestamp,
       {sql_ts('ingestion_timestamp')} AS ingestion_timestamp,
       CAST(ingestion_timestamp - event_timestamp AS BIGINT) AS lateness_seconds
FROM late""")
def stream_late(spark, sf_dir):
    """The late side-output branch (append mode)."""
    out = _silver_stream(spark, sf_dir)
    return spark.read.parquet(os.path.join(out, "late_arrivals")).select(*COLS_LATE)


@register("stream_upsert", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN) +
          _sel("silver5", COLS_5MIN))
def stream_upsert(spark, sf_dir):
    """Micro-batch upsert (keep the better pane) into a parquet
    table partitioned by window date."""
    src = _messages(spark, sf_dir)
    target, ckpt = scratch_dir(spark, "upsert"), scratch_dir(spark, "upsert-ckpt")
    await_all(start_upsert(spark, src, target, ckpt))
    return read_upserted(spark, target).select(*COLS_5MIN)


@register("stream_file_pipe", with_(SQL_TICKS) + f"""
SELECT route_id, origin, destination, airline_code, airline_name, flight_number, price_usd,
       flight_date, event_timestamp, ingestion_timestamp FROM ticks""")
def stream_file_pipe(spark, sf_dir):
    """Each file loaded once -- a second REFRESH over the same folder adds
    nothing."""
    src = _messages(spark, sf_dir)
    table, ckpt = scratch_dir(spark, "pipe"), scratch_dir(spark, "pipe-ckpt")
    await_all(start_file_pipe(spark, src, table, ckpt))
    await_all(start_file_pipe(spark, src, table, ckpt))
    return spark.read.parquet(table).select(*COLS_TICK)


@register("stream_dedup", with_(SQL_TICKS) + """
SELECT DISTINCT flight_number, event_timestamp FROM ticks""")
def stream_dedup(spark, sf_dir):
    """Every message delivered twice; within-watermark dedup on
    (flight_number, event_timestamp) keeps one."""
    src = _messages(spark, sf_dir, copies=2)
    table, ckpt = scratch_dir(spark, "dedup"), scratch_dir(spark, "dedup-ckpt")
    await_all(start_dedup(spark, src, table, ckpt))
    return spark.read.parquet(table).select("flight_number", "event_timestamp")


def _cuts(t, n: int) -> list[int]:
    """n - 1 instants off the window grid that cut the table's time span evenly."""
    lo, hi = t.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    return [] if lo is None else [lo + (hi - lo) * k // n // 300 * 300 + 150 for k in range(1, n)]


@register("stream_multi_batch", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN) +
          _sel("silver5", COLS_5MIN))
def stream_multi_batch(spark, sf_dir):
    """Five micro-batches in event-time order, cut inside windows,
    so panes fire again and accumulate; the final panes are the batch result."""
    t = ticks(spark, sf_dir)
    src, out, ckpt = (scratch_dir(spark, n) for n in ("slices", "silver", "silver-ckpt"))
    cuts = _cuts(t, 5)
    files = files_per_slice(t, cuts)
    write_slices(t, src, cuts, files)
    await_all(start_tick_queries(spark, src, out, ckpt, max_files=files))
    return _final_panes(spark.read.parquet(os.path.join(out, "price_5min")), COLS_5MIN)


@register("stream_upsert_multi_batch", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN) +
          _sel("silver5", COLS_5MIN))
def stream_upsert_multi_batch(spark, sf_dir):
    """The upsert over several micro-batches; a window's later pane
    replaces its earlier one."""
    t = ticks(spark, sf_dir)
    src, target, ckpt = (scratch_dir(spark, n) for n in ("slices", "upsert", "upsert-ckpt"))
    cuts = _cuts(t, 4)
    files = files_per_slice(t, cuts)
    write_slices(t, src, cuts, files)
    await_all(start_upsert(spark, src, target, ckpt, max_files=files))
    return read_upserted(spark, target).select(*COLS_5MIN)


# Delivery in four parts: by event time, but every ninth tick comes with the last part.
PARTS = 4
SQL_PARTS = f"""span AS (SELECT min(event_timestamp) AS lo, max(event_timestamp) - min(event_timestamp) AS width FROM ticks),
parts AS (SELECT t.*, CASE WHEN event_id % 9 = 0 THEN {PARTS - 1}
  ELSE least({PARTS - 1}, ({PARTS} * (event_timestamp - lo)) // (width + 1)) END AS part FROM ticks t, span),
tops AS (SELECT part, max(event_timestamp) AS top FROM parts GROUP BY part),
routed AS (SELECT p.*, CASE WHEN ingestion_timestamp - event_timestamp > 120 THEN 'late'
  WHEN event_timestamp - event_timestamp % 300 + 300 <= (SELECT max(top) FROM tops WHERE tops.part < p.part) - 120 THEN 'dropped'
  ELSE 'on_time' END AS route FROM parts p)"""


def _accounted(spark, sf_dir, **options) -> str:
    """The accounted stream over the table's messages, one run a part; the
    last run is started again and finds nothing new."""
    t = ticks(spark, sf_dir)
    lo, hi = t.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    src, out, ckpt = (scratch_dir(spark, n) for n in ("parts", "accounted", "accounted-ckpt"))
    if lo is not None:
        place = F.floor(F.lit(PARTS) * (F.col("event_timestamp") - lo) / F.lit(hi - lo + 1))
        t = t.withColumn("part", F.when(F.col("event_id") % 9 == 0, PARTS - 1).otherwise(F.least(place, F.lit(PARTS - 1))))
        for part in range(PARTS):
            write_messages(t.where(F.col("part") == part), src)
            await_all(start_accounted(spark, src, out, ckpt, **options))
        await_all(start_accounted(spark, src, out, ckpt, **options))
    return out


@register("stream_catch_up", with_(SQL_TICKS, SQL_PARTS) + f"""
SELECT w.*, l.late_count FROM ({_sql_windows("ticks", ["flight_number"], [], 300, proc=False)}) w
JOIN (SELECT flight_number, {sql_ts("event_timestamp - event_timestamp % 300")} AS window_start,
             count(*) FILTER (route != 'on_time') AS late_count FROM routed GROUP BY ALL) l USING (flight_number, window_start)""")
def stream_catch_up(spark, sf_dir):
    """Late ticks correct the stored windows as they arrive; every
    micro-batch's sums are added once, so the windows equal the batch
    aggregate over all ticks."""
    cols = [c for c in COLS_5MIN if c not in ("route_id", "origin", "destination", "airline_code", "airline_name")]
    return read_windows(spark, _accounted(spark, sf_dir, catch_up=True)).select(*cols, "late_count")


@register("stream_routes", with_(SQL_TICKS, SQL_PARTS) + """
SELECT flight_number, event_timestamp, ingestion_timestamp, price_usd, route FROM routed""")
def stream_routes(spark, sf_dir):
    """Every tick of an out-of-order delivery, kept with its route:
    on time, late, or past its window's end at the watermark."""
    return read_routed(spark, _accounted(spark, sf_dir)).select("flight_number", "event_timestamp", "ingestion_timestamp", "price_usd", "route")


@register("stream_late_by_window", with_(SQL_TICKS, SQL_PARTS) + f"""
SELECT flight_number, {sql_ts("event_timestamp - event_timestamp % 300")} AS window_start, route, count(*) AS n_ticks,
       max(ingestion_timestamp - event_timestamp) AS most_late_s
FROM routed WHERE route != 'on_time' GROUP BY ALL""")
def stream_late_by_window(spark, sf_dir):
    """The ticks that missed each window, by route."""
    return late_by_window(spark, _accounted(spark, sf_dir))
