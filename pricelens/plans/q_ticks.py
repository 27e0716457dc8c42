"""Tick queries: windows, late data, dedup, anomaly scoring, JSON ingress."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pricelens.functions.money import safe_ratio
from pricelens.functions.timefn import instant
from pricelens.operators.anomaly import (asof_baseline, baseline_stats, rolling_zscore,
                                         zscore)
from pricelens.operators.dedup import keep_best
from pricelens.operators.late import late_report, reconcile, split_late
from pricelens.operators.windows import window_agg
from pricelens.plans.catalog import (SQL_LATE, SQL_ON_TIME, SQL_TICKS, register, sql_avg,
                                     sql_ts, sql_usd, ticks, with_)
from pricelens.plans.silver import TICK_ORDER, late_table, silver_1hr, silver_5min
from pricelens.session import scratch_dir, store
from pricelens.sources.events import parse_events, tag_events
from pricelens.sources.message_schema import read_message_schema
from pricelens.sources.tables import read_table
from pricelens.sources.views import TICK_COLUMNS

WINDOW_COLS = ["window_start", "window_end", "avg_price_usd", "min_price_usd",
               "max_price_usd", "message_count", "sum_cents"]


def _sql_windows(src: str, keys: list[str], attrs: list[str], width: int,
                 proc: bool = True, minmax: bool = True) -> str:
    k = ", ".join(keys)
    a = "".join(f"arg_min({c}, {{'t': event_timestamp, 'i': event_id}}) AS {c}, " for c in attrs)
    mm = (f"{sql_usd('min(cents)')} AS min_price_usd, {sql_usd('max(cents)')} AS max_price_usd, "
          if minmax else "")
    pr = f", {sql_ts('max(ingestion_timestamp)')} AS processing_timestamp, count(cents) AS priced_count" if proc else ""
    return f"""SELECT {k}, {a}{sql_ts('ws')} AS window_start, {sql_ts(f'ws + {width}')} AS window_end,
  {sql_avg('sum(cents)', 'count(cents)')} AS avg_price_usd, {mm}
  count(*) AS message_count, CAST(sum(cents) AS BIGINT) AS sum_cents{pr}
FROM (SELECT *, event_timestamp - event_timestamp % {width} AS ws FROM {src}) w
GROUP BY {k}, ws"""


SQL_SILVER_5MIN = "silver5 AS (" + _sql_windows(
    "on_time", ["flight_number"],
    ["route_id", "origin", "destination", "airline_code", "airline_name"], 300) + ")"

SQL_SILVER_1HR = """silver1h AS (
SELECT flight_number,
  arg_min(route_id, {'t': event_timestamp, 'i': event_id}) AS route_id,
  arg_min(origin, {'t': event_timestamp, 'i': event_id}) AS origin,
  arg_min(destination, {'t': event_timestamp, 'i': event_id}) AS destination,
  arg_min(airline_code, {'t': event_timestamp, 'i': event_id}) AS airline_code,
  make_timestamp(CAST(ws AS BIGINT) * 1000000) AS window_start,
  make_timestamp(CAST(ws + 3600 AS BIGINT) * 1000000) AS window_end,
  """ + sql_avg("sum(cents)", "count(*)") + """ AS avg_price_usd,
  count(*) AS message_count, CAST(sum(cents) AS BIGINT) AS sum_cents,
  make_timestamp(CAST(max(ingestion_timestamp) AS BIGINT) * 1000000) AS processing_timestamp, count(cents) AS priced_count
FROM (SELECT t.*, event_timestamp - event_timestamp % 900 - k * 900 AS ws
      FROM on_time t, range(0, 4) r(k)) w
GROUP BY flight_number, ws)"""


# ---------------------------------------------------------------- windows
@register("tick_fixed_5min", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN) +
          "SELECT * FROM silver5")
def tick_fixed_5min(spark, sf_dir):
    """Tumbling 5-minute windows of on-time ticks per flight."""
    return silver_5min(ticks(spark, sf_dir))


@register("tick_fixed_by_route", with_(SQL_TICKS, SQL_ON_TIME) + _sql_windows(
    "on_time", ["route_id"], ["flight_number", "origin", "destination", "airline_code",
                             "airline_name"], 300))
def tick_fixed_by_route(spark, sf_dir):
    """E1 keyed by route (the reference code's grain); flight metadata from the
    route's earliest tick in each window."""
    return silver_5min(ticks(spark, sf_dir), keys=["route_id"])


@register("tick_sliding_1h", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_1HR) +
          "SELECT * FROM silver1h")
def tick_sliding_1h(spark, sf_dir):
    """1-hour windows sliding by 15 minutes (each tick in 4 windows)."""
    return silver_1hr(ticks(spark, sf_dir))


@register("tick_daily_by_carrier", with_(SQL_TICKS) + _sql_windows(
    "ticks", ["airline_code"], [], 86400, proc=False))
def tick_daily_by_carrier(spark, sf_dir):
    """E1 at a width that really aggregates: 1-day windows per carrier, all ticks."""
    return window_agg(ticks(spark, sf_dir), ["airline_code"], width="1 day")


# -------------------------------------------------------------- late data
@register("late_arrivals", with_(SQL_TICKS, SQL_LATE) + f"""
SELECT route_id, flight_number, origin, destination, airline_code, price_usd, flight_date,
       {sql_ts('event_timestamp')} AS event_timestamp,
       {sql_ts('ingestion_timestamp')} AS ingestion_timestamp,
       CAST(ingestion_timestamp - event_timestamp AS BIGINT) AS lateness_seconds,
       {sql_ts('ingestion_timestamp')} AS processing_timestamp
FROM late""")
def late_arrivals(spark, sf_dir):
    """The late side output (ingestion - event > 120 s, strict)."""
    return late_table(ticks(spark, sf_dir))


@register("late_rate", with_(SQL_TICKS, SQL_ON_TIME, SQL_LATE, SQL_SILVER_5MIN) + """,
s AS (SELECT CAST(processing_timestamp AS DATE) AS d, count(*) AS silver_rows
      FROM silver5 GROUP BY 1),
l AS (SELECT CAST(make_timestamp(ingestion_timestamp * 1000000) AS DATE) AS d,
             count(*) AS late_rows FROM late GROUP BY 1)
SELECT strftime(coalesce(s.d, l.d), '%Y-%m-%d') AS run_date,
       coalesce(s.silver_rows, 0) AS silver_rows, coalesce(l.late_rows, 0) AS late_rows,
       coalesce(CAST(coalesce(l.late_rows, 0) AS DOUBLE)
                / nullif(CAST(coalesce(s.silver_rows, 0) AS DOUBLE), 0), 0.0) AS late_rate,
       coalesce(CAST(coalesce(l.late_rows, 0) AS DOUBLE)
                / nullif(CAST(coalesce(s.silver_rows, 0) AS DOUBLE), 0), 0.0) > 0.1
         AS needs_reconcile
FROM s FULL OUTER JOIN l ON s.d = l.d""".replace("WITH ", "WITH ", 1).replace(
    "\n,\ns AS", ",\ns AS"))
def late_rate(spark, sf_dir):
    """P12 per day: late rows / silver rows (SAFE_DIVIDE, 0 when undefined),
    reconcile when above 10 % (strict).  D4's one-row cross join becomes a
    join on the day key."""
    t = ticks(spark, sf_dir)
    s = (silver_5min(t).groupBy(F.to_date("processing_timestamp").alias("d"))
         .agg(F.count(F.lit(1)).alias("silver_rows")))
    late = late_table(t)
    l_ = (late.groupBy(F.to_date("processing_timestamp").alias("d"))
          .agg(F.count(F.lit(1)).alias("late_rows")))
    j = s.join(l_, "d", "full_outer")
    sr = F.coalesce(F.col("silver_rows"), F.lit(0))
    lr = F.coalesce(F.col("late_rows"), F.lit(0))
    rate = F.coalesce(safe_ratio(lr, sr), F.lit(0.0))
    return j.select(F.date_format("d", "yyyy-MM-dd").alias("run_date"),
                    sr.alias("silver_rows"), lr.alias("late_rows"),
                    rate.alias("late_rate"), (rate > F.lit(0.1)).alias("needs_reconcile"))


@register("late_reconcile", with_(SQL_TICKS, SQL_ON_TIME, SQL_LATE, SQL_SILVER_5MIN) + f"""
SELECT l.flight_number, l.route_id, l.airline_code, l.price_usd,
       {sql_ts('l.event_timestamp')} AS event_timestamp,
       {sql_ts('l.ingestion_timestamp')} AS ingestion_timestamp,
       CAST(l.ingestion_timestamp - l.event_timestamp AS BIGINT) AS lateness_seconds,
       {sql_ts('l.event_timestamp - l.event_timestamp % 300')} AS window_start,
       EXISTS (SELECT 1 FROM silver5 s WHERE s.flight_number = l.flight_number
               AND s.window_start = {sql_ts('l.event_timestamp - l.event_timestamp % 300')})
         AS window_exists
FROM late l""")
def late_reconcile(spark, sf_dir):
    """P13 + D9: each late tick, its 5-minute window, and whether that window
    already exists in Silver."""
    t = ticks(spark, sf_dir)
    _, late = split_late(t)
    rep = late_report(late, silver_5min(t), ["flight_number"], 300)
    return rep.select("flight_number", "route_id", "airline_code", "price_usd",
                      instant(F.col("event_timestamp")).alias("event_timestamp"),
                      instant(F.col("ingestion_timestamp")).alias("ingestion_timestamp"),
                      (F.col("ingestion_timestamp") - F.col("event_timestamp"))
                      .cast("bigint").alias("lateness_seconds"),
                      "window_start", "window_exists")


@register("late_corrected", with_(SQL_TICKS) + _sql_windows(
    "ticks", ["flight_number"], [], 300, proc=False))
def late_corrected(spark, sf_dir):
    """On-time windows merged with the late ticks' windows == windows
    over all ticks."""
    t = ticks(spark, sf_dir)
    on_time, late = split_late(t)
    base = window_agg(on_time, ["flight_number"], priced=True)
    return reconcile(base, late, ["flight_number"])


@register("late_corrected_unpriced", with_(SQL_TICKS.replace("ticks AS", "every AS", 1), """ticks AS (SELECT * REPLACE (
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE cents END AS cents) FROM every)""") + _sql_windows(
    "ticks", ["flight_number"], [], 86400, proc=False))
def late_corrected_unpriced(spark, sf_dir):
    """J13 with a third of the ticks lacking a price: stored Silver days,
    corrected by the late ticks, average over the priced ticks alone."""
    t = ticks(spark, sf_dir)
    t = t.withColumn("price_usd", F.when(F.col("event_id") % 3 != 0, F.col("price_usd")))
    _, late = split_late(t)
    stored = store(silver_5min(t, width="1 day"), "silver-days")
    return reconcile(stored, late, ["flight_number"], width="1 day")


# ------------------------------------------------------------------ dedup
@register("dedup_best_pane", with_(SQL_TICKS, SQL_ON_TIME) + f""",
panes AS (
  SELECT flight_number, ws, 1 AS pane_id, count(*) AS message_count,
         CAST(sum(cents) AS BIGINT) AS sum_cents, max(ingestion_timestamp) AS proc
  FROM (SELECT *, event_timestamp - event_timestamp % 86400 AS ws FROM on_time) a
  GROUP BY flight_number, ws
  UNION ALL
  SELECT flight_number, ws, 2 AS pane_id, count(*), CAST(sum(cents) AS BIGINT),
         max(ingestion_timestamp)
  FROM (SELECT *, event_timestamp - event_timestamp % 86400 AS ws FROM ticks) b
  GROUP BY flight_number, ws),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY flight_number, ws
            ORDER BY message_count DESC, proc DESC, pane_id DESC) AS rn FROM panes)
SELECT flight_number, {sql_ts('ws')} AS window_start, pane_id, message_count,
       {sql_avg('sum_cents', 'message_count')} AS avg_price_usd,
       {sql_ts('proc')} AS processing_timestamp
FROM ranked WHERE rn = 1""".replace("\n,\npanes", ",\npanes"))
def dedup_best_pane(spark, sf_dir):
    """accumulating panes of daily windows per flight -- an early pane of
    on-time ticks and a final pane including the late ones; keep the pane
    with most messages, then the latest processing time."""
    t = ticks(spark, sf_dir)
    on_time, _ = split_late(t)
    extra = {"_proc": F.max("ingestion_timestamp")}
    p1 = window_agg(on_time, ["flight_number"], width="1 day", minmax=False, extra=extra) \
        .withColumn("pane_id", F.lit(1))
    p2 = window_agg(t, ["flight_number"], width="1 day", minmax=False, extra=extra) \
        .withColumn("pane_id", F.lit(2))
    panes = p1.unionByName(p2).withColumn("processing_timestamp", instant(F.col("_proc")))
    best = keep_best(panes, ["flight_number", "window_start"],
                     [("message_count", True), ("processing_timestamp", True), ("pane_id", True)])
    return best.select("flight_number", "window_start", "pane_id", "message_count",
                       "avg_price_usd", "processing_timestamp")


# ---------------------------------------------------------------- anomaly
def scored_windows(t):
    """Deduplicated 5-minute windows scored against each flight's
    all-history 1-hour baseline."""
    snap = keep_best(silver_5min(t), ["flight_number", "window_start"])
    base = keep_best(silver_1hr(t), ["flight_number", "window_start"])
    return zscore(snap, baseline_stats(base, "flight_number"), "flight_number")


SQL_SCORED = """stats AS (
  SELECT flight_number, avg(avg_price_usd) AS rolling_mean,
         stddev_samp(avg_price_usd) AS rolling_stddev FROM silver1h GROUP BY flight_number),
scored0 AS (
  SELECT s.*, CASE WHEN st.rolling_stddev IS NULL OR st.rolling_stddev = 0 THEN 0.0
                   ELSE abs(s.avg_price_usd - st.rolling_mean) / st.rolling_stddev END AS z
  FROM silver5 s LEFT JOIN stats st ON s.flight_number = st.flight_number),
scored AS (SELECT *, round(z, 4) AS z_score,
                  CASE WHEN avg_price_usd IS NULL THEN NULL ELSE z > 3.0 END AS is_anomaly
           FROM scored0)"""


@register("anomaly_zscore_all", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN,
                                      SQL_SILVER_1HR, SQL_SCORED) + """
SELECT flight_number, window_start, avg_price_usd, message_count, z_score, is_anomaly
FROM scored""")
def anomaly_zscore_all(spark, sf_dir):
    """z = |avg - mean| / stddev_samp over the flight's
    1-hour windows; 0 when stddev is NULL or 0; anomaly when z > 3."""
    return scored_windows(ticks(spark, sf_dir)).select(
        "flight_number", "window_start", "avg_price_usd", "message_count",
        "z_score", "is_anomaly")


@register("anomaly_zscore_rolling7d", with_(SQL_TICKS) + """,
r AS (SELECT event_id, flight_number, price_usd, event_timestamp,
  avg(price_usd) OVER w AS m, stddev_samp(price_usd) OVER w AS sd,
  count(price_usd) OVER w AS baseline_n
  FROM ticks
  WINDOW w AS (PARTITION BY flight_number ORDER BY event_timestamp
               RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING))
SELECT event_id, flight_number, price_usd, baseline_n,
  round(CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE abs(price_usd - m) / sd END, 4) AS z_score,
  CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE abs(price_usd - m) / sd END > 3.0 AS is_anomaly
FROM r""".replace("\n,\nr AS", ",\nr AS"))
def anomaly_zscore_rolling7d(spark, sf_dir):
    """each tick against the same flight's ticks of the previous 7 days
    (current second excluded); hot flights split into time chunks."""
    t = ticks(spark, sf_dir).select("event_id", "flight_number", "price_usd",
                                    "event_timestamp")
    r = rolling_zscore(t, "flight_number", "event_timestamp", "price_usd")
    return r.select("event_id", "flight_number", "price_usd", "baseline_n",
                    "z_score", "is_anomaly")


@register("anomaly_asof_1h", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN,
                                   SQL_SILVER_1HR) + """
SELECT s.flight_number, s.window_start, s.avg_price_usd,
       t.window_end AS baseline_window_end, t.avg_price_usd AS baseline_avg_price_usd,
       CAST(CAST(round(s.avg_price_usd * 100) AS BIGINT)
            - CAST(round(t.avg_price_usd * 100) AS BIGINT) AS DOUBLE) / 100 AS deviation_usd
FROM silver5 s ASOF LEFT JOIN silver1h t
  ON s.flight_number = t.flight_number AND s.window_start >= t.window_end""")
def anomaly_asof_1h(spark, sf_dir):
    """Each 5-minute snapshot against the latest 1-hour window of the
    same flight that ended at or before the snapshot started."""
    t = ticks(spark, sf_dir)
    snap = silver_5min(t).select("flight_number", "window_start", "avg_price_usd")
    trend = silver_1hr(t).select("flight_number", "window_end", "avg_price_usd")
    return asof_baseline(snap, trend, ["flight_number"])


# ------------------------------------------------------------ JSON ingress
@register("json_required_keys", """
SELECT event_id,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CASE WHEN props IS NULL OR NOT json_valid(props) THEN
         CASE WHEN ltrim(props) LIKE '[%' THEN 'not_object' ELSE 'malformed' END
       WHEN json_type(props) <> 'OBJECT' THEN 'not_object'
       WHEN NOT list_contains(json_keys(props), 'k') THEN 'missing_key'
       WHEN json_extract_string(props, '$.k') IS NOT NULL
            AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL THEN 'bad_type'
  END AS reason
FROM events""")
def json_required_keys(spark, sf_dir):
    """Validate ``events.props`` against {k: long}, key required;
    every row is accepted (reason NULL) or rejected with a reason."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    schema = StructType([StructField("k", LongType())])
    return tag_events(ev, "props", schema, ["k"]).select("event_id", "k", "reason")


SCHEMA_FILE = """{"type": "record", "name": "Tick", "fields": [
  {"name": "event_id", "type": "long"}, {"name": "route_id", "type": "string"}, {"name": "origin", "type": "string"},
  {"name": "airline_name", "type": "string", "default": "unknown"},
  {"name": "flight_date", "type": ["null", "string"], "default": null}, {"name": "price_usd", "type": "double"}]}"""


@register("tick_schema_file", with_(SQL_TICKS) + """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE airline_name END AS airline_name,
  CASE WHEN event_id % 5 <> 0 THEN flight_date END AS flight_date, price_usd,
  CASE WHEN event_id % 11 = 0 THEN 'missing_key' WHEN event_id % 7 = 0 THEN 'null_value' END AS reason FROM ticks""")
def tick_schema_file(spark, sf_dir):
    """Messages held against a record schema that is read from its file --
    absent keys take their default or reject the message, nulls are values
    only where the type is a union with null."""
    path = scratch_dir(spark, "schema")
    spark.createDataFrame([(SCHEMA_FILE,)], "value string").coalesce(1).write.text(path)
    schema = read_message_schema(spark, path)
    i = F.col("event_id")
    body = F.to_json(F.struct("event_id", F.when(i % 11 != 0, F.col("route_id")).alias("route_id"), F.when(i % 7 != 0, F.col("origin")).alias("origin"),
                              F.when(i % 3 != 0, F.col("airline_name")).alias("airline_name"), F.when(i % 5 != 0, F.col("flight_date")).alias("flight_date"), "price_usd"))
    nulls = F.concat(F.when(i % 7 == 0, F.lit('"origin":null,')).otherwise(F.lit("")), F.when(i % 5 == 0, F.lit('"flight_date":null,')).otherwise(F.lit("")))
    messages = ticks(spark, sf_dir).select(F.concat(F.lit("{"), nulls, F.substr(body, F.lit(2))).alias("value"))
    tagged = tag_events(messages, "value", schema.columns, schema.required, not_null=schema.not_null, defaults=schema.defaults)
    return tagged.select("event_id", "airline_name", "flight_date", "price_usd", "reason")


@register("tick_json_roundtrip", with_(SQL_TICKS) + "SELECT " +
          ", ".join(c for c in TICK_COLUMNS if c != "event_id") + " FROM ticks")
def tick_json_roundtrip(spark, sf_dir):
    """S21 -> S20/C1: ticks encoded as JSON messages, then parsed and validated
    back; all ticks are accepted with their typed values."""
    t = ticks(spark, sf_dir)
    msgs = t.select(F.to_json(F.struct(*[c for c in TICK_COLUMNS if c != "event_id"]))
                    .alias("value"))
    good, _ = parse_events(msgs)
    return good.select(*[c for c in TICK_COLUMNS if c != "event_id"])


@register("top_anomalies", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN, SQL_SILVER_1HR,
                                 SQL_SCORED) + """
SELECT flight_number, route_id, window_start, avg_price_usd, z_score
FROM scored WHERE is_anomaly
ORDER BY z_score DESC, flight_number, window_start LIMIT 10""")
def top_anomalies(spark, sf_dir):
    """Flagship: the 10 most anomalous 5-minute windows."""
    s = scored_windows(ticks(spark, sf_dir)).filter(F.col("is_anomaly"))
    return (s.orderBy(F.col("z_score").desc(), "flight_number", "window_start").limit(10)
            .select("flight_number", "route_id", "window_start", "avg_price_usd", "z_score"))
