"""Tables written and read back: views over files, added columns, snapshots,
archives, deletes (A9, A10, A12, B4, B5, B9, B11, C17, P13)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pricelens.functions.calendar import severity
from pricelens.functions.timefn import instant, iso_utc
from pricelens.operators.dq import late_metrics
from pricelens.operators.late import most_late, split_late
from pricelens.plans.catalog import SQL_LATE, SQL_ON_TIME, SQL_TICKS, register, sql_schedule, ticks, with_
from pricelens.plans.q_routes import SQL_TOP, first_per_route
from pricelens.plans.q_star import SPLIT_DATE, gold
from pricelens.plans.q_ticks import SQL_SCORED, SQL_SILVER_1HR, SQL_SILVER_5MIN
from pricelens.plans.silver import late_table, silver_5min
from pricelens.session import scratch_dir, store
from pricelens.sinks.versions import read_live, replace
from pricelens.sinks.writers import delete_where, overwrite, truncate
from pricelens.sources.tables import list_files, read_merged, read_or_empty, read_table, union_evolving

ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderdate"]


@register("external_view", "SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest FROM orders GROUP BY o_orderstatus")
def external_view(spark, sf_dir):
    """A10: a view over files in place, queried with SQL."""
    read_table(spark, sf_dir, "orders").createOrReplaceTempView("external_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest FROM external_orders GROUP BY o_orderstatus")


@register("added_column", f"""SELECT o_orderkey, o_orderstatus, o_orderdate,
  CASE WHEN o_orderdate <= CAST('{SPLIT_DATE}' AS TIMESTAMP) THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def added_column(spark, sf_dir):
    """Files from before and after a column was added, read as one table."""
    o, path = read_table(spark, sf_dir, "orders"), scratch_dir(spark, "evolving")
    old = F.col("o_orderdate") <= F.lit(SPLIT_DATE).cast("timestamp_ntz")
    before, after = o.filter(old).select(*ORDER_COLUMNS), o.filter(~old).select(*ORDER_COLUMNS, "o_orderpriority")
    before.write.mode("append").parquet(path)
    after.write.mode("append").parquet(path)
    stored = read_merged(spark, path)
    return union_evolving([stored.select(*ORDER_COLUMNS, "o_orderpriority"), before.limit(0)])


@register("stage_listing", "SELECT count(*) > 0 AS written, count(*) > 0 AS sized FROM orders HAVING count(*) > 0")
def stage_listing(spark, sf_dir):
    """The files of a stored table with their sizes, contents unread.  Written:
    the listing has the very files that the stored rows lie in, and these hold
    every row of the table."""
    path = scratch_dir(spark, "stage")
    orders = read_table(spark, sf_dir, "orders")
    orders.write.parquet(path)
    files = list_files(spark, path, "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("listed"), "length")
    stored = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    both = files.join(stored, F.col("listed") == F.col("file"), "full")
    found = both.agg((F.count("listed") > 0).alias("some"), (F.count("listed") == F.count(F.lit(1))).alias("all"),
                     F.sum(F.when(F.col("listed").isNotNull(), F.col("n"))).alias("n"), (F.min("length") > 0).alias("sized"))
    rows = orders.agg(F.count(F.lit(1)).alias("rows"))
    return found.crossJoin(rows).select((F.col("some") & F.col("all") & (F.coalesce("n", F.lit(0)) == F.col("rows"))).alias("written"), "sized")


@register("active_routes_snapshot", with_(sql_schedule(), SQL_TOP) + f"""
SELECT route_id, min(flight_date) AS first_archived, count(*) AS routes FROM (
  SELECT route_id, arg_min(flight_date, {{'o': pos_orderkey, 'l': pos_linenumber, 'p': pos_partkey, 's': pos_suppkey}}) AS flight_date
  FROM sched WHERE route_id IN (SELECT route_id FROM top) GROUP BY route_id) t GROUP BY route_id""")
def active_routes_snapshot(spark, sf_dir):
    """The active routes as a JSON snapshot that each run
    overwrites, and in an archive by date; both read back.  The routes, at most
    one row for each of the top ones, are found once for both runs."""
    root = scratch_dir(spark, "routes")
    routes = store(first_per_route(spark, sf_dir), "active-routes")
    for _ in range(2):  # a second run replaces, it does not add
        overwrite(routes, os.path.join(root, "active_routes"), fmt="json")
    snapshot = spark.read.schema(routes.schema).json(os.path.join(root, "active_routes"))
    overwrite(snapshot.withColumn("day", F.col("flight_date")), os.path.join(root, "archive"), fmt="json", partition_by=["day"])
    archive = spark.read.schema("route_id string, day string").json(os.path.join(root, "archive"))
    return snapshot.join(archive, "route_id").groupBy("route_id").agg(
        F.min("day").alias("first_archived"), F.count(F.lit(1)).alias("routes"))


@register("deleted_rows", "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus <> 'F'")
def deleted_rows(spark, sf_dir):
    """DELETE by predicate, then TRUNCATE of a copy, then a scan of a
    table that is not there."""
    path = scratch_dir(spark, "orders")
    o = read_table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    replace(o, path)
    delete_where(spark, path, F.col("o_orderstatus") != "F", o.schema)
    o.write.parquet(f"{path}-copy")
    truncate(spark, f"{path}-copy", o.schema)
    return read_live(spark, path, o.schema).union(read_or_empty(spark, f"{path}-copy", o.schema)) \
        .union(read_or_empty(spark, f"{path}-absent", o.schema))


@register("saved_aggregate", "SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest FROM orders GROUP BY o_orderstatus")
def saved_aggregate(spark, sf_dir):
    """An aggregate saved as a table and read from it."""
    path = scratch_dir(spark, "by_status")
    agg = read_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest"))
    overwrite(agg, path)
    return spark.read.schema(agg.schema).parquet(path)


@register("severity_bands", with_(SQL_TICKS, SQL_ON_TIME, SQL_SILVER_5MIN, SQL_SILVER_1HR, SQL_SCORED) + """
SELECT CASE WHEN z_score < 1 THEN 'normal' WHEN z_score <= 3 THEN 'elevated' ELSE 'anomaly' END AS severity, count(*) AS windows
FROM scored GROUP BY 1""")
def severity_bands(spark, sf_dir):
    """C17: windows by band of their z-score."""
    return gold(spark, sf_dir).scored.groupBy(severity(F.col("z_score")).alias("severity")).agg(F.count(F.lit(1)).alias("windows"))


@register("late_worst", with_(SQL_TICKS, SQL_LATE) + """
SELECT event_id, flight_number, strftime(make_timestamp(event_timestamp * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS event_time,
  ingestion_timestamp - event_timestamp AS lateness_seconds FROM late
ORDER BY lateness_seconds DESC, event_timestamp, event_id LIMIT 10""")
def late_worst(spark, sf_dir):
    """The ten latest ticks, most late first."""
    _, late = split_late(ticks(spark, sf_dir))
    return most_late(late, 10, tie=["event_id"]).select(
        "event_id", "flight_number", iso_utc(instant(F.col("event_timestamp"))).alias("event_time"), "lateness_seconds")


LATE_DAY = "2024-01-30"


@register("late_rate_by_messages", with_(SQL_TICKS, SQL_ON_TIME, SQL_LATE, SQL_SILVER_5MIN) + f""",
s AS (SELECT count(*) AS n, coalesce(sum(message_count), 0) AS m FROM silver5 WHERE CAST(processing_timestamp AS DATE) = DATE '{LATE_DAY}'),
l AS (SELECT count(*) AS n FROM late WHERE CAST(make_timestamp(ingestion_timestamp * 1000000) AS DATE) = DATE '{LATE_DAY}')
SELECT s.n AS total, l.n AS late_total, CASE WHEN s.m + l.n = 0 THEN 0.0 ELSE CAST(l.n AS DOUBLE) / CAST(s.m + l.n AS DOUBLE) END AS late_rate,
  l.n > 0.1 * (s.m + l.n) AS reconcile FROM s, l""")
def late_rate_by_messages(spark, sf_dir):
    """P12 with messages below the line instead of aggregated rows."""
    t = ticks(spark, sf_dir)
    return late_metrics(silver_5min(t), late_table(t), f"{LATE_DAY} 12:00:00", per="messages")
