"""Monitoring pack (P22: H1, E17, E18, G5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from pricelens.plans.catalog import register
from pricelens.sources.tables import read_table

COUNTED = ["events", "orders", "lineitem", "customer"]


@register("table_counts_union", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def table_counts_union(spark, sf_dir):
    """H1: UNION ALL of labelled per-table counts."""
    parts = [read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in COUNTED]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("duplicate_detector", """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_detector(spark, sf_dir):
    """Keys occurring more than once (GROUP BY ... HAVING)."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


@register("table_profile", """
SELECT count(*) AS row_count, count(DISTINCT user_id) AS distinct_users,
       min(ts) AS first_ts, max(ts) AS last_ts FROM events""")
def table_profile(spark, sf_dir):
    """Count, exact distinct count, time range in one aggregate."""
    ev = read_table(spark, sf_dir, "events")
    return ev.agg(F.count(F.lit(1)).alias("row_count"),
                  F.countDistinct("user_id").alias("distinct_users"),
                  F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("latest_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def latest_rows(spark, sf_dir):
    """Newest rows of a log (top-k, ties by key)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(10)
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"))
