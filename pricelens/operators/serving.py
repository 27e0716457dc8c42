"""Serving aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from pricelens.functions import calendar as cal
from pricelens.functions.lookups import alliance
from pricelens.functions.money import avg_usd, cents_to_usd, to_cents
from pricelens.operators.anomaly import baseline_stats, zscore
from pricelens.sinks.versions import replace
from pricelens.sinks.writers import read_mark, write_mark
from pricelens.sources.tables import read_or_empty
from pricelens.sources.views import SCHEDULE_POSITION


def score_schedule(sched: DataFrame) -> DataFrame:
    """Each scheduled flight's price scored against that flight's all-history
    mean and sample stddev (P6 on schedule rows)."""
    stats = baseline_stats(sched, "flight_iata", "price_usd")
    return zscore(sched, stats, "flight_iata", "price_usd")


def flight_day_summary(scored: DataFrame, loaded_at: str) -> DataFrame:
    """One row per flight, route and day (P17): carrier, alliance, weekend,
    season and exact avg/min/max prices, anomalies and priced rows."""
    d = F.to_date("flight_date")
    rows = scored.filter(F.col("arrival_iata").isNotNull() & F.col("flight_iata").isNotNull())
    # by the column itself, not null here: rows that lie by flight after the scores' join stay where they are
    g = rows.groupBy(
        F.col("flight_iata").alias("flight_number"),
        F.col("route_id"), F.col("departure_iata").alias("origin"),
        F.col("arrival_iata").alias("destination"), F.col("airline_name"),
        alliance(F.col("airline_iata")).alias("alliance"), F.col("flight_date").alias("date"),
        cal.is_weekend(d).alias("is_weekend"), cal.season(d).alias("season"),
    ).agg(F.sum(to_cents(F.col("price_usd"))).alias("_s"), F.count("price_usd").alias("_n"),
          F.min(to_cents(F.col("price_usd"))).alias("_lo"),
          F.max(to_cents(F.col("price_usd"))).alias("_hi"),
          F.count_if(F.col("is_anomaly")).alias("_a"), F.count(F.lit(1)).alias("_w"))
    return g.select(F.coalesce(F.col("flight_number"), F.lit("UNKNOWN")).alias("flight_number"),
                    "route_id", "origin", "destination", "airline_name", "alliance", "date", "is_weekend", "season",
                    avg_usd(F.col("_s"), F.col("_n")).alias("avg_price_usd"),
                    cents_to_usd(F.col("_lo")).alias("min_price_usd"),
                    cents_to_usd(F.col("_hi")).alias("max_price_usd"),
                    F.col("_a").cast("int").alias("anomaly_count"),
                    F.col("_w").cast("int").alias("window_count"),
                    F.to_timestamp(F.lit(loaded_at)).alias("loaded_at"))


def route_day_stats(scored: DataFrame, loaded_at: str) -> DataFrame:
    """One row per route and day (P18): carriers (exact distinct count), the
    cheapest carrier by real price and the first departing carrier (ties by
    position), exact avg/min/max and anomalies."""
    rows = scored.filter(F.col("arrival_iata").isNotNull() & F.col("airline_iata").isNotNull())
    pos = [F.col(c) for c in SCHEDULE_POSITION]
    cents = to_cents(F.col("price_usd"))
    g = rows.groupBy("route_id", F.col("departure_iata").alias("origin"),
                     F.col("arrival_iata").alias("destination"),
                     F.col("flight_date").alias("date")).agg(
        F.countDistinct("airline_iata").alias("_ac"),
        F.min_by("airline_name", F.struct(cents, *pos)).alias("cheapest_airline"),
        F.min_by("airline_name", F.struct(F.col("departure_scheduled"), *pos))
        .alias("first_departing_airline"),
        F.sum(cents).alias("_s"), F.count("price_usd").alias("_n"),
        F.min(cents).alias("_lo"), F.max(cents).alias("_hi"),
        F.count_if(F.col("is_anomaly")).alias("_a"))
    return g.select("route_id", "origin", "destination", "date",
                    F.col("_ac").cast("int").alias("airline_count"), "cheapest_airline",
                    "first_departing_airline",
                    cents_to_usd(F.col("_lo")).alias("min_price_usd"),
                    avg_usd(F.col("_s"), F.col("_n")).alias("avg_price_usd"),
                    cents_to_usd(F.col("_hi")).alias("max_price_usd"),
                    F.col("_a").cast("int").alias("anomaly_count"),
                    F.to_timestamp(F.lit(loaded_at)).alias("loaded_at"))


SKETCH_BITS = 12  # 4096 registers: a relative standard error of about 1.6 %


def distinct_sketches(df: DataFrame, keys: list[str], value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """E6 as a stored state: per ``keys`` a sketch of the distinct values
    (NULLs don't count), a few KB at most, that merges with others.  The exact
    count stays the default (``route_day_stats``)."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, bits).alias("sketch"))


def distinct_estimate(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values per wider ``keys`` from the union of stored sketches,
    without the rows they were made from.  Exact for the first few dozen
    values, within about 5 % (three standard errors at 12 bits) beyond."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def route_summary(summary: DataFrame) -> DataFrame:
    """Refreshing route summary (P19 E11): six group keys, exact distinct
    carriers, average of the flights' averages (exact, half-up), extremes,
    anomalies and the newest load time."""
    g = summary.groupBy("route_id", "origin", "destination", "date", "season",
                        "is_weekend").agg(
        F.countDistinct("airline_name").alias("airline_count"),
        F.sum(to_cents(F.col("avg_price_usd"))).alias("_s"),
        F.count("avg_price_usd").alias("_n"),
        F.min("min_price_usd").alias("min_price"), F.max("max_price_usd").alias("max_price"),
        F.sum("anomaly_count").cast("bigint").alias("total_anomalies"),
        F.max("loaded_at").alias("last_updated"))
    return g.select("route_id", "origin", "destination", "date", "season", "is_weekend",
                    "airline_count", avg_usd(F.col("_s"), F.col("_n")).alias("avg_price"),
                    "min_price", "max_price", "total_anomalies", "last_updated")


HOURLY_SCHEMA = ("route_id string, origin string, destination string, season string, is_weekend boolean,"
                 " airline_count bigint, avg_price double, min_price double, max_price double,"
                 " total_anomalies bigint, last_updated timestamp, date string, month string")


def refresh_if_stale(spark: SparkSession, build: Callable[[], DataFrame], path: str,
                     lag_seconds: int, run_ts: str, ts_col: str = "last_updated",
                     partition_by: str | None = None) -> bool:
    """Create-or-replace a derived table when it is absent or older than
    ``lag_seconds`` at ``run_ts`` (B12, TARGET_LAG); with ``partition_by`` one
    folder for each value, so that readers prune.  Returns whether it was
    rebuilt.  The staleness test reads one aggregate value."""
    newest = read_or_empty(spark, path, StructType([StructField(ts_col, TimestampType())])).agg(F.max(ts_col).alias("m")).first()["m"]
    if newest is not None:
        age = spark.range(1).select(
            (F.unix_timestamp(F.to_timestamp(F.lit(run_ts)))
             - F.unix_timestamp(F.lit(newest).cast("timestamp"))).alias("age")).first()["age"]
        if age <= lag_seconds:
            return False
    table = build()
    if partition_by:  # few files for each value, a large one still over several tasks
        table.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_by).parquet(path)
    else:
        table.write.mode("overwrite").parquet(path)
    return True


def refresh_changed(spark: SparkSession, source: DataFrame, build: Callable[[DataFrame], DataFrame], path: str,
                    partition: str, marks: str, name: str, run_ts: str, ts_col: str = "loaded_at") -> int:
    """Brings a derived table up to its source by rebuilding only the
    partitions that got rows since the last refresh, told by the source's load
    time and a stored mark; returns how many.  ``build`` makes the partitions'
    rows from all their source rows, and must keep the ``partition`` column.

    Untouched partitions keep their files; the rebuilt ones come into force
    with one commit (``sinks.versions``: read the table with ``read_live``),
    and a refresh that fails before its mark is simply repeated.  Rows deleted
    from the source leave no load time behind: rebuild such a partition by
    loading one of its rows again."""
    lo = read_mark(spark, marks, name, None)
    when = F.col(ts_col)
    fresh = source if lo is None else source.filter(when > F.lit(lo).cast("timestamp"))
    hi = fresh.agg(F.max(ts_col).cast("string").alias("hi")).first()["hi"]
    if hi is None:
        return 0
    seen = when <= F.lit(hi).cast("timestamp")  # rows that land meanwhile are the next refresh's
    changed = fresh.filter(seen).select(partition).distinct()
    same = F.broadcast(changed.withColumnRenamed(partition, "_changed"))  # one row a partition: the source is not shuffled for them
    rows = source.filter(seen).join(same, F.col(partition).eqNullSafe(F.col("_changed")), "left_semi")
    replace(build(rows), path, partition, touched=changed)
    write_mark(spark, marks, name, hi, run_ts)
    return changed.count()
