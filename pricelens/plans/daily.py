"""Daily Silver -> Gold batch.

``gold_frames`` is the pure transformation (existing dims + increment ->
new dim rows + fact rows).  ``run_daily`` wires it to parquet tables with a
high-water mark; ``check_and_audit`` holds the stored tables against the
data-quality rules.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from pricelens.functions import calendar as cal
from pricelens.operators.anomaly import baseline_stats, merge_moments, moment_stats, moments, newly_best, zscore
from pricelens.operators.dedup import keep_best
from pricelens.operators.dims import (dim_airlines_new, dim_date_new, scd2_apply)
from pricelens.operators.dq import (audit_row, gold_checks, late_checks, late_metrics,
                                    silver_checks)
from pricelens.operators.late import late_report
from pricelens.session import store
from pricelens.sinks.versions import read_live
from pricelens.sinks.writers import MARK_SCHEMA, read_mark, upsert_best, write_mark
from pricelens.sources.tables import columns, read_increment, read_or_empty

# --- fixed values: table layouts ---
DIM_DATE_SCHEMA = StructType([
    StructField("date_key", IntegerType(), False), StructField("date", StringType(), False),
    StructField("day_of_week", StringType(), False), StructField("day_number", IntegerType(), False),
    StructField("is_weekend", BooleanType(), False), StructField("month", IntegerType(), False),
    StructField("quarter", IntegerType(), False), StructField("is_us_holiday", BooleanType(), False),
    StructField("season", StringType(), False)])
DIM_AIRLINE_SCHEMA = StructType([
    StructField("airline_key", IntegerType(), False), StructField("airline_code", StringType(), False),
    StructField("airline_name", StringType(), False), StructField("alliance", StringType(), True),
    StructField("is_domestic", BooleanType(), False)])
DIM_FLIGHT_SCHEMA = StructType([
    StructField("flight_key", IntegerType(), False), StructField("flight_number", StringType(), False),
    StructField("route_id", StringType(), False), StructField("origin", StringType(), False),
    StructField("destination", StringType(), False), StructField("airline_code", StringType(), False),
    StructField("effective_date", StringType(), False), StructField("expiry_date", StringType(), False),
    StructField("is_current", BooleanType(), False)])
FACT_COLUMNS = ["flight_key", "airline_key", "date_key", "window_start", "window_end",
                "avg_price_usd", "min_price_usd", "max_price_usd", "message_count",
                "is_anomaly", "z_score", "created_at"]
# --- end of fixed values ---

# the baselines' own tables: the 1-hour windows counted by a run, and each flight's moments after it
COUNTED_SCHEMA = columns("flight_number string, window_start timestamp, message_count bigint, processing_timestamp timestamp, avg_price_usd double")
MOMENTS_SCHEMA = columns("flight_number string, n bigint, s decimal(38,0), q decimal(38,0)")
FACT_SCHEMA = columns("flight_number string, flight_key int, airline_key int, date_key int, window_start timestamp, window_end timestamp, "
                                 "avg_price_usd double, min_price_usd double, max_price_usd double, message_count bigint, is_anomaly boolean, "
                                 "z_score double, created_at string, fact_date date")


@dataclass
class Gold:
    dim_date: DataFrame      # new rows only
    dim_airlines: DataFrame  # new rows only
    dim_flights: DataFrame   # full next version of the SCD2 dimension
    scored: DataFrame        # scored increment (flight_number grain)
    fact: DataFrame          # fact rows in the 12-column order


def gold_frames(inc5: DataFrame, silver1h: DataFrame, dim_date: DataFrame,
                dim_airlines: DataFrame, dim_flights: DataFrame, run_ts: str,
                holidays: list[str] | None = None) -> Gold:
    snap = keep_best(inc5, ["flight_number", "window_start"])
    scored = score_increment(snap, silver1h)
    new_dates = dim_date_new(snap, dim_date, "window_start", holidays)
    new_air = dim_airlines_new(snap, dim_airlines)
    flights = scd2_apply(dim_flights, flight_updates(snap), ["flight_number"],
                         ["route_id", "airline_code"], "_day", "flight_key")
    fact = load_fact(scored, flights, dim_airlines.unionByName(new_air),
                     dim_date.unionByName(new_dates), run_ts)
    return Gold(new_dates, new_air, flights, scored, fact)


def score_increment(snap: DataFrame, silver1h: DataFrame) -> DataFrame:
    """The snapshot against each flight's 1-hour baseline."""
    base = keep_best(silver1h, ["flight_number", "window_start"])
    return zscore(snap, baseline_stats(base, "flight_number"), "flight_number")


def flight_updates(snap: DataFrame) -> DataFrame:
    """One row per flight and day: the attributes of the day's last window."""
    cols = ["flight_number", "route_id", "origin", "destination", "airline_code"]
    day = snap.select(*cols, "window_start", F.to_date("window_start").alias("_day"))
    return keep_best(day, ["flight_number", "_day"], [("window_start", True), ("route_id", True), ("airline_code", True)]).drop("window_start")


def load_fact(scored: DataFrame, dim_flights: DataFrame, dim_airlines: DataFrame,
              dim_date: DataFrame, run_ts: str, keep: list[str] | None = None) -> DataFrame:
    """Three left joins to the dims (D2) -- the flight version valid on the
    window's date, the carrier, the date -- then the fact's 12 columns.  A
    member missing from a dim keeps a NULL key; the row count is unchanged
    because each dim join is on that dim's unique key."""
    f = scored.withColumn("date", cal.date_str(F.to_date("window_start")))
    fl = dim_flights.select(F.col("flight_number").alias("_fn"), "flight_key",
                            F.col("effective_date").alias("_eff"),
                            F.col("expiry_date").alias("_exp"))
    j = f.join(fl, (f["flight_number"] == fl["_fn"]) & (fl["_eff"] <= f["date"])
               & (f["date"] < fl["_exp"]), "left")
    j = j.join(dim_airlines.select("airline_key", "airline_code"), "airline_code", "left")
    j = j.join(dim_date.select("date_key", "date"), "date", "left")
    return j.select(*(keep or []), *FACT_COLUMNS[:-1], F.lit(run_ts).alias("created_at"))


# ----------------------------------------------------------------- the job
def committed(spark: SparkSession, root: str, pipeline: str) -> DataFrame:
    """``run``: the runs that wrote their mark.  Rows of a run that failed
    before its mark are in the tables, but no reader takes them."""
    marks = read_or_empty(spark, os.path.join(root, "control", "watermarks"), MARK_SCHEMA)
    return marks.filter(F.col("pipeline_name") == pipeline).select(F.col("updated_at").alias("run")).distinct()


def read_runs(spark: SparkSession, root: str, name: str, schema: StructType, runs: DataFrame,
              more: str | None = None) -> DataFrame:
    """A ``run=`` partitioned Gold table: rows of committed runs, and of ``more``."""
    full = StructType(schema.fields + [StructField("run", StringType(), False)])
    t = read_or_empty(spark, os.path.join(root, "gold", name), full)
    if more is not None:
        runs = runs.union(spark.createDataFrame([(more,)], "run string")).distinct()
    return t.join(runs, "run", "left_semi").select(*schema.fieldNames())


def write_run(df: DataFrame, root: str, name: str, run_ts: str) -> None:
    """Replace this run's partition, so that a run may be tried again."""
    (df.withColumn("run", F.lit(run_ts)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(os.path.join(root, "gold", name)))


def current_flights(spark: SparkSession, root: str, run: str | None) -> DataFrame:
    """Open versions of the flights as a run left them (its partition only)."""
    if run is None:
        return spark.createDataFrame([], DIM_FLIGHT_SCHEMA)
    one = spark.createDataFrame([(run,)], "run string")
    return read_runs(spark, root, "dim_flights_current", DIM_FLIGHT_SCHEMA, one)


def add_to_baselines(spark: SparkSession, root: str, run_ts: str, runs: DataFrame, last_run: str | None,
                     lo: str) -> str:
    """The 1-hour windows that came after ``lo`` enter the flights'
    stored moments; returns the new mark.  Reads the increment, the windows
    counted before in its time range (a window that fired again replaces its
    earlier self) and the last run's moments, never all of Silver."""
    silver = spark.read.parquet(os.path.join(root, "silver", "price_1hr"))
    key = ["flight_number", "window_start"]
    new = silver.filter(F.col("processing_timestamp") > F.lit(lo).cast("timestamp"))
    seen = new.agg(F.max("processing_timestamp").cast("string").alias("hi"), F.min("window_start").alias("first"), F.max("window_start").alias("last")).first()
    before = read_runs(spark, root, "baseline_moments", MOMENTS_SCHEMA, spark.createDataFrame([(last_run,)], "run string"))
    if seen["hi"] is None:
        write_run(before, root, "baseline_moments", run_ts)
        return lo
    inc = read_increment(silver, "processing_timestamp", F.lit(lo).cast("timestamp"), F.lit(seen["hi"]).cast("timestamp"))
    counted = read_runs(spark, root, "baseline_windows", COUNTED_SCHEMA, runs).where(F.col("window_start").between(F.lit(seen["first"]), F.lit(seen["last"])))
    entered = store(newly_best(inc, counted, key), "entered")
    write_run(entered.where("_sign = 1").select(*COUNTED_SCHEMA.fieldNames()).repartitionByRange("window_start").sortWithinPartitions("window_start"),
              root, "baseline_windows", run_ts)
    write_run(merge_moments([before, moments(entered, "flight_number", sign=F.col("_sign"))], "flight_number"), root, "baseline_moments", run_ts)
    return seen["hi"]


def read_baselines(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Each flight's mean and standard deviation as ``run`` left them."""
    state = read_runs(spark, root, "baseline_moments", MOMENTS_SCHEMA, spark.createDataFrame([(run,)], "run string"))
    return moment_stats(state, "flight_number")


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    """The fact as of the last commit."""
    return read_live(spark, os.path.join(root, "gold", "fact_flight_prices"), FACT_SCHEMA, "fact_date")


def run_daily(spark: SparkSession, root: str, run_ts: str, pipeline: str = "daily_batch",
              default_mark: str = "1970-01-01 00:00:00", upto: str | None = None) -> dict:
    """P2 over parquet tables under ``root`` (silver/, gold/, control/).

    The increment is ``(mark, hi]`` with ``hi`` read once before any other
    step (``upto`` bounds it further).  Flights are scored against stored
    moments, to which the run adds the 1-hour windows that came since the last
    one.  Dimensions are written before the fact and the fact is built from the
    written tables, so stored keys agree.  Dimensions and moments are written in
    this run's partition and count only once the marks are written, as the last
    step; the fact is a keyed upsert that a repeated run writes again.  So after
    a failure anywhere the run is simply repeated.  Closed SCD2 versions are
    appended once and never rewritten."""
    p = lambda *a: os.path.join(root, *a)
    lo = read_mark(spark, p("control", "watermarks"), pipeline, default_mark)
    runs = committed(spark, root, pipeline)
    last_run = runs.agg(F.max("run").alias("r")).first()["r"]
    silver5 = spark.read.parquet(p("silver", "price_5min"))
    new = silver5.filter(F.col("processing_timestamp") <= F.lit(upto).cast("timestamp")) if upto else silver5
    hi = new.agg(F.max("processing_timestamp").cast("string").alias("hi")).first()["hi"]
    if hi is None or hi <= lo:
        return {"gold_rows": 0, "mark": lo}
    inc = store(keep_best(read_increment(silver5, "processing_timestamp", F.lit(lo).cast("timestamp"),
                                         F.lit(hi).cast("timestamp")), ["flight_number", "window_start"]), "increment")
    baseline = f"{pipeline}/baseline"
    counted_to = add_to_baselines(spark, root, run_ts, runs, last_run, read_mark(spark, p("control", "watermarks"), baseline, default_mark))
    write_run(dim_date_new(inc, read_runs(spark, root, "dim_date", DIM_DATE_SCHEMA, runs)), root, "dim_date", run_ts)
    write_run(dim_airlines_new(inc, read_runs(spark, root, "dim_airlines", DIM_AIRLINE_SCHEMA, runs)), root, "dim_airlines", run_ts)
    opened = current_flights(spark, root, last_run)
    closed = read_runs(spark, root, "dim_flights_closed", DIM_FLIGHT_SCHEMA, runs)
    flights = store(scd2_apply(opened, flight_updates(inc), ["flight_number"], ["route_id", "airline_code"], "_day", "flight_key",
                               keys_in_use=opened.select("flight_key").union(closed.select("flight_key"))), "flights")
    write_run(flights.filter(~F.col("is_current")), root, "dim_flights_closed", run_ts)
    write_run(flights.filter("is_current"), root, "dim_flights_current", run_ts)
    # from here on the written dimensions
    scored = zscore(inc, read_baselines(spark, root, run_ts), "flight_number")
    fact = load_fact(scored, read_flights(spark, root, runs, run_ts),
                     read_runs(spark, root, "dim_airlines", DIM_AIRLINE_SCHEMA, runs, run_ts),
                     read_runs(spark, root, "dim_date", DIM_DATE_SCHEMA, runs, run_ts), run_ts, keep=["flight_number"])
    fact = store(fact.withColumn("fact_date", F.to_date("window_start")), "fact")  # the upsert reads it several times
    gold_rows = upsert_best(spark, fact, p("gold", "fact_flight_prices"),
                            keys=["flight_number", "window_start"], order=[("message_count", True), ("created_at", True)], partition="fact_date")
    write_mark(spark, p("control", "watermarks"), pipeline, hi, run_ts, {baseline: counted_to})
    return {"gold_rows": gold_rows, "mark": hi}


def read_flights(spark: SparkSession, root: str, runs: DataFrame, run: str) -> DataFrame:
    """The whole SCD2 dimension as of ``run``: closed versions and open ones."""
    closed = read_runs(spark, root, "dim_flights_closed", DIM_FLIGHT_SCHEMA, runs, run)
    return closed.unionByName(current_flights(spark, root, run))


def check_and_audit(spark: SparkSession, root: str, run_ts: str) -> DataFrame:
    """P8-P14 after a load: the day's checks on the stored tables; if too many
    ticks were late, the late report (each late tick, its window, whether that
    window exists) is stored; the audit row is appended.  Returns the checks."""
    p = lambda *a: os.path.join(root, *a)
    silver = spark.read.parquet(p("silver", "price_5min"))
    late = spark.read.parquet(p("silver", "late_arrivals"))
    fact = read_fact(spark, root)
    metrics = store(late_metrics(silver, late, run_ts), "metrics")  # one row
    if metrics.first()["reconcile"]:
        ticks = late.withColumn("event_timestamp", F.unix_timestamp("event_timestamp"))
        write_run(late_report(ticks, silver, ["flight_number"]), root, "late_report", run_ts)
    checks = silver_checks(silver, run_ts).unionByName(gold_checks(fact, run_ts)).unionByName(late_checks(metrics))
    gold_rows = gold_checks(fact, run_ts).agg(F.max("value").cast("bigint")).scalar()
    row = audit_row(metrics, gold_rows, run_ts).withColumn("run", F.lit(run_ts))
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(p("control", "audit_log"))
    return checks
