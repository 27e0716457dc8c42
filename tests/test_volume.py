"""Steps that moved or computed the same rows more than once."""

import datetime

import pytest
from pyspark.sql import functions as F

from pricelens.operators import dims, serving
from pricelens.plans import q_tables
from pricelens.plans.daily import DIM_FLIGHT_SCHEMA
from pricelens.sinks.writers import upsert_best
from pricelens.streaming import ticks as T


def test_active_routes_are_found_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def route(i):
        seen.add(1)
        return f"R{i}"

    monkeypatch.setattr(q_tables, "first_per_route", lambda *_: spark.range(3).select(route("id").alias("route_id"), F.lit("2024-01-02").alias("flight_date")))
    found = q_tables.active_routes_snapshot(spark, "unused").collect()
    assert sorted(map(tuple, found)) == [(f"R{i}", "2024-01-02", 1) for i in range(3)] and seen.value == 3


@pytest.fixture()
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_refresh_does_not_shuffle_its_source_for_the_changed_months(spark, tmp, no_auto_broadcast):
    at = datetime.datetime(2024, 1, 2)
    rows = [("a", "2024-01", at), ("b", "2024-02", at), ("c", None, at)]
    source = spark.createDataFrame(rows, "k string, month string, loaded_at timestamp")
    plans = []

    def build(r):
        plans.append(r._jdf.queryExecution().executedPlan().toString())
        return r

    assert serving.refresh_changed(spark, source, build, f"{tmp}/t", "month", f"{tmp}/m", "hourly", "2024-01-03 00:00:00") == 3
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]


def counting(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(x):
        seen.add(1)
        return x

    return seen, same


def test_an_upsert_computes_its_updates_once(spark, tmp):
    seen, same = counting(spark)
    updates = spark.createDataFrame([(k, "p", k, "v") for k in range(5)], "k int, part string, at int, v string")
    assert upsert_best(spark, updates.withColumn("v", same("v")), f"{tmp}/t", ["k"], [("at", True)], "part") == 5
    assert seen.value == 5


def test_versions_are_computed_once(spark):
    seen, same = counting(spark)
    updates = spark.createDataFrame([("F1", "R1", "O", "D", "A", "2024-01-01"), ("F1", "R2", "O", "D", "A", "2024-01-03"), ("F2", "R1", "O", "D", "A", "2024-01-02")],
                                    "flight_number string, route_id string, origin string, destination string, airline_code string, _day string")
    dim = dims.scd2_apply(spark.createDataFrame([], DIM_FLIGHT_SCHEMA), updates.withColumn("route_id", same("route_id")),
                          ["flight_number"], ["route_id", "airline_code"], "_day", "flight_key")
    assert sorted(map(tuple, dim.select("flight_key", "route_id", "expiry_date").collect())) == [(2000, "R1", "2024-01-03"), (2001, "R2", "9999-12-31"), (2002, "R1", "9999-12-31")]
    assert seen.value == 3


def test_slices_take_equal_numbers_of_files(spark, tmp, monkeypatch):
    monkeypatch.setattr(T, "FILE_ROWS", 10)
    rows = spark.range(0, 200, 1, 3).selectExpr("concat('F', id) as flight_number", "id as event_timestamp", "id as ingestion_timestamp", "1.0D as price_usd")
    assert T.files_per_slice(rows, [60, 120]) == 6 and T.files_per_slice(rows, [5, 6]) == 1 and T.files_per_slice(rows, [60, 60]) == 1
    T.write_slices(rows, f"{tmp}/s", [60, 120], 6)
    files = spark.read.text(f"{tmp}/s").select(F.get_json_object("value", "$.event_timestamp").cast("int").alias("t"), "_metadata.file_name", "_metadata.file_modification_time")
    per = files.groupBy("file_name", "file_modification_time").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("t").alias("n")).orderBy("file_modification_time").collect()
    assert [sum(r["n"] for r in per[k:k + 6]) for k in (0, 6, 12)] == [60, 60, 80] and len(per) == 18
    assert all(max(r["hi"] for r in per[k:k + 6]) < min(r["lo"] for r in per[k + 6:k + 12]) for k in (0, 6))
