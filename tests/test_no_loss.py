"""Nothing is lost: growth, nulls, retries, hot keys, late panes."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from pricelens.operators.anomaly import rolling_zscore
from pricelens.operators.dims import dense_index
from pricelens.operators.windows import merge_windows, window_agg
from pricelens.plans import daily, q_star
from pricelens.sinks import versions, writers
from pricelens.sources.events import parse_events
from pricelens.streaming import ticks as st

TICK = {"route_id": "R", "origin": "ORD", "destination": "X", "airline_code": "A", "airline_name": "Air", "flight_number": "F1",
        "price_usd": 10.0, "flight_date": "2024-01-01", "event_timestamp": 1_704_067_200, "ingestion_timestamp": 1_704_067_210}


def messages(*changes):
    return [(json.dumps({**TICK, **c}),) for c in changes]


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("n", [20_000, 200_000])
def test_dense_index_keeps_all_rows_of_wide_tables(spark, n, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        wide = spark.range(n).select(F.hash("id").alias("k"), "id", *[F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias(f"c{i}") for i in range(3)])
        for columns in (["k", "id"], wide.columns):
            got = dense_index(wide.select(*columns), ["k", "id"]).agg(
                F.count(F.lit(1)).alias("n"), F.countDistinct("_idx").alias("d"), F.min("_idx").alias("lo"), F.max("_idx").alias("hi")).first()
            assert tuple(got) == (n, n, 0, n - 1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_average_is_over_priced_ticks_also_when_merged(spark):
    df = spark.createDataFrame([(1, "F1", 10.0), (2, "F1", None), (3, "F1", 20.0)], "event_timestamp long, flight_number string, price_usd double")
    one = window_agg(df, ["flight_number"]).first()
    assert (one["avg_price_usd"], one["message_count"]) == (15.0, 3)
    parts = [window_agg(df.filter(F.col("event_timestamp") == t), ["flight_number"], priced=True) for t in (1, 2, 3)]
    assert merge_windows(parts, ["flight_number"]).first()["avg_price_usd"] == 15.0


def test_ticks_without_a_time_are_rejected(spark):
    df = spark.createDataFrame(messages({}, {"event_timestamp": None}, {"ingestion_timestamp": None}), "value string")
    good, bad = parse_events(df)
    assert good.count() == 1
    assert [r["reason"] for r in bad.collect()] == ["null_time", "null_time"]


def stream_of(spark, tmp, batches, **how):
    """Each batch a file, in order."""
    os.makedirs(f"{tmp}/src")
    for i, rows in enumerate(batches):
        with open(f"{tmp}/src/{i}.txt", "w") as f:
            f.write("\n".join(r[0] for r in rows))
        os.utime(f"{tmp}/src/{i}.txt", (1_700_000_000 + 10 * i,) * 2)
    queries = st.start_tick_queries(spark, f"{tmp}/src", f"{tmp}/out", f"{tmp}/ckpt", max_files=1, **how)
    st.await_all(queries)
    return queries


def test_one_row_per_route_window_and_panes_that_fire_again(spark, tmp):
    t0 = TICK["event_timestamp"]
    at = lambda s, **c: {"event_timestamp": t0 + s, "ingestion_timestamp": t0 + s + 5, **c}
    batches = [messages(at(10), at(20, flight_number="F2", price_usd=30.0)),  # two flights of one route
               messages(at(100, price_usd=50.0)),  # the same window again
               messages(at(1_000)),  # moves the watermark to t0 + 880
               messages(at(1_010, airline_code="B")),  # attribute changes inside the window
               messages(at(15, price_usd=90.0))]  # its window is gone (late ticks are told a batch later): dropped
    queries = stream_of(spark, tmp, batches, keys=["route_id"])
    panes = spark.read.parquet(f"{tmp}/out/price_5min").orderBy("batch_id").collect()
    first = [(r["message_count"], r["avg_price_usd"], r["flight_number"]) for r in panes if r["window_start"].timestamp() == t0]
    assert first == [(2, 20.0, "F1"), (3, 30.0, "F1")]
    last = [r for r in panes if r["window_start"].timestamp() == t0 + 900]
    assert [(r["message_count"], r["airline_code"]) for r in last] == [(1, "A"), (2, "A")]
    assert st.dropped_by_watermark(queries[0]) == 1


def test_rejects_are_stored_and_arrival_time_can_stand_in(spark, tmp):
    os.makedirs(f"{tmp}/src")
    with open(f"{tmp}/src/a.txt", "w") as f:
        f.write("\n".join(r[0] for r in messages({}, {"event_timestamp": 0}, {"event_timestamp": None})) + "\nnot json")
    st.await_all(st.start_file_pipe(spark, f"{tmp}/src", f"{tmp}/t", f"{tmp}/c"))
    assert spark.read.parquet(f"{tmp}/t").count() == 2
    assert sorted(r["reason"] for r in spark.read.parquet(f"{tmp}/t-rejected").collect()) == ["malformed", "null_time"]
    good, bad = st.read_ticks(spark, f"{tmp}/src", arrival_fallback=True)
    q = good.writeStream.format("memory").queryName("arrivals").trigger(availableNow=True).start()
    st.await_all([q])
    times = [r["event_timestamp"] for r in spark.table("arrivals").collect()]
    assert sorted(times) == sorted([TICK["event_timestamp"], TICK["ingestion_timestamp"], TICK["ingestion_timestamp"]])


def test_a_stream_that_still_runs_is_not_taken_for_done(spark, tmp):
    os.makedirs(f"{tmp}/src")
    good, _ = st.read_ticks(spark, f"{tmp}/src")
    q = good.writeStream.format("memory").queryName("endless").trigger(processingTime="1 second").start()
    try:
        with pytest.raises(TimeoutError):
            st.await_all([q], timeout_s=1)
    finally:
        q.stop()


def test_rolling_baseline_of_one_hot_key_is_linear(spark):
    def seconds(n):
        df = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 3).alias("t"), (F.col("id") % 97 + 0.5).alias("v"))
        began = time.time()
        assert rolling_zscore(df, "k", "t", "v").filter("baseline_n > 0").count() == n - 1
        return time.time() - began
    seconds(1_000)
    small, large = seconds(40_000), seconds(160_000)
    assert large < 10 * max(small, 1)  # a quadratic one takes 16 times as long


def test_upsert_reads_only_touched_partitions_and_keeps_null_keys(spark, tmp):
    cols = "k long, w int, message_count long, created_at string, day date"
    rows = [(None, i, 1, "a", f"2024-01-0{i}") for i in range(1, 6)]
    make = lambda rs: spark.createDataFrame([(k, w, m, c, __import__("datetime").date.fromisoformat(d)) for k, w, m, c, d in rs], cols)
    order = [("message_count", True), ("created_at", True)]
    writers.upsert_best(spark, make(rows), f"{tmp}/t", ["k", "w"], order, "day")
    before = {r["part"]: r["version"] for r in versions.live(spark, f"{tmp}/t").collect()}
    writers.upsert_best(spark, make([(None, 2, 5, "b", "2024-01-02"), (7, 2, 1, "b", "2024-01-02")]), f"{tmp}/t", ["k", "w"], order, "day")
    got = sorted(((r["k"] or 0, r["w"], r["message_count"]) for r in versions.read_live(spark, f"{tmp}/t", make(rows).schema, "day").collect()))
    assert got == [(0, 1, 1), (0, 2, 5), (0, 3, 1), (0, 4, 1), (0, 5, 1), (7, 2, 1)]
    after = {r["part"]: r["version"] for r in versions.live(spark, f"{tmp}/t").collect()}
    assert [p for p in before if after[p] != before[p]] == ["2024-01-02"] and len(after) == 5


@pytest.mark.parametrize("broken", ["upsert_best", "write_mark"])
def test_a_failed_daily_run_is_repeated(spark, tmp, monkeypatch, broken):
    sf = "/root/testdata/sf0.001"
    t = q_star.ticks(spark, sf)
    for name, df in (("price_5min", q_star.silver_5min(t)), ("price_1hr", q_star.silver_1hr(t)), ("late_arrivals", q_star.late_table(t))):
        df.write.parquet(f"{tmp}/silver/{name}")
    whole = getattr(daily, broken)

    def fail(*a, **k):
        raise OSError("disk gone")

    monkeypatch.setattr(daily, broken, fail)
    with pytest.raises(OSError):
        daily.run_daily(spark, tmp, "2024-01-31 01:00:00", upto="2024-01-15 00:00:00")
    monkeypatch.setattr(daily, broken, whole)
    daily.run_daily(spark, tmp, "2024-01-31 02:00:00", upto="2024-01-15 00:00:00")
    daily.run_daily(spark, tmp, "2024-01-31 03:00:00")
    runs = daily.committed(spark, tmp, "daily_batch")
    assert sorted(r["run"] for r in runs.collect()) == ["2024-01-31 02:00:00", "2024-01-31 03:00:00"]
    flights = daily.read_flights(spark, tmp, runs, "2024-01-31 03:00:00")
    number = flights.select("flight_number").distinct().count()
    assert flights.filter("is_current").count() == number and flights.select("flight_key").distinct().count() == flights.count()
    fact = daily.read_fact(spark, tmp)
    assert fact.count() == spark.read.parquet(f"{tmp}/silver/price_5min").count()
    assert fact.filter("flight_key is null or airline_key is null or date_key is null").count() == 0
    assert daily.run_daily(spark, tmp, "2024-01-31 04:00:00")["gold_rows"] == 0
    daily.check_and_audit(spark, tmp, "2024-01-30 12:00:00")
    assert spark.read.parquet(f"{tmp}/control/audit_log").count() == 1


def test_array_files_of_any_size_and_element_rejects(spark, tmp):
    from pricelens.sources import documents as d
    os.makedirs(f"{tmp}/stage")
    one = {"flight_date": "2024-01-01", "departure": {"iata": "ORD"}, "flight": {"iata": "UA1"}, "extra": [1, {"x": "é]}\"\\"}]}
    with open(f"{tmp}/stage/a.json", "w") as f:
        f.write(" [" + ", ".join(json.dumps(x) for x in [one, 42, "s,]", None, [1], {}, one]) + " ]\n")
    with open(f"{tmp}/stage/big.json", "w") as f:
        f.write("[" + ",\n".join(json.dumps({**one, "flight_date": f"2024-01-{i % 28 + 1:02d}", "pad": "x" * 500}) for i in range(20_000)) + "]")
    with open(f"{tmp}/stage/cut.json", "w") as f:
        f.write(json.dumps([one, one])[:-30])
    with open(f"{tmp}/stage/none.json", "w") as f:
        f.write("{}")
    good, bad = d.load_documents(spark, f"{tmp}/stage", "2024-01-02 00:00:00")
    count = {os.path.basename(r["file_path"]): r["count"] for r in good.groupBy("file_path").count().collect()}
    assert count == {"a.json": 3, "big.json": 20_000, "cut.json": 1}
    reasons = sorted((os.path.basename(r["file_path"]), r["position"], r["reason"]) for r in bad.collect())
    assert reasons == [("a.json", 1, "not_an_object"), ("a.json", 2, "not_an_object"), ("a.json", 3, "not_an_object"), ("a.json", 4, "not_an_object"),
                       ("cut.json", 1, "array_not_closed"), ("none.json", 0, "not_an_array")]


def test_operating_airline_and_model_from_a_file(spark, tmp):
    from pricelens.operators.semantic import MODEL, load_model, semantic_query
    from pricelens.sources.documents import operating_airline
    df = spark.createDataFrame([("BA", "AA"), (None, "AA"), ("", "AA")], "c string, m string")
    assert [r[0] for r in df.select(operating_airline(F.col("c"), F.col("m"))).collect()] == ["BA", "AA", "AA"]
    pytest.importorskip("yaml")
    with open(f"{tmp}/m.yaml", "w") as f:
        f.write("tables:\n- name: hourly_route_summary\n  dimensions:\n  - {name: season}\n  measures:\n  - {name: avg_price, default_aggregation: avg}\n")
    rows = spark.createDataFrame([("S", 10.0), ("S", 20.01)], "season string, avg_price double")
    got = [semantic_query(rows, m["hourly_route_summary"], ["avg_price"], ["season"]).first()[1] for m in (MODEL, load_model(f"{tmp}/m.yaml"))]
    assert got == [15.01, 15.01]
