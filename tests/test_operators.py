"""Operator unit tests on tiny frames (edge rows from FIXTURES.md section 5)."""

import math
import random

from pyspark.sql import functions as F

from pricelens.operators.anomaly import asof_baseline, baseline_stats, rolling_zscore, zscore
from pricelens.operators.dedup import first_per_key, keep_best, top_keys
from pricelens.operators.dims import (dense_index, dim_airlines_new, dim_date_new,
                                      join_point_in_time, scd2_apply)
from pricelens.operators.late import split_late
from pricelens.operators.sequence import carry
from pricelens.operators.windows import window_agg
from pricelens.plans.daily import DIM_AIRLINE_SCHEMA, DIM_DATE_SCHEMA
from pricelens.session import cut_lineage


def test_split_late_strict_bound(spark):
    rows = [(i, 1000, 1000 + d) for i, d in enumerate([119, 120, 121, 300, -5])]
    df = spark.createDataFrame(rows, "id int, event_timestamp long, ingestion_timestamp long")
    on_time, late = split_late(df)
    assert sorted(r.id for r in on_time.collect()) == [0, 1, 4]
    assert sorted(r.id for r in late.collect()) == [2, 3]


def test_tumbling_boundary_and_sliding_four_windows(spark):
    df = spark.createDataFrame([(1, "F1", 300, 10.0), (2, "F1", 299, 20.0)],
                               "event_id int, flight_number string, event_timestamp long, price_usd double")
    w = window_agg(df, ["flight_number"], width="5 minutes").orderBy("window_start").collect()
    assert [r.message_count for r in w] == [1, 1]          # 300 opens the next window
    s = window_agg(df.filter("event_id = 1"), ["flight_number"], width="1 hour",
                   slide="15 minutes")
    assert s.count() == 4


def test_average_is_exact_half_up(spark):
    df = spark.createDataFrame([(1, "F", 0, 1.00), (2, "F", 1, 1.01)],
                               "event_id int, flight_number string, event_timestamp long, price_usd double")
    r = window_agg(df, ["flight_number"]).first()
    assert r.avg_price_usd == 1.01 and r.sum_cents == 201 and r.min_price_usd == 1.0


def test_keep_best_rules(spark):
    df = spark.createDataFrame([
        ("F1", 0, 3, 10, 1), ("F1", 0, 5, 5, 2),              # more messages wins
        ("F2", 0, 4, 10, 3), ("F2", 0, 4, 20, 4),             # equal counts: later processing
    ], "flight_number string, window_start int, message_count int, processing_timestamp int, id int")
    got = {r.flight_number: r.id for r in keep_best(df, ["flight_number", "window_start"]).collect()}
    assert got == {"F1": 2, "F2": 4}
    mixed = keep_best(df, ["flight_number"], [("message_count", True), ("id", False)])
    assert {r.flight_number: r.id for r in mixed.collect()} == {"F1": 2, "F2": 3}


def test_top_keys_ties_by_first_position(spark):
    df = spark.createDataFrame([("B", 1), ("A", 2), ("A", 3), ("B", 4), ("C", 0)],
                               "route string, pos int")
    assert [r.route for r in top_keys(df, "route", ["pos"], 2).collect()] == ["B", "A"]
    first = first_per_key(df, ["route"], ["pos"])
    assert {r.route: r.pos for r in first.collect()} == {"A": 2, "B": 1, "C": 0}


def test_zscore_worked_example_and_edges(spark):
    base = spark.createDataFrame([("F", p) for p in [170.0, 190.0, 210.0, 180.0, 200.0]]
                                 + [("ONE", 100.0), ("FLAT", 5.0), ("FLAT", 5.0)],
                                 "flight_number string, avg_price_usd double")
    stats = baseline_stats(base, "flight_number")
    snap = spark.createDataFrame([("F", 211.0), ("F", 280.0), ("F", 450.0), ("F", None),
                                  ("ONE", 1.0), ("FLAT", 9.0), ("NONE", 3.0)],
                                 "flight_number string, avg_price_usd double")
    got = [(r.flight_number, r.avg_price_usd, r.z_score, r.is_anomaly)
           for r in zscore(snap, stats, "flight_number").collect()]
    d = {(f, p): (z, a) for f, p, z, a in got}
    assert d[("F", 211.0)] == (1.3282, False)
    assert d[("F", 280.0)] == (5.6921, True)
    assert d[("F", 450.0)] == (16.4438, True)
    assert d[("F", None)][1] is None
    assert d[("ONE", 1.0)] == (0.0, False) and d[("FLAT", 9.0)] == (0.0, False)
    assert d[("NONE", 3.0)] == (0.0, False)
    three = spark.createDataFrame([("T", 0.0), ("T", 2.0)], "flight_number string, avg_price_usd double")
    st = baseline_stats(three, "flight_number")  # mean 1, sd sqrt(2)
    p = 1 + 3 * math.sqrt(2)
    probe = spark.createDataFrame([("T", p)], "flight_number string, avg_price_usd double")
    r = zscore(probe, st, "flight_number").first()
    assert r.z_score == 3.0


def _brute_rolling(rows, seconds):
    out = {}
    for i, (k, t, v) in enumerate(rows):
        prev = [x for kk, tt, x in rows if kk == k and t - seconds <= tt <= t - 1]
        n = len(prev)
        if n < 2:
            z = 0.0
        else:
            m = sum(prev) / n
            sd = math.sqrt(sum((x - m) ** 2 for x in prev) / (n - 1))
            z = 0.0 if sd == 0 else abs(v - m) / sd
        out[i] = (round(z, 4), n)
    return out


def test_rolling_zscore_matches_brute_force_with_small_chunks(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("AB"), rnd.randint(0, 2000), float(rnd.randint(1, 500)))
            for _ in range(300)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id int, k string, t long, v double")
    want = _brute_rolling(rows, 400)
    for chunk in (None, 150, 1000):
        got = rolling_zscore(df, "k", "t", "v", seconds=400, chunk_seconds=chunk).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (round(r.z_score, 3), r.baseline_n) == (round(want[r.id][0], 3), want[r.id][1])


def test_carry_and_asof_match_brute_force(spark):
    rnd = random.Random(3)
    snaps = [(rnd.choice("XY"), rnd.randint(0, 100)) for _ in range(60)]
    trends = [(rnd.choice("XY"), rnd.randint(0, 100), float(i)) for i in range(40)]
    s = spark.createDataFrame(snaps, "k string, window_start long")
    t = spark.createDataFrame(trends, "k string, window_end long, avg_price_usd double")
    s = s.withColumn("window_start", F.timestamp_seconds("window_start")) \
         .withColumn("avg_price_usd", F.lit(1.0))
    t = t.withColumn("window_end", F.timestamp_seconds("window_end"))
    got = asof_baseline(s, t, ["k"], chunk="minute") \
        .withColumn("ws", F.unix_seconds("window_start")).collect()
    assert len(got) == len(snaps)
    for r in got:
        cands = [(e, v) for k, e, v in trends if k == r.k and e <= r.ws]
        if not cands:
            assert r.baseline_avg_price_usd is None
        else:
            best = max(c[0] for c in cands)
            assert r.baseline_avg_price_usd in {v for e, v in cands if e == best}
    lag = carry(spark.createDataFrame([("a", i, i * 10) for i in range(10)], "k string, o int, v int"),
                ["k"], ["o"], "v", F.floor(F.col("o") / 3), "prev", inclusive=False)
    assert {r.o: r.prev for r in lag.collect()} == {i: (None if i == 0 else (i - 1) * 10)
                                                    for i in range(10)}
    lead = carry(spark.createDataFrame([("a", i, i * 10) for i in range(10)], "k string, o int, v int"),
                 ["k"], ["o"], "v", F.floor(F.col("o") / 4), "nxt", inclusive=False, reverse=True)
    assert {r.o: r.nxt for r in lead.collect()} == {i: (None if i == 9 else (i + 1) * 10)
                                                    for i in range(10)}


def test_dense_index_is_contiguous(spark):
    df = spark.range(0, 1000).selectExpr("cast((id * 7919) % 1000 as long) as k").repartition(5)
    idx = dense_index(df, ["k"], out="i", partitions=4).collect()
    assert sorted(r.i for r in idx) == list(range(1000))
    assert all(r.i == r.k for r in idx)


def test_dim_date_rows(spark):
    ws = spark.createDataFrame([("2026-07-04 10:00:00",), ("2026-12-31 00:00:00",),
                                ("2026-01-05 00:00:00",), (None,)], "window_start string") \
        .withColumn("window_start", F.to_timestamp("window_start"))
    rows = {r.date: r for r in dim_date_new(ws, spark.createDataFrame([], DIM_DATE_SCHEMA)).collect()}
    assert set(rows) == {"2026-07-04", "2026-12-31", "2026-01-05"}
    j4 = rows["2026-07-04"]
    assert (j4.date_key, j4.day_of_week, j4.day_number, j4.is_weekend, j4.is_us_holiday,
            j4.season, j4.quarter) == (20260704, "Saturday", 5, True, True, "Summer", 3)
    assert rows["2026-12-31"].season == "Winter" and rows["2026-01-05"].day_number == 0


def test_dim_airlines_keys_continue_across_runs(spark):
    run1 = spark.createDataFrame([("UA", "United"), ("ZZ", "Zed")], "airline_code string, airline_name string")
    d1 = dim_airlines_new(run1, spark.createDataFrame([], DIM_AIRLINE_SCHEMA))
    got1 = {r.airline_code: r for r in d1.collect()}
    assert got1["UA"].airline_key == 1000 and got1["ZZ"].alliance == "None"
    assert got1["UA"].is_domestic and not got1["ZZ"].is_domestic
    run2 = spark.createDataFrame([("UA", "United"), ("AA", "American")], "airline_code string, airline_name string")
    d2 = dim_airlines_new(run2, d1).collect()
    assert [(r.airline_code, r.airline_key) for r in d2] == [("AA", 1002)]


SCD_SCHEMA = ("flight_key int, flight_number string, route_id string, airline_code string, "
              "effective_date string, expiry_date string, is_current boolean")


def _scd_updates(spark, rows):
    return spark.createDataFrame(rows, "flight_number string, route_id string, airline_code string, d string") \
        .withColumn("d", F.to_date("d"))


def test_scd2_apply_changes_and_idempotence(spark):
    dim0 = spark.createDataFrame([], SCD_SCHEMA)
    u1 = _scd_updates(spark, [("F1", "A-B", "UA", "2026-01-01"), ("F2", "C-D", "AA", "2026-01-01")])
    d1 = cut_lineage(scd2_apply(dim0, u1, ["flight_number"], ["route_id", "airline_code"], "d",
                                "flight_key"))
    u2 = _scd_updates(spark, [("F1", "A-B", "UA", "2026-01-02"),      # unchanged
                              ("F2", "C-E", "AA", "2026-01-02"),      # route changed
                              ("F2", "C-E", "DL", "2026-01-03"),      # changed again in batch
                              ("F3", "X-Y", "UA", "2026-01-03")])     # new
    d2 = cut_lineage(scd2_apply(d1, u2, ["flight_number"], ["route_id", "airline_code"], "d",
                                "flight_key"))
    rows = sorted((r.flight_number, r.effective_date, r.expiry_date, r.is_current, r.flight_key)
                  for r in d2.collect())
    assert rows == [
        ("F1", "2026-01-01", "9999-12-31", True, 2000),
        ("F2", "2026-01-01", "2026-01-02", False, 2001),
        ("F2", "2026-01-02", "2026-01-03", False, 2002),
        ("F2", "2026-01-03", "9999-12-31", True, 2003),
        ("F3", "2026-01-03", "9999-12-31", True, 2004),
    ]
    again = scd2_apply(d2, u2, ["flight_number"], ["route_id", "airline_code"], "d", "flight_key")
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in d2.collect())
    fact = spark.createDataFrame([("F2", "2026-01-02"), ("F2", "2026-01-03"), ("F2", "2025-12-31")],
                                 "flight_number string, date string")
    j = join_point_in_time(fact, d2.select("flight_number", "flight_key", "effective_date",
                                           "expiry_date"), ["flight_number"], "date")
    assert sorted((r.date, r.flight_key) for r in j.collect()) == [
        ("2025-12-31", None), ("2026-01-02", 2002), ("2026-01-03", 2003)]


def test_point_in_time_on_a_hot_key_is_linear_and_matches_brute_force(spark):
    # one key with 400 versions and 4,000 facts: an equi-join would make 1.6 million rows
    versions = spark.range(400).select(F.lit("H").alias("flight_number"), F.col("id").cast("int").alias("flight_key"),
                                       F.date_format(F.expr("date_add(date'2024-01-10', cast(id * 2 as int))"), "yyyy-MM-dd").alias("effective_date"),
                                       F.date_format(F.expr("date_add(date'2024-01-10', cast(id * 2 + 1 + id % 2 as int))"), "yyyy-MM-dd").alias("expiry_date"))
    facts = spark.range(4000).select("id", F.when(F.col("id") % 97 != 0, F.when(F.col("id") % 11 != 0, "H").otherwise("other")).alias("flight_number"),
                                     F.when(F.col("id") % 89 != 0, F.expr("date_add(date'2024-01-01', cast(id % 900 as int))").cast("string")).alias("date"))
    spans = [(r.effective_date, r.expiry_date, r.flight_key) for r in versions.collect()]
    want = {}
    for r in facts.collect():
        hit = [k for a, z, k in spans if r.flight_number == "H" and r.date is not None and a <= r.date < z]
        want[r.id] = hit[0] if hit else None
    joined = join_point_in_time(facts, versions, ["flight_number"], "date")
    assert joined.columns == ["id", "flight_number", "date", "flight_key", "effective_date", "expiry_date"]
    assert {r.id: r.flight_key for r in joined.collect()} == want and joined.count() == 4000
    inner = join_point_in_time(facts, versions, ["flight_number"], "date", how="inner")
    assert {r.id: r.flight_key for r in inner.collect()} == {i: k for i, k in want.items() if k is not None}
