"""Tables replaced by one commit, stored moments, refresh of what changed, null keys across chunks."""

import os
import statistics

import pytest
from pyspark.sql import functions as F

from pricelens.operators import anomaly, serving
from pricelens.operators.late import reconcile
from pricelens.operators.sequence import carry
from pricelens.operators.windows import window_agg
from pricelens.plans import daily, q_serving, q_star
from pricelens.sinks import versions, writers
from pricelens.sources.tables import columns

ROWS = "k long, n long, day string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def stored(spark, path, partition="day"):
    return sorted(tuple(r) for r in versions.read_live(spark, path, columns(ROWS), partition).collect())


# ------------------------------------------------------------------ commits
def test_only_committed_versions_are_read(spark, tmp):
    path = f"{tmp}/t"
    assert stored(spark, path) == []
    versions.replace(table(spark, (1, 1, "a"), (2, 1, "b")), path, "day")
    versions.replace(table(spark, (3, 2, "b")), path, "day")
    assert stored(spark, path) == [(1, 1, "a"), (3, 2, "b")]
    versions.replace(table(spark, (4, 1, None)), path, "day", touched=spark.createDataFrame([("a",)], "day string"))
    assert sorted(stored(spark, path), key=str) == [(3, 2, "b"), (4, 1, None)]
    assert versions.vacuum(spark, path) == 1 and sorted(stored(spark, path), key=str) == [(3, 2, "b"), (4, 1, None)]


@pytest.mark.parametrize("step", ["data", "commit"])
def test_an_upsert_lost_between_its_steps_changes_nothing_and_repeats(spark, tmp, monkeypatch, step):
    path, order = f"{tmp}/t", [("n", True)]
    writers.upsert_best(spark, table(spark, (1, 1, "a"), (2, 1, "a"), (3, 1, "b")), path, ["k"], order, "day")
    before, batch = stored(spark, path), table(spark, (1, 5, "a"), (9, 1, "c"))
    whole = versions._commits

    def lost(*a):
        raise OSError("driver lost")

    if step == "data":  # before anything of the batch is written
        monkeypatch.setattr(writers, "replace", lost)
    else:               # after its rows are, before the commit
        calls = []
        monkeypatch.setattr(versions, "_commits", lambda *a: lost() if len(calls) else calls.append(1) or whole(*a))
    with pytest.raises(OSError):
        writers.upsert_best(spark, batch, path, ["k"], order, "day")
    monkeypatch.undo()
    assert stored(spark, path) == before
    for _ in range(2):  # the retry, and a replay
        writers.upsert_best(spark, batch, path, ["k"], order, "day")
        assert stored(spark, path) == [(1, 5, "a"), (2, 1, "a"), (3, 1, "b"), (9, 1, "c")]
    assert versions.vacuum(spark, path) == (1 if step == "data" else 2) and len(stored(spark, path)) == 4


@pytest.mark.parametrize("partition", ["day", None])
def test_a_delete_lost_before_its_commit_changes_nothing(spark, tmp, monkeypatch, partition):
    path, schema = f"{tmp}/t", columns(ROWS)
    rows = [(1, 1, "a"), (2, None, "a"), (3, 1, "b"), (4, 2, "c")]
    versions.replace(table(spark, *rows), path, partition)
    first = versions.live(spark, path).count()

    def lost(*a, **k):
        raise OSError("driver lost")

    monkeypatch.setattr(writers, "replace", lost)
    with pytest.raises(OSError):
        writers.delete_where(spark, path, F.col("n") == 1, schema, partition)
    monkeypatch.undo()
    assert stored(spark, path, partition) == rows
    writers.delete_where(spark, path, F.col("n") == 1, schema, partition)
    assert stored(spark, path, partition) == [(1, 1, "a"), (3, 1, "b")]  # NULL deletes, an emptied partition is empty
    assert versions.live(spark, path).count() == first


# ------------------------------------------------------------------ moments
def test_moments_merge_to_the_statistics_of_all_rows(spark):
    values = [("F1", 10.01), ("F1", None), ("F1", 20.02), ("F1", 99999.99), ("F2", 3.0), ("F3", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(values, "k string, avg_price_usd double")
    parts = [anomaly.moments(df.where(F.col("avg_price_usd") < 15), "k"), anomaly.moments(df.where("avg_price_usd >= 15 or avg_price_usd is null"), "k")]
    got = {r["k"]: (r["rolling_mean"], r["rolling_stddev"]) for r in anomaly.moment_stats(anomaly.merge_moments(parts, "k"), "k").collect()}
    one = [10.01, 20.02, 99999.99]
    assert got["F1"] == pytest.approx((statistics.mean(one), statistics.stdev(one)), rel=1e-14)
    assert got["F2"] == (3.0, None) and got["F3"] == (None, None) and got[None] == pytest.approx((1.5, statistics.stdev([1, 2])))


def test_a_window_that_fires_again_replaces_itself(spark):
    schema = "k string, w int, message_count long, processing_timestamp int, avg_price_usd double"
    counted = spark.createDataFrame([("F", 1, 2, 5, 10.0), ("F", 2, 3, 5, 20.0), ("F", 3, 1, 5, 7.0)], schema)
    new = spark.createDataFrame([("F", 1, 4, 9, 11.0), ("F", 1, 3, 8, 99.0), ("F", 2, 3, 5, 20.0), ("F", 3, 1, 4, 8.0), ("F", 4, 1, 9, 5.0)], schema)
    entered = sorted((r["w"], r["avg_price_usd"], r["_sign"]) for r in anomaly.newly_best(new, counted, ["k", "w"]).collect())
    assert entered == [(1, 10.0, -1), (1, 11.0, 1), (4, 5.0, 1)]
    state = anomaly.merge_moments([anomaly.moments(counted, "k"), anomaly.moments(anomaly.newly_best(new, counted, ["k", "w"]), "k", sign=F.col("_sign"))], "k")
    assert [tuple(int(x) for x in r[1:]) for r in state.collect()] == [(4, 4300, 1100 ** 2 + 2000 ** 2 + 700 ** 2 + 500 ** 2)]


def test_a_daily_run_reads_only_new_hourly_windows(spark, monkeypatch):
    root = q_star.arriving_tables(spark, "/root/testdata/sf0.001")
    before = spark.read.parquet(f"{root}/silver/price_1hr").count()
    read = []
    whole = daily.newly_best
    monkeypatch.setattr(daily, "newly_best", lambda inc, counted, key: read.append((inc.count(), counted.count())) or whole(inc, counted, key))
    extra = spark.read.parquet(f"{root}/silver/price_1hr").orderBy(F.col("window_start").desc()).limit(3)
    later = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    extra.withColumn("message_count", F.col("message_count") + 1).withColumn("processing_timestamp", later).withColumn("avg_price_usd", F.lit(1.0)) \
        .write.mode("append").parquet(f"{root}/silver/price_1hr")
    spark.read.parquet(f"{root}/silver/price_5min").limit(1).withColumn("processing_timestamp", later).write.mode("append").parquet(f"{root}/silver/price_5min")
    daily.run_daily(spark, root, "2024-03-01 01:00:00")
    assert read[0][0] == 3 and read[0][1] < before / 10
    recount = anomaly.baseline_stats(daily.keep_best(spark.read.parquet(f"{root}/silver/price_1hr"), ["flight_number", "window_start"]), "flight_number")
    both = daily.read_baselines(spark, root, "2024-03-01 01:00:00").alias("a").join(recount.alias("b"), "flight_number")
    assert both.count() == recount.count()
    assert both.where("abs(a.rolling_mean - b.rolling_mean) > 1e-9 or abs(coalesce(a.rolling_stddev, -1) - coalesce(b.rolling_stddev, -1)) > 1e-7").count() == 0


# ------------------------------------------------------------------ refresh
def test_a_refresh_rebuilds_only_touched_partitions(spark, tmp):
    path = f"{tmp}/hourly"
    months = q_serving.refreshed(spark, "/root/testdata/sf0.001", path)
    assert months[2] == 1 and months[0] > 10 and months[1] > 10
    files = lambda: {f for _, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}
    before = files()
    source = spark.read.parquet(f"{path}-source")
    again = serving.refresh_changed(spark, source, lambda r: r, path, "month", f"{path}-marks", "hourly", "1999-01-01 04:00:00")
    assert again == 0 and files() == before
    assert versions.vacuum(spark, path) == 0 and files() == before


# ------------------------------------------------------------- wrong before
def test_null_keys_are_carried_across_chunks(spark):
    rows = [(None, i, None if i % 4 else i) for i in range(12)] + [("a", 3, 30), ("a", 9, None)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = sorted((r["k"] or "", r["o"], r["p"]) for r in carry(df, ["k"], ["o"], "v", F.floor(F.col("o") / 3), "p").collect())
    assert got == [("", i, i // 4 * 4) for i in range(12)] + [("a", 3, 30), ("a", 9, 30)]


def test_windows_of_a_null_member_close_at_the_next_change(spark):
    from pricelens.operators.dims import scd2_build
    rows = [(None, "x", "2024-01-01", 1), (None, "y", "2025-02-01", 2), (None, "y", "2026-03-01", 3)]
    df = spark.createDataFrame(rows, "k string, v string, d string, i int").withColumn("d", F.to_date("d"))
    dim = scd2_build(df, ["k"], ["v"], "d", "key", 1, tie="i").orderBy("effective_date").collect()
    assert [(r["v"], r["expiry_date"], r["is_current"]) for r in dim] == [("x", "2025-02-01", False), ("y", "9999-12-31", True)]


def test_late_corrections_need_the_priced_count(spark):
    schema = "event_timestamp long, flight_number string, price_usd double"
    on_time = spark.createDataFrame([(1, "F1", 1.0), (2, "F1", None)], schema)
    late = spark.createDataFrame([(3, "F1", 3.0)], schema)
    assert reconcile(window_agg(on_time, ["flight_number"], priced=True), late, ["flight_number"]).first()["avg_price_usd"] == 2.0
    with pytest.raises(ValueError, match="priced_count"):
        reconcile(window_agg(on_time, ["flight_number"]), late, ["flight_number"])


def test_sketches_of_days_union_within_their_error(spark):
    n = 30_000
    df = spark.range(3 * n).select((F.col("id") % 7).alias("day"), (F.col("id") % n).alias("v"), F.lit("r").alias("r"))
    days = serving.distinct_sketches(df.withColumn("v", F.when(F.col("v") % 11 > 0, F.col("v"))), ["r", "day"], "v")
    exact = n - len(range(0, n, 11))
    assert abs(serving.distinct_estimate(days, ["r"]).first()["distinct_estimate"] - exact) < 0.05 * exact


def test_panes_make_each_sliding_window_once(spark):
    from pricelens.operators.windows import sliding_agg
    rows = [(i, t, float(i % 5) if i % 4 else None, k, f"a{i}", t + i % 3) for i, (k, t) in enumerate(
        [("x", t) for t in (0, 1, 899, 900, 901, 3599, 3600, 9000, 9001, 20_000)] + [(None, t) for t in (5, 5, 4000)])]
    df = spark.createDataFrame(rows, "event_id long, event_timestamp long, price_usd double, k string, a string, ing long")
    by = dict(attrs=["a"], order_cols=["event_timestamp", "event_id"])
    want = window_agg(df, ["k"], width="1 hour", slide="15 minutes", extra={"_p": F.max("ing")}, priced=True, **by)
    got = sliding_agg(df, ["k"], "event_timestamp", "price_usd", 3600, 900, latest={"_p": "ing"}, minmax=True, **by)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
