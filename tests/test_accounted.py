"""Streams that lose no tick and count none twice."""

import pytest
from pyspark.sql import functions as F

from pricelens.operators.windows import window_agg
from pricelens.sinks.additive import add_batch
from pricelens.sinks.versions import applied, live, read_live
from pricelens.sources.events import TICK_SCHEMA
from pricelens.sources.tables import columns
from pricelens.streaming import accounted
from pricelens.streaming.ticks import await_all, write_messages

SUMS = columns("flight string, n long, day date")


def sums(spark, *rows):
    return spark.createDataFrame(list(rows), "flight string, n long, d string").select("flight", "n", F.col("d").cast("date").alias("day"))


def test_a_batch_is_added_once_and_leaves_other_partitions_alone(spark, tmp):
    path, how = f"{tmp}/t", {"n": F.sum}
    stored = lambda: sorted(((r.flight, r.n, str(r.day)) for r in read_live(spark, path, SUMS, "day").collect()), key=str)
    assert add_batch(spark, sums(spark, ("A", 1, "2024-01-01"), (None, 2, "2024-01-01"), ("A", 3, "2024-01-03")), path, ["flight"], how, "day", "s:0")
    before = {r.part: r.version for r in live(spark, path).collect()}
    assert add_batch(spark, sums(spark, ("A", 10, "2024-01-01"), (None, 20, "2024-01-01"), ("B", 5, "2024-01-02")), path, ["flight"], how, "day", "s:1")
    want = sorted([("A", 11, "2024-01-01"), (None, 22, "2024-01-01"), ("B", 5, "2024-01-02"), ("A", 3, "2024-01-03")], key=str)
    assert stored() == want
    after = {r.part: r.version for r in live(spark, path).collect()}
    assert before["2024-01-03"] == after["2024-01-03"] and before["2024-01-01"] != after["2024-01-01"]
    assert not add_batch(spark, sums(spark, ("A", 10, "2024-01-01")), path, ["flight"], how, "day", "s:1")  # delivered again
    assert not add_batch(spark, sums(spark), path, ["flight"], how, "day", "s:2")
    assert stored() == want and applied(spark, path, "s:0") and not applied(spark, path, "s:2")


def message(spark, rows):
    """(flight, price, event time, arrival) as ticks."""
    df = spark.createDataFrame(rows, "flight_number string, price_usd double, event_timestamp long, ingestion_timestamp long")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit("x").cast(f.dataType).alias(f.name) for f in TICK_SCHEMA.fields])


def run(spark, tmp, **options):
    await_all(accounted.start_accounted(spark, f"{tmp}/src", f"{tmp}/out", f"{tmp}/ckpt", **options))


FIRST = [("F1", 1.0, 1000, 1000), ("F1", 3.0, 1100, 1100), ("F2", 5.0, 2000, 2000)]
# the watermark is 1880 now: the window up to 1800 has ended, that up to 2100 has not
SECOND = [("F1", 2.0, 1150, 1160), ("F2", 6.0, 2010, 2020), ("F2", 7.0, 1801, 1810), ("F1", 9.0, 1000, 1121), ("F1", 4.0, 1001, 1121), ("F3", 6.0, 5000, 5000)]


def test_every_tick_has_one_route(spark, tmp):
    write_messages(message(spark, FIRST), f"{tmp}/src")
    run(spark, tmp)
    write_messages(message(spark, SECOND), f"{tmp}/src")
    run(spark, tmp)
    got = {(r.flight_number, r.event_timestamp, r.ingestion_timestamp): (r.watermark, r.route) for r in accounted.read_routed(spark, f"{tmp}/out").collect()}
    second = ["dropped", "on_time", "on_time", "late", "dropped", "on_time"]
    assert got == {(f, e, i): (None, "on_time") for f, _, e, i in FIRST} | {(f, e, i): (1880, way) for (f, _, e, i), way in zip(SECOND, second, strict=True)}
    late = {(r.flight_number, r.route): (r.n_ticks, r.most_late_s) for r in accounted.late_by_window(spark, f"{tmp}/out").collect()}
    assert late == {("F1", "dropped"): (2, 120), ("F1", "late"): (1, 121)}
    windows = {(r.flight_number, r.window_start.timestamp()): (r.message_count, r.avg_price_usd) for r in accounted.read_windows(spark, f"{tmp}/out").collect()}
    assert windows == {("F1", 900): (2, 2.0), ("F2", 1800): (3, 6.0), ("F3", 4800): (1, 6.0)}


@pytest.mark.parametrize("step", ["ticks", "windows", "marks"])
def test_a_micro_batch_lost_between_its_steps_is_counted_once(spark, tmp, monkeypatch, step):
    write_messages(message(spark, FIRST), f"{tmp}/src")
    run(spark, tmp, catch_up=True)
    write_messages(message(spark, SECOND), f"{tmp}/src")

    def lost(real, hit):
        def call(*args, **kw):
            out = real(*args, **kw)
            if hit(args):
                raise RuntimeError("driver lost")  # the step is done, what follows is not
            return out
        return call

    with monkeypatch.context() as m:
        if step == "windows":
            m.setattr(accounted, "add_batch", lost(accounted.add_batch, lambda a: True))
        else:
            m.setattr(accounted, "_own", lost(accounted._own, lambda a: a[1].endswith(step)))
        with pytest.raises(Exception, match="driver lost"):
            run(spark, tmp, catch_up=True)
    run(spark, tmp, catch_up=True)
    run(spark, tmp, catch_up=True)
    cols = ["flight_number", "window_start", "window_end", "avg_price_usd", "min_price_usd", "max_price_usd", "message_count", "sum_cents", "priced_count"]
    want = window_agg(message(spark, FIRST + SECOND), ["flight_number"], priced=True).select(*cols)
    got = accounted.read_windows(spark, f"{tmp}/out").select(*cols)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert accounted.read_routed(spark, f"{tmp}/out").count() == len(FIRST) + len(SECOND)
