"""A tick stream in which every tick is accounted for.

Spark's own window state drops a tick silently once the watermark has passed
its window.  Here the micro-batch decides and keeps: each tick takes one of
three routes, and all are stored with it.

    late      it arrived more than the allowed lateness after its event (J2)
    dropped   its window had ended at the watermark its micro-batch began with (J6)
    on_time   the rest

The watermark is the largest event time of all earlier micro-batches less the
delay.  Each micro-batch's largest event time is stored under its number, so a
micro-batch that is delivered again finds the same watermark, takes the same
routes and overwrites its own rows.

Windows are kept as sums, and each micro-batch's sums are added to them once
(``sinks.additive``): by the on-time ticks alone, or with ``catch_up`` by all,
so that late ticks correct windows stored long ago.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelens.functions.lookups import ALLOWED_LATENESS_S
from pricelens.functions.money import avg_usd
from pricelens.operators.late import lateness
from pricelens.operators.windows import window_agg, window_start_of
from pricelens.sinks.additive import add_batch
from pricelens.sinks.versions import read_live
from pricelens.sources.events import TICK_SCHEMA
from pricelens.sources.tables import columns, read_or_empty
from pricelens.streaming.ticks import read_ticks

ROUTES = ["on_time", "late", "dropped"]
MARKS = columns("max_event_timestamp long, stream string, batch_id long")
TICKS = columns(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TICK_SCHEMA.fields) + ", watermark long, route string, stream string, batch_id long")
WINDOWS = columns("flight_number string, window_start timestamp, window_end timestamp, min_price_usd double, max_price_usd double, "
                  "message_count long, sum_cents long, priced_count long, late_count long, window_date date")
MERGED = dict.fromkeys(["message_count", "sum_cents", "priced_count", "late_count"], F.sum) | {"min_price_usd": F.min, "max_price_usd": F.max}


def _own(df: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """Writes the micro-batch's rows in place of those of an earlier delivery."""
    out = df.withColumn("stream", F.lit(stream)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch_id").parquet(path)


def routed(ticks: DataFrame, watermark: int | None, width_s: int, allowed_s: int = ALLOWED_LATENESS_S) -> DataFrame:
    """The ticks with ``watermark`` (null before the first one) and ``route``."""
    end = F.col("event_timestamp") - F.pmod("event_timestamp", F.lit(width_s)) + width_s
    mark = F.lit(watermark).cast("long")
    route = F.when(lateness() > allowed_s, "late").when(end <= mark, "dropped").otherwise("on_time")
    return ticks.withColumns({"watermark": mark, "route": route})


def account(batch: DataFrame, stream: str, batch_id: int, out: str, delay_s: int, width_s: int, catch_up: bool) -> None:
    """One micro-batch; repeating it, at any point, gives the same tables."""
    spark = batch.sparkSession
    ticks = batch.persist()
    try:
        earlier = read_or_empty(spark, os.path.join(out, "marks"), MARKS).where((F.col("stream") == stream) & (F.col("batch_id") < batch_id))
        seen = earlier.agg(F.max("max_event_timestamp")).first()[0]
        ways = routed(ticks, None if seen is None else seen - delay_s, width_s)
        _own(ways, os.path.join(out, "ticks"), stream, batch_id)
        counted = ways if catch_up else ways.where("route = 'on_time'")
        sums = window_agg(counted, ["flight_number"], "event_timestamp", "price_usd", f"{width_s} seconds",
                          extra={"late_count": F.count_if(F.col("route") != "on_time")}, priced=True)
        sums = sums.withColumn("window_date", F.to_date("window_start")).select(*[F.col(f.name).cast(f.dataType) for f in WINDOWS]).persist()
        add_batch(spark, sums, os.path.join(out, "windows"), ["flight_number", "window_start", "window_end"], MERGED, "window_date", f"{stream}:{batch_id}")
        sums.unpersist()
        _own(ticks.agg(F.max("event_timestamp").cast("long").alias("max_event_timestamp")), os.path.join(out, "marks"), stream, batch_id)
    finally:
        ticks.unpersist()


def start_accounted(spark: SparkSession, source: str, out: str, checkpoint: str, delay_s: int = ALLOWED_LATENESS_S,
                    width_s: int = 300, catch_up: bool = False, trigger: str = "availableNow",
                    max_files: int | None = None) -> list[StreamingQuery]:
    """The accounted stream and its rejects.  Micro-batches are numbered anew
    by each new checkpoint, so they are named by the checkpoint's query."""
    good, bad = read_ticks(spark, source, max_files)

    def name_of(batch: DataFrame) -> str:
        return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")

    def take(batch: DataFrame, batch_id: int) -> None:
        account(batch.select(*TICK_SCHEMA.fieldNames()), name_of(batch), batch_id, out, delay_s, width_s, catch_up)

    def reject(batch: DataFrame, batch_id: int) -> None:
        _own(batch, os.path.join(out, "rejected"), name_of(batch), batch_id)

    def started(df: DataFrame, name: str, write) -> StreamingQuery:
        w = df.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(checkpoint, name))
        return (w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)).start()

    return [started(good, "ticks", take), started(bad, "rejected", reject)]


def read_routed(spark: SparkSession, out: str) -> DataFrame:
    """Every accepted tick with its route."""
    return read_or_empty(spark, os.path.join(out, "ticks"), TICKS)


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """The windows as of the last commit, with their average price."""
    stored = read_live(spark, os.path.join(out, "windows"), WINDOWS, "window_date")
    return stored.withColumn("avg_price_usd", avg_usd(F.col("sum_cents"), F.col("priced_count")))


def late_by_window(spark: SparkSession, out: str, width_s: int = 300) -> DataFrame:
    """The ticks that came late or were dropped, by window."""
    return (read_routed(spark, out).where("route != 'on_time'").withColumn("window_start", window_start_of(F.col("event_timestamp"), width_s))
            .groupBy("flight_number", "window_start", "route").agg(F.count(F.lit(1)).alias("n_ticks"), F.max(lateness()).alias("most_late_s")))
