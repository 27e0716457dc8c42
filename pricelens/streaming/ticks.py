"""Tick stream -> Silver with Structured Streaming.

One source definition fans out to three queries, each with its own
checkpoint: tumbling 5-minute windows, sliding 1-hour windows (both
event-time, 120 s watermark, update mode = accumulating panes) and the late
side output.  Sinks are ``foreachBatch`` writers keyed by ``batch_id``: a
replayed micro-batch overwrites its own partition, so the table is exactly
once even though delivery is at least once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelens.functions.lookups import ALLOWED_LATENESS_S
from pricelens.operators.late import late_rows, split_late
from pricelens.operators.windows import window_agg
from pricelens.sinks.versions import read_live
from pricelens.sinks.writers import upsert_best
from pricelens.sources.events import TICK_SCHEMA, parse_events
from pricelens.functions.timefn import instant
from pricelens.sources.tables import columns, list_files

FILE_ROWS = 50_000  # messages a slice's file has at least, where a slice has several files
WATERMARK = f"{ALLOWED_LATENESS_S} seconds"
ATTRS_5MIN = ["flight_number", "route_id", "origin", "destination", "airline_code",
              "airline_name"]
ATTRS_1HR = ["flight_number", "route_id", "origin", "destination", "airline_code"]


def read_ticks(spark: SparkSession, source: str, max_files: int | None = None,
               fmt: str = "text", arrival_fallback: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) streaming frames from a folder of JSON-line tick
    messages (A1; the same parse works on a Kafka ``value``).  Accepted ticks
    get ``event_time`` and a watermark (J1, J6).  A tick without an event time
    is rejected, or with ``arrival_fallback`` (a null or 0 counts as none)
    takes its time of arrival instead."""
    r = spark.readStream.format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.load(source)
    good, bad = parse_events(raw, "value", TICK_SCHEMA,
                             times=["ingestion_timestamp"] if arrival_fallback else None)
    if arrival_fallback:
        good = good.withColumn("event_timestamp", F.coalesce(
            F.nullif("event_timestamp", F.lit(0)), "ingestion_timestamp"))
    good = (good.withColumn("event_time", instant(F.col("event_timestamp")))
            .withWatermark("event_time", WATERMARK))
    return good, bad


def _batch_sink(path: str, stamp: bool = True):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("batch_id", F.lit(batch_id))
        if stamp:  # J10: one processing time per micro-batch
            out = out.withColumn("processing_timestamp", F.current_timestamp())
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return write


def _stream_windows(on_time, keys, width, slide, attrs, minmax) -> DataFrame:
    """One row per (keys, window); the attributes are those of the earliest
    tick (ties: the least values), whatever the grain."""
    keys = keys or ["flight_number"]
    rest = [a for a in attrs if a not in keys]
    return window_agg(on_time, keys, "event_time", "price_usd", width, slide, attrs=rest,
                      order_cols=["event_timestamp", "ingestion_timestamp", *rest], minmax=minmax, priced=True)


def fixed_windows(on_time: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return _stream_windows(on_time, keys, "5 minutes", None, ATTRS_5MIN, True)


def sliding_windows(on_time: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return _stream_windows(on_time, keys, "1 hour", "15 minutes", ATTRS_1HR, False)


def start_tick_queries(spark: SparkSession, source: str, out: str, checkpoint: str,
                       trigger: str = "availableNow", mode: str = "update",
                       keys: list[str] | None = None,
                       max_files: int | None = None) -> list[StreamingQuery]:
    """Start the three branches; ``trigger`` is ``availableNow`` (one
    catch-up run, A7 REFRESH) or a processing-time interval like
    ``"30 seconds"``."""
    good, bad = read_ticks(spark, source, max_files)
    on_time, late = split_late(good)
    branches = {
        "price_5min": (fixed_windows(on_time, keys), mode, True),
        "price_1hr": (sliding_windows(on_time, keys), mode, True),
        "late_arrivals": (late_rows(late.drop("event_time")).drop("processing_timestamp"),
                          "append", True),
        "rejected": (bad, "append", False),
    }
    qs = []
    for name, (df, out_mode, stamp) in branches.items():
        w = (df.writeStream.outputMode(out_mode).foreachBatch(_batch_sink(os.path.join(out, name),
                                                                          stamp))
             .option("checkpointLocation", os.path.join(checkpoint, name))
             .queryName(f"{name}_{abs(hash(out)) % 10**8}"))
        w = w.trigger(availableNow=True) if trigger == "availableNow" else \
            w.trigger(processingTime=trigger)
        qs.append(w.start())
    return qs


def _reject_query(bad: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Dead letters of a stream: raw text and reason, each message once."""
    return (bad.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_upsert(spark: SparkSession, source: str, target: str, checkpoint: str,
                 trigger: str = "availableNow",
                 max_files: int | None = None) -> list[StreamingQuery]:
    """J12 + B6: micro-batch upsert of 5-minute panes into a parquet table,
    keeping the pane with most messages then the latest processing time."""
    good, bad = read_ticks(spark, source, max_files)
    on_time, _ = split_late(good)
    agg = fixed_windows(on_time)
    rejects = _reject_query(bad, f"{target}-rejected", f"{checkpoint}-rejected")

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for its bounds and for its rows: the state is updated once
        b = (batch.withColumn("processing_timestamp", F.current_timestamp())
             .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
             .withColumn("window_date", F.to_date("window_start")))
        upsert_best(batch.sparkSession, b, target, ["flight_number", "window_start"],
                    [("message_count", True), ("processing_timestamp", True),
                     ("batch_id", True)], "window_date")
        batch.unpersist()

    w = (agg.writeStream.outputMode("update").foreachBatch(merge)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else \
        w.trigger(processingTime=trigger)
    return [w.start(), rejects]


UPSERTED_SCHEMA = columns(
    "flight_number string, route_id string, origin string, destination string, airline_code string, airline_name string, window_start timestamp, "
    "window_end timestamp, avg_price_usd double, min_price_usd double, max_price_usd double, message_count bigint, sum_cents bigint, "
    "priced_count bigint, processing_timestamp timestamp, batch_id bigint, window_date date")


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """The table that ``start_upsert`` keeps, as of its last commit."""
    return read_live(spark, target, UPSERTED_SCHEMA, "window_date")


def start_file_pipe(spark: SparkSession, source: str, table: str,
                    checkpoint: str) -> list[StreamingQuery]:
    """Continuous ingestion that loads every file exactly once (the file
    source's checkpoint records processed files); one ``availableNow`` run is
    a REFRESH."""
    good, bad = read_ticks(spark, source)
    return [good.drop("event_time").writeStream.format("parquet").outputMode("append")
            .option("path", table).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(),
            _reject_query(bad, f"{table}-rejected", f"{checkpoint}-rejected")]


def start_dedup(spark: SparkSession, source: str, table: str, checkpoint: str,
                keys: list[str] | None = None) -> list[StreamingQuery]:
    """Drop at-least-once redeliveries of a tick within the watermark."""
    good, bad = read_ticks(spark, source)
    d = good.dropDuplicatesWithinWatermark(keys or ["flight_number", "event_timestamp"])
    return [d.drop("event_time").writeStream.format("parquet").outputMode("append")
            .option("path", table).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(),
            _reject_query(bad, f"{table}-rejected", f"{checkpoint}-rejected")]


def write_messages(ticks: DataFrame, path: str, files: int = 8, copies: int = 1) -> None:
    """Write ticks as JSON-line messages (the broker's payload), ``copies``
    times (at-least-once redelivery)."""
    fields = [f.name for f in TICK_SCHEMA.fields if f.name in ticks.columns]
    msgs = ticks.select(F.to_json(F.struct(*fields)).alias("value"))
    for i in range(copies):
        msgs.repartition(files).write.mode("append").text(path)


def files_per_slice(ticks: DataFrame, cuts: list[int], most: int = 64) -> int:
    """How many files ``write_slices`` can write for every slice, one for each
    FILE_ROWS messages or so.  Rows are dealt to files in turn, so a partition
    with that many rows of a slice leaves no file of it out; where some slice
    has no such partition, one file."""
    at = F.lit(0)
    for cut in cuts:
        at = at + (F.col("event_timestamp") >= cut).cast("int")
    rows = ticks.select(at.alias("slice"), F.spark_partition_id().alias("part")).groupBy("slice", "part").count()
    found = rows.where("slice is not null").groupBy("slice").agg(F.sum("count").alias("n"), F.max("count").alias("dealt")).collect()  # one row a slice
    if len(found) <= len(cuts):
        return 1
    return max(1, min(most, *[min(r["n"] // FILE_ROWS, r["dealt"]) for r in found]))


def write_slices(ticks: DataFrame, path: str, cuts: list[int], files: int = 1) -> None:
    """Messages in event-time order, ``files`` files for each slice between
    ``cuts`` (epoch seconds), written one slice after the other: a file source
    takes files by their modification time, so with ``files`` of them at a time
    each slice becomes a micro-batch in order.  More than one: see
    ``files_per_slice``."""
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        part = ticks
        if lo is not None:
            part = part.filter(F.col("event_timestamp") >= lo)
        if hi is not None:
            part = part.filter(F.col("event_timestamp") < hi)
        write_messages(part, path, files=files)
    if files > 1 and (n := list_files(ticks.sparkSession, path, "*.txt").count()) != files * (len(cuts) + 1):
        raise RuntimeError(f"{n} files for {len(cuts) + 1} slices of {files}")


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that came after their window's state was gone, over all micro-batches (Q9)."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def await_all(queries: list[StreamingQuery], timeout_s: int | None = None) -> None:
    """Wait for every query's end.  A failed query raises, and so does one
    that still runs after ``timeout_s`` (None: no limit), so a half-written
    table is never taken for the result."""
    for q in queries:
        ended = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if not ended:
            raise TimeoutError(f"streaming query {q.name or q.id} still runs after {timeout_s} s")
