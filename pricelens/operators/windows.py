"""Event-time window aggregation.

``groupBy(keys, window)`` runs as a partial (map-side) + final hash aggregate,
so a hot key is pre-combined per input partition before the shuffle; prices
are summed as integer cents so panes and late corrections merge exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, TimestampType

from pricelens.functions.money import avg_usd, cents_to_usd, to_cents
from pricelens.functions.timefn import instant


def event_time(df: DataFrame, ts_col: str) -> Column:
    """Timestamp view of an epoch-seconds or timestamp(_ntz) column."""
    t = df.schema[ts_col].dataType
    if isinstance(t, (LongType, IntegerType)):
        return instant(F.col(ts_col))
    if isinstance(t, TimestampType):
        return F.col(ts_col)  # keeps a streaming watermark attached
    return F.col(ts_col).cast("timestamp")


def window_agg(df: DataFrame, keys: list[str], ts_col: str = "event_timestamp",
               value_col: str = "price_usd", width: str = "5 minutes",
               slide: str | None = None, attrs: list[str] | None = None,
               order_cols: list[str] | None = None, minmax: bool = True,
               extra: dict[str, Column] | None = None,
               priced: bool = False) -> DataFrame:
    """One row per (keys, window): ``window_start``/``window_end`` (end
    exclusive), avg/min/max price (2 decimals, exact; over the messages that
    carry a price), ``message_count`` and ``sum_cents``.  ``attrs`` are taken from the group's earliest event,
    ties broken by ``order_cols`` (must end in a unique column).  ``extra``
    maps output names to further aggregate expressions.

    Attributes are never grouping columns, so a flight whose route changes
    inside a window still has one row."""
    attrs = list(attrs or [])
    ts = event_time(df, ts_col)
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    cents = to_cents(F.col(value_col))
    aggs = [F.sum(cents).alias("sum_cents"), F.count(F.lit(1)).alias("message_count"),
            F.count(cents).alias("priced_count")]
    if minmax:
        aggs += [F.min(cents).alias("_min_c"), F.max(cents).alias("_max_c")]
    if attrs:
        order = F.struct(*[F.col(c) for c in (order_cols or [ts_col])])
        aggs.append(F.min_by(F.struct(*[F.col(a) for a in attrs]), order).alias("_first"))
    extra = dict(extra or {})
    aggs += [e.alias(n) for n, e in extra.items()]
    g = df.groupBy(*[F.col(k) for k in keys], w.alias("_w")).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"_first.{a}").alias(a) for a in attrs]
    cols += [F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
             avg_usd(F.col("sum_cents"), F.col("priced_count")).alias("avg_price_usd")]
    if minmax:
        cols += [cents_to_usd(F.col("_min_c")).alias("min_price_usd"),
                 cents_to_usd(F.col("_max_c")).alias("max_price_usd")]
    cols += [F.col("message_count"), F.col("sum_cents")] + [F.col(n) for n in extra]
    cols += [F.col("priced_count")] if priced else []  # the state that merge_windows needs
    return g.select(*cols)


def sliding_agg(df: DataFrame, keys: list[str], ts_col: str, value_col: str, width_s: int, slide_s: int,
                attrs: list[str], order_cols: list[str], latest: dict[str, str] | None = None,
                minmax: bool = False) -> DataFrame:
    """Sliding windows from shared panes (E2, J4), with ``window_agg``'s
    columns; ``latest`` maps output names to columns whose maximum is kept.

    A tick is counted once, in its pane (a tumbling window as long as the
    slide).  A window is made at its first pane that has ticks: the frame of
    panes from there to the window's end gives its sums, and that pane its
    attributes.  So each window comes out once, with no row per tick and
    window and no second aggregation; a key has one row a pane, however many
    ticks it has.  Batch only: a stream keeps its windows in state."""
    if width_s % slide_s:
        raise ValueError("the width must be a multiple of the slide")
    latest = dict(latest or {})
    panes = window_agg(df, keys, ts_col, value_col, f"{slide_s} seconds", attrs=attrs, order_cols=order_cols, minmax=minmax,
                       extra={n: F.max(c) for n, c in latest.items()}, priced=True)
    panes = panes.withColumn("_at", F.unix_timestamp("window_start"))
    path = Window.partitionBy(*keys).orderBy("_at")
    merged = {"sum_cents": F.sum, "message_count": F.sum, "priced_count": F.sum, **{n: F.max for n in latest}}
    if minmax:
        merged |= {"min_price_usd": F.min, "max_price_usd": F.max}
    starts = []
    for back in range(0, width_s, slide_s):  # the window that starts ``back`` seconds before the pane
        to_end = path.rangeBetween(0, width_s - slide_s - back)
        starts.append(F.struct((F.col("_at") - back).alias("_start"), *[f(n).over(to_end).alias(n) for n, f in merged.items()]))
    before = F.lag("_at").over(path)
    made = panes.select(*keys, *attrs, before.alias("_before"), F.array(*starts).alias("_made"))
    made = made.select(*keys, *attrs, "_before", F.explode("_made").alias("_w")).where(F.col("_before").isNull() | (F.col("_w._start") > F.col("_before")))
    return made.select(
        *keys, *attrs, instant(F.col("_w._start")).alias("window_start"), instant(F.col("_w._start") + width_s).alias("window_end"),
        avg_usd(F.col("_w.sum_cents"), F.col("_w.priced_count")).alias("avg_price_usd"),
        *[F.col(f"_w.{n}").alias(n) for n in ("min_price_usd", "max_price_usd") if minmax],
        *[F.col(f"_w.{n}").alias(n) for n in ("message_count", "sum_cents", *latest, "priced_count")])


def merge_windows(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Merge partial window states (e.g. an on-time aggregate and the late
    ticks' aggregate) into the aggregate over all their ticks (J13)."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    g = u.groupBy(*keys, "window_start", "window_end").agg(
        F.sum("sum_cents").alias("sum_cents"),
        F.sum("message_count").alias("message_count"),
        F.sum("priced_count").alias("priced_count"),
        F.min("min_price_usd").alias("min_price_usd"),
        F.max("max_price_usd").alias("max_price_usd"))
    return g.select(*keys, "window_start", "window_end",
                    avg_usd(F.col("sum_cents"), F.col("priced_count")).alias("avg_price_usd"),
                    "min_price_usd", "max_price_usd", "message_count", "sum_cents")


def window_start_of(epoch_s: Column, width_s: int) -> Column:
    """Start of the tumbling window holding an epoch instant (epoch aligned)."""
    return instant(epoch_s - F.pmod(epoch_s, F.lit(width_s)))
