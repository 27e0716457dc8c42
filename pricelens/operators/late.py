"""Late-data routing and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.lookups import ALLOWED_LATENESS_S
from pricelens.functions.timefn import instant
from pricelens.operators.windows import merge_windows, window_agg, window_start_of

LATE_COLUMNS = ["route_id", "flight_number", "origin", "destination", "airline_code",
                "price_usd", "flight_date"]


def lateness(event_col: str = "event_timestamp", ingest_col: str = "ingestion_timestamp"):
    return F.col(ingest_col) - F.col(event_col)


def split_late(df: DataFrame, event_col: str = "event_timestamp",
               ingest_col: str = "ingestion_timestamp",
               allowed_s: int = ALLOWED_LATENESS_S) -> tuple[DataFrame, DataFrame]:
    """(on_time, late): late iff ``ingest - event > allowed_s`` (strict).
    Two complementary filters over one plan; NULL times never reach here
    (rejected at parse time), so on_time + late = input."""
    is_late = lateness(event_col, ingest_col) > F.lit(allowed_s)
    return df.filter(~is_late), df.filter(is_late)


def late_rows(late: DataFrame, event_col: str = "event_timestamp",
              ingest_col: str = "ingestion_timestamp",
              extra: list[str] | None = None) -> DataFrame:
    """Late-arrivals table rows; processing time = ingestion time."""
    cols = [c for c in LATE_COLUMNS if c in late.columns] + list(extra or [])
    return late.select(
        *cols,
        instant(F.col(event_col)).alias("event_timestamp"),
        instant(F.col(ingest_col)).alias("ingestion_timestamp"),
        lateness(event_col, ingest_col).cast("bigint").alias("lateness_seconds"),
        instant(F.col(ingest_col)).alias("processing_timestamp"),
    )


def late_report(late: DataFrame, windows: DataFrame, keys: list[str],
                width_s: int = 300, event_col: str = "event_timestamp") -> DataFrame:
    """Every late tick with the window it belongs to and whether that window
    already exists downstream (P13 + D9).  ``most_late`` lists the worst."""
    existing = (windows.select(*keys, "window_start").distinct()
                .withColumn("window_exists", F.lit(True)))
    lr = late.withColumn("window_start", window_start_of(F.col(event_col), width_s))
    return (lr.join(existing, [*keys, "window_start"], "left")
            .withColumn("window_exists", F.coalesce(F.col("window_exists"), F.lit(False))))


def most_late(late: DataFrame, n: int = 10, event_col: str = "event_timestamp",
              ingest_col: str = "ingestion_timestamp", tie: list[str] | None = None) -> DataFrame:
    """The report's head: the ``n`` latest ticks, most late first."""
    by = lateness(event_col, ingest_col)
    return late.withColumn("lateness_seconds", by).orderBy(
        F.col("lateness_seconds").desc(), event_col, *(tie or [])).limit(n)


def reconcile(on_time_windows: DataFrame, late: DataFrame, keys: list[str],
              width: str = "5 minutes", ts_col: str = "event_timestamp",
              value_col: str = "price_usd") -> DataFrame:
    """Corrected windows = on-time window state merged with the late ticks'
    window state (J13); equal to aggregating on-time + late ticks together."""
    cols = [*keys, "window_start", "window_end", "min_price_usd", "max_price_usd",
            "message_count", "sum_cents", "priced_count"]
    if "priced_count" not in on_time_windows.columns:
        raise ValueError("the windows' priced_count is needed: an average cannot be corrected without it")
    late_w = window_agg(late, keys, ts_col, value_col, width, priced=True)
    return merge_windows([on_time_windows.select(*cols), late_w.select(*cols)], keys)
