"""Star-schema dimensions.

Nothing here collects members to the driver: new members are an anti-join,
surrogate keys a distributed dense index, SCD2 versions a per-key scan split
into time chunks (see ``operators.sequence``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import calendar as cal
from pricelens.functions.lookups import OPEN_END, alliance, is_domestic
from pricelens.operators.dedup import keep_best
from pricelens.operators.sequence import carry
from pricelens.session import store

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | row index


def new_members(df: DataFrame, dim: DataFrame, key: list[str] | str,
                attrs: list[str] | None = None) -> DataFrame:
    """Distinct members of ``df`` (NULL keys dropped) absent from ``dim``
    (E19 + D5).  ``attrs`` are carried with the key (first by attrs order)."""
    keys = [key] if isinstance(key, str) else list(key)
    cand = df.select(*keys, *(attrs or [])).dropna(subset=keys)
    if attrs:
        cand = cand.groupBy(*keys).agg(F.min(F.struct(*attrs)).alias("_a")) \
            .select(*keys, *[F.col(f"_a.{a}").alias(a) for a in attrs])
    else:
        cand = cand.distinct()
    return cand.join(dim.select(*keys).distinct(), keys, "left_anti")


def dense_index(df: DataFrame, order: list[str], out: str = "_idx",
                partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (must be unique), computed
    without a single-partition window: rows are range-partitioned, sorted,
    numbered inside their partition and written to the shared folder; each
    row's index is its partition's offset (a running count over one row per
    partition, a table bounded by the partition count) plus its number.  Both
    the counts and the rows are read from that one copy, so they always fit."""
    ranged = (df.repartitionByRange(*([partitions] if partitions else []), *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    stored = store(ranged.withColumn("_pid", pid)
                   .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS)), "dense")
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    return (stored.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_mid", "_pid", "_local", "_off"))


def next_key(dim: DataFrame, key_col: str, start: int) -> Column:
    """Scalar: one past the dimension's largest key, or ``start`` if empty."""
    return F.coalesce(dim.agg((F.max(key_col) + 1).alias("k")).scalar(), F.lit(start))


def assign_keys(new: DataFrame, dim: DataFrame, key_col: str, natural: list[str],
                start: int) -> DataFrame:
    """Surrogate keys for new members, continuing after the dimension's
    largest key in natural-key order, so keys never repeat across runs."""
    idx = dense_index(new, natural)
    return idx.withColumn(key_col, (next_key(dim, key_col, start) + F.col("_idx")).cast("int")) \
        .drop("_idx")


# ------------------------------------------------------------------ dim_date
DIM_DATE_COLUMNS = ["date_key", "date", "day_of_week", "day_number", "is_weekend",
                    "month", "quarter", "is_us_holiday", "season"]


def date_rows(dates: DataFrame, date_col: str = "date",
              holidays: list[str] | None = None) -> DataFrame:
    d = F.col(date_col).cast("date")
    return dates.select(
        cal.date_key(d).alias("date_key"), cal.date_str(d).alias("date"),
        cal.day_name(d).alias("day_of_week"), cal.day_number(d).alias("day_number"),
        cal.is_weekend(d).alias("is_weekend"), F.month(d).alias("month"),
        F.quarter(d).alias("quarter"), cal.is_holiday(d, holidays).alias("is_us_holiday"),
        cal.season(d).alias("season"))


def dim_date_new(df: DataFrame, dim: DataFrame, ts_col: str = "window_start",
                 holidays: list[str] | None = None) -> DataFrame:
    """New dim_date rows for the dates of ``df[ts_col]``."""
    dates = df.select(cal.date_str(F.to_date(F.col(ts_col))).alias("date"))
    return date_rows(new_members(dates, dim, "date"), "date", holidays)


# -------------------------------------------------------------- dim_airlines
DIM_AIRLINE_COLUMNS = ["airline_key", "airline_code", "airline_name", "alliance", "is_domestic"]


def dim_airlines_new(df: DataFrame, dim: DataFrame, start: int = 1000) -> DataFrame:
    """New carriers with surrogate keys, alliance and domestic flag."""
    new = new_members(df, dim, "airline_code", ["airline_name"])
    keyed = assign_keys(new, dim, "airline_key", ["airline_code"], start)
    return keyed.select("airline_key", "airline_code", "airline_name",
                        alliance(F.col("airline_code")).alias("alliance"),
                        is_domestic(F.col("airline_code")).alias("is_domestic"))


# ---------------------------------------------------------------------- SCD2
DIM_FLIGHT_COLUMNS = ["flight_key", "flight_number", "route_id", "origin", "destination",
                      "airline_code", "effective_date", "expiry_date", "is_current"]


def _changed(prev: Column, cols: list[str]) -> Column:
    diff = F.lit(False)
    for c in cols:
        diff = diff | ~F.col(c).eqNullSafe(prev[c])
    return prev.isNull() | diff


def scd2_versions(rows: DataFrame, natural: list[str], tracked: list[str],
                  effective: str, chunk_unit: str = "month") -> DataFrame:
    """Collapse a history of (natural key, tracked attrs, effective date) rows
    into validity intervals: a version starts where the tracked attributes
    differ (NULL-safe) from the previous row of the key; it ends where the
    next version starts, or is open (``9999-12-31``)."""
    eff = F.col(effective).cast("date")
    chunk = F.date_trunc(chunk_unit, eff.cast("timestamp"))
    r = rows.withColumn("_eff", eff)
    prev = carry(r, natural, ["_eff"], F.struct(*[F.col(c) for c in tracked]), chunk,
                 "_prev", inclusive=False)
    starts = prev.filter(_changed(F.col("_prev"), tracked)).drop("_prev")
    nxt = carry(starts, natural, ["_eff"], F.col("_eff"), F.date_trunc(
        chunk_unit, F.col("_eff").cast("timestamp")), "_next", inclusive=False, reverse=True)
    return (nxt.withColumn("effective_date", cal.date_str(F.col("_eff")))
            .withColumn("expiry_date", F.coalesce(cal.date_str(F.col("_next")), F.lit(OPEN_END)))
            .withColumn("is_current", F.col("_next").isNull())
            .drop("_eff", "_next"))


def scd2_build(history: DataFrame, natural: list[str], tracked: list[str], effective: str,
               key_col: str, start: int = 2000, tie: str | None = None) -> DataFrame:
    """Full SCD2 dimension from a history: one row per (key, day) -- the last
    by ``tie`` -- then versions, then surrogate keys by (key, effective)."""
    day = history.withColumn("_day", F.col(effective).cast("date"))
    order = [(tie, True)] if tie else [(effective, True)]
    last = keep_best(day, [*natural, "_day"], order)
    v = scd2_versions(last.select(*natural, *tracked, "_day"), natural, tracked, "_day")
    empty = v.sparkSession.createDataFrame([], f"{key_col} int")
    return assign_keys(v, empty, key_col, [*natural, "effective_date"], start)


def scd2_apply(dim: DataFrame, updates: DataFrame, natural: list[str], tracked: list[str],
               effective: str, key_col: str, start: int = 2000,
               keys_in_use: DataFrame | None = None) -> DataFrame:
    """Apply a batch of updates to an SCD2 dimension (P5).

    Unchanged members are untouched; a changed member's current row is closed
    at the change date and a new current row opened; several changes in one
    batch keep every intermediate version; updates dated at or before the
    member's current effective date are already applied (re-running a batch
    changes nothing).  ``dim`` may hold the current rows alone; then
    ``keys_in_use`` names the keys of all rows, so that none is used again."""
    other = [c for c in dim.columns if c not in (key_col, "effective_date", "expiry_date",
                                                 "is_current", *natural, *tracked)]
    cur = dim.filter(F.col("is_current"))
    closed = dim.filter(~F.col("is_current"))
    u = updates.withColumn("_d", F.col(effective).cast("date"))
    newer = (u.join(cur.select(*natural, F.col("effective_date").cast("date").alias("_cur")),
                    natural, "left")
             .filter(F.col("_cur").isNull() | (F.col("_d") > F.col("_cur")))
             .select(*natural, *tracked, *other, "_d", F.lit(None).cast("int").alias(key_col),
                     F.lit(1).alias("_src")))
    cur_in = cur.select(*natural, *tracked, *other,
                        F.col("effective_date").cast("date").alias("_d"),
                        F.col(key_col), F.lit(0).alias("_src"))
    seq = keep_best(cur_in.unionByName(newer), [*natural, "_d"],
                    [("_src", True)])  # one row per key and day, the update wins
    # stored: read for the rows that keep their key and for those that get one
    v = store(scd2_versions(seq, natural, tracked, "_d").drop("_d"), "versions")
    keep = v.filter(F.col(key_col).isNotNull())
    fresh = assign_keys(v.filter(F.col(key_col).isNull()).drop(key_col), dim if keys_in_use is None else keys_in_use, key_col,
                        [*natural, "effective_date"], start)
    cols = dim.columns
    return closed.select(*cols).unionByName(keep.select(*cols)).unionByName(fresh.select(*cols))


def join_point_in_time(fact: DataFrame, dim: DataFrame, natural: list[str], date_col: str,
                       how: str = "left", chunk_unit: str = "month") -> DataFrame:
    """Join each fact row to the version valid on its date:
    ``effective_date <= date < expiry_date`` (D8); at most one match because
    a key's versions have disjoint intervals.  ``how``: left or inner.

    Versions are carried along the dates of their key onto the facts, so the
    work is facts + versions, also on a hot key with many versions, where an
    equi-join with the interval as its filter makes facts x versions; the
    scan is cut by ``chunk_unit``.  A fact with a null key or no date matches
    nothing; such rows are dealt over chunks by their hash."""
    if how not in ("left", "inner"):
        raise ValueError("a point-in-time join is left or inner")
    keys = [f"_k{i}" for i in range(len(natural))]
    attrs = [c for c in dim.columns if c not in natural]
    day = F.col(date_col).try_cast("date")
    no_match = day.isNull()
    for k in natural:
        no_match = no_match | F.col(k).isNull()
    scattered = F.timestamp_seconds(F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(100_000)) * 86_400)
    facts = fact.select(*[F.col(k).alias(n) for k, n in zip(natural, keys, strict=True)], day.alias("_day"), F.lit(1).alias("_rank"),
                        F.when(no_match, scattered).otherwise(F.date_trunc(chunk_unit, day.cast("timestamp"))).alias("_at"),
                        F.struct(*[F.col(c) for c in fact.columns]).alias("_fact"))
    since = F.col("effective_date").cast("date")
    versions = dim.select(*[F.col(k).alias(n) for k, n in zip(natural, keys, strict=True)], since.alias("_day"), F.lit(0).alias("_rank"),
                          F.date_trunc(chunk_unit, since.cast("timestamp")).alias("_at"),
                          F.struct(*[F.col(c) for c in attrs]).alias("_version")).dropna(subset=keys)
    both = facts.unionByName(versions, allowMissingColumns=True)
    found = carry(both, keys, ["_day", "_rank"], "_version", "_at", "_valid").where("_rank = 1")
    valid = F.col("_day") < F.col("_valid.expiry_date").cast("date")  # null: no version so far, or no date
    if how == "inner":
        found = found.where(valid)
    return found.select("_fact.*", *[F.when(valid, F.col(f"_valid.{c}")).alias(c) for c in attrs])
