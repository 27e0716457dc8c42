"""Z-score anomaly scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.lookups import Z_THRESHOLD
from pricelens.functions.money import cents_to_usd, to_cents
from pricelens.operators.sequence import carry


def baseline_stats(df: DataFrame, key: str | list[str], value: str = "avg_price_usd") -> DataFrame:
    """Per-key mean and sample stddev (one row -> NULL stddev)."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.avg(value).alias("rolling_mean"),
                                 F.stddev_samp(value).alias("rolling_stddev"))


def moments(df: DataFrame, key: str, value: str = "avg_price_usd", sign: Column | None = None) -> DataFrame:
    """Per key the mergeable state of a baseline: ``n``, ``s`` (sum of cents)
    and ``q`` (sum of their squares), exact.  ``sign`` (1 or -1 a row) takes
    replaced rows out again."""
    cents, one = to_cents(F.col(value)), sign if sign is not None else F.lit(1)
    wide = cents.cast("decimal(19,0)")
    return df.groupBy(key).agg(F.coalesce(F.sum(F.when(cents.isNotNull(), one)), F.lit(0)).cast("bigint").alias("n"),
                               F.coalesce(F.sum(wide * one), F.lit(0)).cast("decimal(38,0)").alias("s"),
                               F.coalesce(F.sum(wide * wide * one), F.lit(0)).cast("decimal(38,0)").alias("q"))


def merge_moments(parts: list[DataFrame], key: str) -> DataFrame:
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(key).agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("q").cast("decimal(38,0)").alias("q"))


def moment_stats(state: DataFrame, key: str) -> DataFrame:
    """The columns of ``baseline_stats`` from merged moments."""
    n = F.col("n").cast("double")
    spread = (F.col("n").cast("decimal(19,0)") * F.col("q") - F.col("s") * F.col("s")).cast("double")  # n^2 times the variance, exact
    return state.select(key, F.when(n > 0, F.col("s").cast("double") / n / 100).alias("rolling_mean"),
                        F.when(n > 1, F.sqrt(spread / (n * (n - 1))) / 100).alias("rolling_stddev"))


def newly_best(rows: DataFrame, counted: DataFrame, keys: list[str], value: str = "avg_price_usd",
               order: tuple[str, ...] = ("message_count", "processing_timestamp")) -> DataFrame:
    """Rows that enter a baseline (``_sign`` 1) and the rows they replace (-1):
    of each key the best new row, if it beats the best one ``counted`` so far."""
    cols = [*order, value]
    u = rows.select(*keys, F.struct(*cols).alias("_r"), F.lit(True).alias("_new")).unionByName(
        counted.select(*keys, F.struct(*cols).alias("_r"), F.lit(False).alias("_new")))
    best = u.groupBy(*keys).agg(F.max(F.when(F.col("_new"), F.col("_r"))).alias("_in"), F.max(F.when(~F.col("_new"), F.col("_r"))).alias("_out"))
    rank = lambda c: F.struct(*[F.col(f"{c}.{o}") for o in order])
    won = best.where(F.col("_in").isNotNull() & (F.col("_out").isNull() | (rank("_in") > rank("_out"))))
    return won.select(*keys, F.explode(F.array(F.struct(F.col("_in").alias("r"), F.lit(1).alias("_sign")),
                                               F.struct(F.col("_out").alias("r"), F.lit(-1).alias("_sign")))).alias("e")) \
        .where("e.r is not null").select(*keys, *[F.col(f"e.r.{c}").alias(c) for c in cols], F.col("e._sign").alias("_sign"))


def _z(value: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise(F.abs(value - mean) / sd)


def score(df: DataFrame, value: str, mean: str = "rolling_mean", sd: str = "rolling_stddev",
          threshold: float = Z_THRESHOLD, digits: int = 4) -> DataFrame:
    """Adds ``z_score`` (rounded) and ``is_anomaly`` (z > threshold, strict;
    NULL when the value is NULL)."""
    z = _z(F.col(value), F.col(mean), F.col(sd))
    return (df.withColumn("_z", z)
            .withColumn("is_anomaly", F.when(F.col(value).isNull(), F.lit(None).cast("boolean"))
                        .otherwise(F.col("_z") > F.lit(threshold)))
            .withColumn("z_score", F.round(F.col("_z"), digits)).drop("_z"))


def zscore(df: DataFrame, stats: DataFrame, key: str | list[str], value: str = "avg_price_usd",
           threshold: float = Z_THRESHOLD, digits: int = 4) -> DataFrame:
    """Left-join per-key stats and score (P6).  ``stats`` has one row per key,
    so the join never changes the row count."""
    return score(df.join(stats, key, "left"), value, threshold=threshold, digits=digits)


_LOW = 31  # bits of a square that are summed apart, so that sums of squares stay in two longs


def rolling_zscore(df: DataFrame, key: str, ts_col: str, value: str,
                   seconds: int = 7 * 86400, exclude_current: bool = True,
                   chunk_seconds: int | None = None, threshold: float = Z_THRESHOLD,
                   digits: int = 4) -> DataFrame:
    """Each row scored against the same key's rows in ``[ts - seconds,
    ts - 1]`` (F2; ``exclude_current=False`` makes it ``[ts - seconds, ts]``).

    Count, sum and sum of squares in whole cents are summed per (key, second),
    and time is cut into chunks as long as the frame, so a frame lies in its
    own chunk and the one before.  Every second enters its chunk when it comes
    and leaves the next chunk, which starts with the sums of this one, when the
    frame has passed it: one running total per (key, chunk), exact in integers
    and linear in the rows.  A partition has two rows a second at most, however
    many rows a hot key has.  A row without a time has no baseline.
    ``chunk_seconds`` is accepted from earlier callers; the frame's length now
    sets the chunks, and no chunking changes a result."""
    cents = to_cents(F.col(value))
    square = cents * cents
    sums = ["_n", "_s", "_high", "_low"]
    per = df.where(F.col(ts_col).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(ts_col).alias("_row")).agg(
        F.count(cents).alias("_n"), F.coalesce(F.sum(cents), F.lit(0)).alias("_s"),
        F.coalesce(F.sum(F.shiftright(square, _LOW)), F.lit(0)).alias("_high"),
        F.coalesce(F.sum(square.bitwiseAND(F.lit((1 << _LOW) - 1))), F.lit(0)).alias("_low"))
    chunk = F.floor(F.col("_row") / F.lit(seconds)).cast("long")
    last = -1 if exclude_current else 0
    moves = per.select("_key", "_row", *sums, F.explode(F.array(
        F.struct(F.lit(True).alias("enters"), chunk.alias("chunk"), F.col("_row").alias("at")),
        F.struct(F.lit(False).alias("enters"), (chunk + 1).alias("chunk"), (F.col("_row") + seconds + 1 + last).alias("at")))).alias("_m"))
    moves = moves.select("_key", "_row", *sums, "_m.*")
    path = Window.partitionBy("_key", "chunk")
    so_far = path.orderBy("at").rangeBetween(Window.unboundedPreceding, last)

    def frame(c: str) -> Column:
        left = F.coalesce(F.sum(F.when(F.col("enters"), F.col(c)).otherwise(-F.col(c))).over(so_far), F.lit(0))
        return F.coalesce(F.sum(F.when(~F.col("enters"), F.col(c))).over(path), F.lit(0)) + left

    frames = moves.select("_key", "_row", "enters", *[frame(c).alias(c) for c in sums]).where("enters")
    n, total, wide = F.col("_n").cast("double"), F.col("_s").cast("double"), lambda c: F.col(c).cast("decimal(19,0)")
    squares = wide("_high") * F.lit(1 << _LOW).cast("decimal(10,0)") + wide("_low")
    spread = (wide("_n") * squares - wide("_s") * wide("_s")).cast("double")  # n^2 times the variance, exact
    stats = frames.select(
        "_key", "_row", F.col("_n").alias("baseline_n"), F.when(n > 0, total / n / 100).alias("rolling_mean"),
        F.when(n > 1, F.sqrt(spread / (n * (n - 1))) / 100).alias("rolling_stddev"))
    joined = df.join(stats, F.col(key).eqNullSafe(F.col("_key")) & (F.col(ts_col) == F.col("_row")), "left").drop("_key", "_row")
    joined = joined.withColumn("baseline_n", F.coalesce("baseline_n", F.lit(0).cast("long")))
    return score(joined, value, threshold=threshold, digits=digits)


def asof_baseline(snap: DataFrame, trend: DataFrame, keys: list[str],
                  snap_time: str = "window_start", trend_time: str = "window_end",
                  value: str = "avg_price_usd", chunk: str = "day") -> DataFrame:
    """For each snapshot row, the trend row of the same key with the greatest
    ``trend_time <= snap_time`` (D10); unmatched -> NULL baseline.

    Snapshots and trends are unioned on one time axis (trend before snapshot
    at equal times) and the latest trend is carried forward per key, split by
    ``chunk`` (a ``date_trunc`` unit) so a hot key is scanned in parallel."""
    s = snap.select(*keys, F.col(snap_time).alias("_t"), F.lit(1).alias("_kind"),
                    F.struct(*[F.col(c) for c in snap.columns]).alias("_snap"),
                    F.lit(None).cast(f"struct<baseline_window_end:timestamp,"
                                     f"baseline_avg_price_usd:double>").alias("_trend"))
    t = trend.select(*keys, F.col(trend_time).alias("_t"), F.lit(0).alias("_kind"),
                     F.lit(None).cast(s.schema["_snap"].dataType).alias("_snap"),
                     F.struct(F.col(trend_time).cast("timestamp").alias("baseline_window_end"),
                              F.col(value).alias("baseline_avg_price_usd")).alias("_trend"))
    u = s.unionByName(t)
    c = carry(u, keys, ["_t", "_kind"], "_trend", F.date_trunc(chunk, F.col("_t")), "_base")
    out = c.filter(F.col("_kind") == 1).select("_snap.*", "_base.*")
    dev = to_cents(F.col(value)) - to_cents(F.col("baseline_avg_price_usd"))
    return out.withColumn("deviation_usd", cents_to_usd(dev))
