"""Keep-one-row-per-key operators.

Keep-best is written as ``max_by(row, ordering)`` rather than
``row_number() = 1``: an aggregate is partially combined before the shuffle,
so a key holding a third of all rows is reduced to one row per input
partition instead of being sorted in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordering(order: list[tuple[str, bool]]) -> tuple[Column, bool] | None:
    """(struct ordering, use_max) when all directions agree, else None."""
    dirs = {desc for _, desc in order}
    if len(dirs) != 1:
        return None
    return F.struct(*[F.col(c) for c, _ in order]), dirs.pop()


def keep_best(df: DataFrame, keys: list[str],
              order: list[tuple[str, bool]] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` ((column, descending)
    pairs).  Default = most messages, then latest processing time.  End
    ``order`` with a unique column for a deterministic pick."""
    order = order or [("message_count", True), ("processing_timestamp", True)]
    cols = df.columns
    spec = _ordering(order)
    if spec is None:  # mixed directions: ranked window, limited per group
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(c).desc() if d else F.col(c).asc() for c, d in order])
        return (df.withColumn("_rn", F.row_number().over(w))
                .filter(F.col("_rn") == 1).drop("_rn"))
    ordering, use_max = spec
    pick = F.max_by if use_max else F.min_by
    row = F.struct(*[F.col(c) for c in cols if c not in keys])
    g = df.groupBy(*keys).agg(pick(row, ordering).alias("_best"))
    return g.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in cols])


def first_per_key(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The first row of each key in ``position`` order."""
    return keep_best(df, keys, [(c, False) for c in position])


def top_keys(df: DataFrame, key: str, position: list[str], n: int = 20) -> DataFrame:
    """The ``n`` most frequent keys; ties by first occurrence.

    The count is a partial+final aggregate; ``orderBy().limit()`` becomes a
    per-partition top-n followed by a single n-row merge."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("frequency"),
                            F.min(F.struct(*[F.col(c) for c in position])).alias("_first"))
    return (g.orderBy(F.col("frequency").desc(), F.col("_first").asc())
            .limit(n).select(key, "frequency"))


def semi_join(df: DataFrame, keys_df: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows whose key is in ``keys_df`` (D7, EXISTS)."""
    return df.join(keys_df, on, "left_semi")
