"""Keyed upsert that adds (J13, B6): stored sums grow by each batch's sums.

Sums must not be added twice, and a streaming micro-batch is delivered again
whenever its run was lost before the checkpoint took note of it.  So each
write names its batch, and the name is part of the one commit that puts the
new sums in force (``sinks.versions``): the table and the ledger of applied
batches cannot disagree.  A batch already in the ledger adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.sinks.versions import applied, read_live, replace


def add_batch(spark: SparkSession, updates: DataFrame, path: str, keys: list[str], merged: dict[str, Callable],
              partition: str, batch: str) -> bool:
    """Adds ``updates`` (one row a key) to the stored rows: ``merged`` maps each
    other column to the function that merges its values, such as F.sum.
    Partitions without an update keep their files.  Only the rows of touched
    partitions are read.  NULL keys are keys like any other.  ``updates`` is
    read twice: persist it where that is costly.  False where the ledger has
    the batch already, or where there is nothing to add."""
    if applied(spark, path, batch):
        return False
    lo, hi = updates.agg(F.min(partition), F.max(partition)).first()
    if lo is None:
        return False
    old = read_live(spark, path, updates.schema, partition, F.col(partition).between(F.lit(lo), F.lit(hi)))
    old = old.join(updates.select(partition).distinct(), partition, "left_semi").select(*updates.columns)
    total = old.unionByName(updates).groupBy(*keys, partition).agg(*[f(n).alias(n) for n, f in merged.items()])
    replace(total.select(*[F.col(f.name).cast(f.dataType) for f in updates.schema]), path, partition, batch=batch)
    return True
