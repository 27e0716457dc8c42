"""Batch sinks.

Writes go through Spark's committer, so a failed task or lost executor never
leaves partial files in the target; upserts and deletes write the touched
partitions as a new version that one commit puts in force (``versions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricelens.operators.dedup import keep_best
from pricelens.sinks.versions import read_live, replace
from pricelens.sources.tables import read_or_empty

MARK_SCHEMA = StructType([StructField("pipeline_name", StringType(), False),
                          StructField("last_processed_ts", StringType(), False),
                          StructField("updated_at", StringType(), False)])


def append(df: DataFrame, path: str, partition_by: list[str] | str | None = None,
           fmt: str = "parquet") -> None:
    """Append, creating the table if needed."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet",
              partition_by: list[str] | None = None) -> None:
    """Snapshot overwrite (B4, B11); with ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic partition overwrite)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def truncate(spark: SparkSession, path: str, schema: StructType) -> None:
    """TRUNCATE TABLE (B9): replace with an empty table of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def delete_where(spark: SparkSession, path: str, keep: F.Column, schema: StructType, partition: str | None = None) -> None:
    """DELETE ... WHERE not keep (B9) from a table of ``sinks.versions``: the
    partitions that hold such rows are written without them, then one commit
    puts these in force.  A NULL condition deletes."""
    kept = F.coalesce(keep, F.lit(False))
    rows = read_live(spark, path, schema, partition)
    if partition:
        hit = rows.filter(~kept).select(partition).distinct()
        same = rows.join(hit.withColumnRenamed(partition, "_hit"), F.col(partition).eqNullSafe(F.col("_hit")), "left_semi")
        replace(same.filter(kept), path, partition, touched=hit)
    else:
        replace(rows.filter(kept), path)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter evaluated by the next action (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def upsert_best(spark: SparkSession, updates: DataFrame, path: str, keys: list[str],
                order: list[tuple[str, bool]], partition: str) -> int:
    """Keyed upsert keeping the better row (B6) without MERGE, into a table of
    ``sinks.versions`` (read it with ``read_live``).

    Only partitions touched by ``updates`` are read (literal bounds of the
    partition column prune the target, a semi join picks the partitions
    between them), unioned with the updates, reduced once with ``keep_best``
    and written as a new version; one commit puts it in force, so a writer lost
    anywhere leaves the table as it was.  Replaying the same batch gives the
    same table.  ``updates`` is read several times: store or persist it where
    that is costly.  NULL keys are keys like any other.  Returns rows written."""
    lo, hi = updates.agg(F.min(partition), F.max(partition)).first()
    old = read_live(spark, path, updates.schema, partition, F.col(partition).between(F.lit(lo), F.lit(hi)))
    old = old.join(F.broadcast(updates.select(partition).distinct()), partition, "left_semi").select(*updates.columns)
    out, obs = counted(keep_best(old.unionByName(updates), keys, order))
    replace(out, path, partition)
    return int(obs.get["rows"])


def read_mark(spark: SparkSession, path: str, pipeline: str, default: str | None) -> str | None:
    """Last processed mark of ``pipeline`` (B8); ``default`` when none."""
    marks = read_or_empty(spark, path, MARK_SCHEMA)
    v = marks.filter(F.col("pipeline_name") == pipeline).agg(
        F.max("last_processed_ts").alias("m")).first()["m"]
    return default if v is None else v


def write_mark(spark: SparkSession, path: str, pipeline: str, mark: str, run_ts: str,
               more: dict[str, str] | None = None) -> None:
    """The run's mark, with ``more`` marks of its parts in the same file: all or none."""
    marks = {pipeline: mark, **(more or {})}
    append(spark.createDataFrame([(p, m, run_ts) for p, m in marks.items()], MARK_SCHEMA).coalesce(1), path)


def write_rejects(bad: DataFrame, path: str, run_ts: str) -> None:
    """Dead-letter sink (B10): rejected rows with their reason."""
    append(bad.withColumn("rejected_at", F.lit(run_ts)), path)
