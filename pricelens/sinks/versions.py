"""Tables whose partitions are replaced by one commit.

Parquet folders can only be replaced by deleting first and moving afterwards,
so a driver lost in between leaves a hole that a retry takes for the truth.
Here nothing is deleted by a write:

    <path>/data/version=<id>/[<partition>=<value>/]...   one folder per write
    <path>/commits/...                                   one small file per write

A write puts the new content of the partitions it touches in a folder of its
own and then appends one commit file that names these partitions.  Readers
take, for each partition, the version of the last commit; a folder without a
commit does not count.  A write that fails anywhere is simply repeated.  One
writer at a time is assumed, as for any table without a lock.  ``vacuum``
removes what no reader can reach any more.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricelens.sources.tables import columns, read_or_empty

_COMMIT = columns("part string, version string, seq long, batch string")


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, os.path.join(path, "commits"), _COMMIT)


def applied(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a commit of that batch is in force or superseded: the ledger of
    writes that must not be repeated."""
    return not _commits(spark, path).where(F.col("batch") == batch).isEmpty()


def live(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``version``: the version in force of every partition (a table
    without partitions has the one null part)."""
    last = Window.partitionBy("part").orderBy(F.col("seq").desc())
    return _commits(spark, path).withColumn("_n", F.row_number().over(last)).where("_n = 1").select("part", "version")


def read_live(spark: SparkSession, path: str, schema: StructType, partition: str | None = None,
              where: Column | None = None) -> DataFrame:
    """The table as of the last commit; ``where`` bounds the partition column,
    so that other folders are not listed into the scan.  Absent: empty."""
    full = StructType([*schema.fields, StructField("version", StringType(), False)])
    stored = read_or_empty(spark, os.path.join(path, "data"), full)
    if where is not None:
        stored = stored.where(where)
    part = F.col(partition).cast("string") if partition else F.lit(None).cast("string")
    now = live(spark, path).select(F.col("part").alias("_part"), F.col("version").alias("_version"))
    return (stored.join(now, (F.col("version") == F.col("_version")) & part.eqNullSafe(F.col("_part")), "left_semi")
            .select(*schema.fieldNames()))


def replace(df: DataFrame, path: str, partition: str | None = None, touched: DataFrame | None = None, batch: str | None = None) -> None:
    """``df`` becomes the content of the partitions it has rows in and of those
    in ``touched`` (a column of partition values), or of the whole table where
    there are none.  ``batch`` names the write in the ledger (``applied``)."""
    spark = df.sparkSession
    version = uuid.uuid4().hex
    folder = os.path.join(path, "data", f"version={version}")
    if partition:
        # few files a partition, and a large partition still over several tasks
        df.hint("rebalance", partition).write.partitionBy(partition).parquet(folder)
        parts = spark.read.schema(df.schema).parquet(folder).select(F.col(partition).cast("string").alias("part"))
        if touched is not None:
            parts = parts.union(touched.select(F.col(touched.columns[0]).cast("string")))
        parts = parts.distinct()
    else:
        df.write.parquet(folder)
        parts = spark.range(1).select(F.lit(None).cast("string").alias("part"))
    last = _commits(spark, path).agg(F.max("seq").alias("s")).first()["s"]
    commit = parts.select("part", F.lit(version).alias("version"), F.lit((last or 0) + 1).cast("long").alias("seq"), F.lit(batch).cast("string").alias("batch"))
    commit.coalesce(1).write.mode("append").parquet(os.path.join(path, "commits"))  # one file: all or nothing


def vacuum(spark: SparkSession, path: str) -> int:
    """Removes the version folders that no partition uses (superseded, or left
    by a failed write); returns how many.  Not beside a running reader or writer."""
    root = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "data"))
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return 0
    # folder names only: one for each write since the last vacuum
    names = [s.getPath().getName() for s in system.listStatus(root)]
    folders = spark.createDataFrame([(n,) for n in names if n.startswith("version=")], "name string")
    used = live(spark, path).select(F.concat(F.lit("version="), F.col("version")).alias("name")).distinct()
    gone = [r["name"] for r in folders.join(used, "name", "left_anti").collect()]
    for name in gone:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)
    return len(gone)
