"""Per-key sequence scans that split hot keys by time.

``carry`` gives every row the last non-null ``value`` of its key at or before
it (or strictly before it, or after it with ``reverse``).  A single window
over the key would send a key holding a third of all rows to one task, so the
scan runs in two levels:

1. a window partitioned by (key, chunk) -- chunk is a time bucket, so a hot
   key is spread over as many tasks as it has chunks;
2. a small per-(key, chunk) table with each chunk's last value (a partial +
   final aggregate), carried across chunks by a window over chunk order;
   it has one row per key and chunk, not per input row.

Rows that found nothing inside their chunk take the carried value.  The
result is exact for any chunking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_STAND_IN = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


def carry(df: DataFrame, keys: list[str], order: list[str], value: Column | str,
          chunk: Column | str, out: str, inclusive: bool = True,
          reverse: bool = False) -> DataFrame:
    val = F.col(value) if isinstance(value, str) else value
    chk = F.col(chunk) if isinstance(chunk, str) else chunk
    base = df.withColumn("_val", val).withColumn("_chunk", chk)
    # a null key is a key like any other and crosses chunks too: equality holds on
    # (is null, value or stand-in) pairs, which both levels and the join are partitioned by
    names = []
    for i, k in enumerate([*keys, "_chunk"]):
        kind = base.schema[k].dataType
        stand_in = F.lit(_STAND_IN.get(kind.typeName(), 0)).cast(kind)
        base = base.withColumn(f"_null{i}", F.col(k).isNull()).withColumn(f"_at{i}", F.coalesce(F.col(k), stand_in))
        names.append([f"_null{i}", f"_at{i}"])
    key = [n for pair in names[:-1] for n in pair]
    at = [*key, *names[-1]]
    ordc = [F.col(c) for c in order]
    ordkey = F.struct(*ordc)
    if not reverse:
        w_in = Window.partitionBy(*at).orderBy(*ordc).rowsBetween(
            Window.unboundedPreceding, 0 if inclusive else -1)
        local = F.last("_val", ignorenulls=True).over(w_in)
        edge = F.max_by("_val", F.when(F.col("_val").isNotNull(), ordkey))
        w_chunk = Window.partitionBy(*key).orderBy(F.col(names[-1][0]).desc(), names[-1][1]).rowsBetween(
            Window.unboundedPreceding, -1)
        carried = F.last("_edge", ignorenulls=True).over(w_chunk)
    else:
        w_in = Window.partitionBy(*at).orderBy(*ordc).rowsBetween(
            0 if inclusive else 1, Window.unboundedFollowing)
        local = F.first("_val", ignorenulls=True).over(w_in)
        edge = F.min_by("_val", F.when(F.col("_val").isNotNull(), ordkey))
        w_chunk = Window.partitionBy(*key).orderBy(F.col(names[-1][0]).desc(), names[-1][1]).rowsBetween(
            1, Window.unboundedFollowing)
        carried = F.first("_edge", ignorenulls=True).over(w_chunk)
    edges = (base.groupBy(*at).agg(edge.alias("_edge"))
             .withColumn("_carried", carried).select(*at, "_carried"))
    scanned = base.withColumn("_local", local)
    return (scanned.join(edges, at, "left")
            .withColumn(out, F.coalesce(F.col("_local"), F.col("_carried")))
            .drop("_val", "_chunk", "_local", "_carried", *at))
