"""Validated JSON message ingress.

A message is parsed once, into ``map<string,string>``: that single parse gives
the key set (presence test), JSON-null detection and the raw text of each
value, which is then ``try_cast`` to the declared type.  Every input row lands
in exactly one of (accepted, rejected); rejected rows keep ``raw`` and a
``reason`` in {malformed, not_object, missing_key, null_value, null_time,
bad_type}.  A tick without a time belongs to no window and has no lateness, so
it is rejected in both modes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DoubleType, LongType, MapType,
                               StringType, StructField, StructType)

TICK_SCHEMA = StructType([
    StructField("route_id", StringType()),
    StructField("origin", StringType()),
    StructField("destination", StringType()),
    StructField("airline_code", StringType()),
    StructField("airline_name", StringType()),
    StructField("flight_number", StringType()),
    StructField("price_usd", DoubleType()),
    StructField("flight_date", StringType()),
    StructField("scheduled_departure", StringType()),
    StructField("event_timestamp", LongType()),
    StructField("ingestion_timestamp", LongType()),
])

# --- fixed values: keys a tick must carry (presence, not non-nullness) ---
TICK_REQUIRED = ["route_id", "origin", "destination", "airline_code", "airline_name",
                 "price_usd", "event_timestamp", "ingestion_timestamp"]
# --- end of fixed values ---

TICK_TIMES = ["event_timestamp", "ingestion_timestamp"]  # must also have a value

_MAP = MapType(StringType(), StringType())


def tag_events(df: DataFrame, value_col: str = "value",
               schema: StructType = TICK_SCHEMA,
               required: list[str] | None = None,
               mode: str = "presence", times: list[str] | None = None,
               not_null: list[str] | None = None, defaults: dict | None = None) -> DataFrame:
    """All input columns + typed fields + ``raw`` + ``reason`` (NULL = good).
    ``not_null``: keys that, where present, need a value; ``defaults``: values
    of absent keys (both as ``message_schema`` gives them)."""
    if mode not in ("presence", "non_null"):
        raise ValueError(f"unknown mode {mode!r}")
    required = TICK_REQUIRED if required is None else list(required)
    src = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, BinaryType):
        src = F.decode(src, "UTF-8")
    fields = [f for f in schema.fields]
    out = df.withColumn("raw", src).withColumn("_m", F.from_json(F.col("raw"), _MAP))
    m = F.col("_m")
    typed = {f.name: (m[f.name] if isinstance(f.dataType, StringType)
                      else m[f.name].try_cast(f.dataType)) for f in fields}
    for k, v in (defaults or {}).items():
        typed[k] = F.when(m.isNotNull() & ~F.map_contains_key(m, k), F.lit(v).cast(schema[k].dataType)).otherwise(typed[k])
    req = F.array(*[F.lit(k) for k in required]) if required else F.array().cast("array<string>")
    bad_type = F.lit(False)
    for f in fields:
        bad_type = bad_type | (m[f.name].isNotNull() & typed[f.name].isNull())
    null_req = F.lit(False)
    for k in required:
        null_req = null_req | m[k].isNull()
    null_value = F.lit(False)
    for k in not_null or []:
        null_value = null_value | (F.map_contains_key(m, k) & m[k].isNull())
    no_time = F.lit(False)
    for k in times if times is not None else TICK_TIMES:
        if k in typed:
            no_time = no_time | typed[k].isNull()
    reason = (F.when(F.col("raw").isNull() | (m.isNull() & ~F.ltrim("raw").startswith("[")),
                     F.lit("malformed"))
              .when(m.isNull(), F.lit("not_object"))
              .when(F.size(F.array_except(req, F.map_keys(m))) > 0, F.lit("missing_key"))
              .when((F.lit(mode == "non_null") & null_req) | null_value, F.lit("null_value"))
              .when(bad_type, F.lit("bad_type"))
              .when(no_time, F.lit("null_time")))
    out = out.withColumn("reason", reason)
    for name, col in typed.items():
        out = out.withColumn(name, col)
    return out.drop("_m")


def parse_events(df: DataFrame, value_col: str = "value",
                 schema: StructType = TICK_SCHEMA,
                 required: list[str] | None = None,
                 mode: str = "presence",
                 times: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected).  ``accepted`` has the schema's fields, ``rejected``
    has ``raw`` and ``reason``; both come from one tagged plan."""
    tagged = tag_events(df, value_col, schema, required, mode, times)
    good = tagged.filter(F.col("reason").isNull()).select(*[f.name for f in schema.fields])
    bad = tagged.filter(F.col("reason").isNotNull()).select("raw", "reason")
    return good, bad
