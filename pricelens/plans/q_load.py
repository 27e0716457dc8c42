"""The schedule load from array files with faulty elements in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.plans.catalog import register, schedule, sql_schedule, with_
from pricelens.plans.q_routes import POS_PATHS
from pricelens.session import scratch_dir
from pricelens.sources.documents import SCHEDULE_PATHS, load_documents, project_text_documents, schedule_document
from pricelens.sources.tables import read_table
from pricelens.sources.views import SCHEDULE_POSITION

LOADED_AT = "1999-01-01 06:00:00"
LONG = 2000              # bytes an element of this load may have
FILE_ROWS = 50_000
KIND = "(pos_orderkey + 7 * pos_partkey + pos_linenumber) % 40"   # 0 .. 4: planted faults
ID = "concat_ws('-', pos_orderkey, pos_linenumber, pos_partkey, pos_suppkey)"
# kind -> (text of the element, reason)
FAULTS = {0: (f"""concat('{{"id":"', {ID}, '","a":tru}}')""", "malformed"),
          1: ("cast(pos_orderkey as string)", "not_an_object"),
          2: (f"""concat('{{"id":"', {ID}, '"}}}}')""", "malformed"),
          3: (f"""concat('{{"open":"', {ID}, chr(10), '}}')""", "malformed"),
          4: (f"""concat('{{"id":"', {ID}, '","pad":"', repeat('x', 3000), '"}}')""", "element_too_long")}


def stage_files(spark, sf_dir) -> str:
    """The schedule as array files, about FILE_ROWS elements each, with faults
    in the order of the rows' keys; each file ends with a document that says so.
    The files are gzip files: plain, they would be eight times as large."""
    n_files = max(2, -(-read_table(spark, sf_dir, "lineitem").count() // FILE_ROWS))
    rows = schedule(spark, sf_dir).withColumn("f", F.pmod(F.xxhash64(*SCHEDULE_POSITION), F.lit(n_files))).withColumn("part", F.lit(1))
    ends = spark.range(n_files).select(F.col("id").alias("f"), F.explode(F.array(F.lit(0), F.lit(2))).alias("part"))
    # the texts are made where the rows lie in order: the shuffle and the sort move columns
    placed = rows.unionByName(ends, allowMissingColumns=True).repartition(n_files, "f").sortWithinPartitions("f", "part", *SCHEDULE_POSITION)
    text = schedule_document(placed, {"position": F.struct(*[F.col(c) for c in SCHEDULE_POSITION])})
    for kind, (fault, _) in FAULTS.items():
        text = F.when(F.expr(f"{KIND} = {kind}"), F.expr(fault)).otherwise(text)
    value = F.when(F.col("part") == 0, "[").when(F.col("part") == 2, '{"end_of_file": true}]').otherwise(F.concat(text, F.lit(",")))
    path = scratch_dir(spark, "schedule-files")
    (placed.select("f", value.alias("value")).write.partitionBy("f")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))
    return path


def load(spark, sf_dir):
    return load_documents(spark, stage_files(spark, sf_dir), LOADED_AT, "*.txt.gz", range_bytes=1 << 20, longest=LONG)


@register("schedule_load", with_(sql_schedule()) + f"""
SELECT flight_date, flight_status, departure_iata, arrival_iata, departure_scheduled, airline_iata, flight_iata,
       TIMESTAMP '{LOADED_AT}' AS loaded_at, pos_orderkey, pos_linenumber, pos_partkey, pos_suppkey
FROM sched WHERE {KIND} > 4""")
def schedule_load(spark, sf_dir):
    """Array files, one in eight elements faulty, cut into byte
    ranges and loaded; every good element arrives, whatever stands before it."""
    rows, _ = load(spark, sf_dir)
    known = [n for n, _, _ in SCHEDULE_PATHS]
    positions = project_text_documents(rows.withColumn("raw", F.col("raw_json").cast("string")), "raw", POS_PATHS, keep=[*known, "loaded_at"])
    return positions.where("pos_orderkey is not null").select(
        "flight_date", "flight_status", "departure_iata", "arrival_iata", "departure_scheduled", "airline_iata", "flight_iata", "loaded_at", *SCHEDULE_POSITION)


@register("schedule_load_rejects", with_(sql_schedule()) + f"""
SELECT CASE {KIND} {" ".join(f"WHEN {k} THEN '{r}'" for k, (_, r) in FAULTS.items())} END AS reason,
  CASE {KIND} {" ".join(f"WHEN {k} THEN {t}" for k, (t, _) in FAULTS.items())} END AS text
FROM sched WHERE {KIND} <= 4""")
def schedule_load_rejects(spark, sf_dir):
    """The same files' rejects, one for each planted fault, with its reason and text."""
    _, rejects = load(spark, sf_dir)
    return rejects.select("reason", "text")
