"""Nested schedule documents.

Each file holds one JSON array of flight documents.  Its elements become rows
(``json_arrays``), one VARIANT each, and typed columns are projected by path
with ``try_variant_get`` -- unknown keys survive in ``raw_json``.  What does
not parse lands in the reject frame instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.sources.json_arrays import LONGEST, RANGE, REJECT_TEXT, array_rows
from pricelens.sources.tables import list_files

# (output column, JSON path, type)
SCHEDULE_PATHS = [
    ("flight_date", "$.flight_date", "string"),
    ("flight_status", "$.flight_status", "string"),
    ("departure_airport", "$.departure.airport", "string"),
    ("departure_iata", "$.departure.iata", "string"),
    ("departure_scheduled", "$.departure.scheduled", "timestamp"),
    ("arrival_airport", "$.arrival.airport", "string"),
    ("arrival_iata", "$.arrival.iata", "string"),
    ("arrival_scheduled", "$.arrival.scheduled", "timestamp"),
    ("airline_name", "$.airline.name", "string"),
    ("airline_iata", "$.airline.iata", "string"),
    ("flight_number", "$.flight.number", "string"),
    ("flight_iata", "$.flight.iata", "string"),
    ("codeshared_airline", "$.flight.codeshared.airline_name", "string"),
    ("codeshared_flight", "$.flight.codeshared.flight_iata", "string"),
]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly column that is computed once a row: the planner
    copies a column's expression into the filters on it, but not through a
    generator."""
    return df.select(*[F.col(c) for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def project_documents(docs: DataFrame, doc_col: str = "doc",
                      paths=SCHEDULE_PATHS, keep: list[str] | None = None) -> DataFrame:
    """Typed path projection of a VARIANT column."""
    d = F.col(doc_col)
    cols = [F.col(k) for k in (keep or [])]
    cols += [F.try_variant_get(d, p, t).alias(n) for n, p, t in paths]
    cols.append(F.to_json(d).alias("raw_json"))
    return docs.select(*cols)


def operating_airline(codeshared: Column, marketed: Column) -> Column:
    """The carrier that flies: the codeshare's, or the marketed one."""
    return F.coalesce(F.nullif(codeshared, F.lit("")), marketed)


def parse_documents(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """JSON text (one document per row) -> VARIANT column ``doc``; unparsable
    text gives a NULL ``doc``."""
    return once(texts, "doc", F.try_parse_json(F.col(text_col)))


def _paths_ddl(paths) -> str:
    """Nested struct DDL holding exactly the leaves named by ``paths``
    (timestamps are read as text and cast, which accepts any ISO offset)."""
    tree: dict = {}
    for _, p, t in paths:
        parts = p[2:].split(".")
        node = tree
        for part in parts[:-1]:
            node = node.setdefault(part, {})
        node[parts[-1]] = "string" if t == "timestamp" else t

    def ddl(node, top):
        items = [f"`{k}` {'STRUCT<' + ddl(v, False) + '>' if isinstance(v, dict) else v}"
                 if top else
                 f"`{k}`: {'STRUCT<' + ddl(v, False) + '>' if isinstance(v, dict) else v}"
                 for k, v in node.items()]
        return ", ".join(items)
    return ddl(tree, True)


def project_text_documents(texts: DataFrame, text_col: str = "text", paths=SCHEDULE_PATHS,
                           keep: list[str] | None = None) -> DataFrame:
    """Typed path projection straight from JSON text: one ``from_json`` into
    a struct holding only the requested paths (a single streaming parse, no
    per-path re-walk).  ``raw_json`` is the VARIANT of the whole document,
    unknown keys included; it is pruned away when not selected."""
    parsed = F.from_json(F.col(text_col), _paths_ddl(paths))
    base = once(texts, "_p", parsed)
    cols = [F.col(k) for k in (keep or [])]
    cols += [F.col("_p." + ".".join(f"`{x}`" for x in p[2:].split("."))).cast(t).alias(n)
             for n, p, t in paths]
    cols.append(F.try_parse_json(F.col(text_col)).alias("raw_json"))
    return base.select(*cols)


def load_documents(spark: SparkSession, path: str, run_ts: str | None = None, glob: str = "*.json",
                   range_bytes: int = RANGE, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) from a folder of JSON-array files.

    Files are cut into ranges of ``range_bytes``, so one file of any size is
    read by many tasks; a gzip file (.gz) by one (see ``json_arrays``).  An element that is no object, no
    JSON, no UTF-8 or longer than ``longest`` bytes costs one reject
    (file_path, position, reason, text: at most REJECT_TEXT characters) and
    the load goes on with the next one.  A file of no bytes is not listed and
    gives neither."""
    elements = array_rows(list_files(spark, path, glob).select("path"), range_bytes, longest=longest)
    parsed = parse_documents(elements).withColumn("reason", F.coalesce(
        "reason", F.when(F.col("doc").isNull(), F.lit("not_a_variant"))))
    bad = parsed.filter(F.col("reason").isNotNull()).select("file_path", "position", "reason", F.left("text", F.lit(REJECT_TEXT)).alias("text"))
    good = parse_documents(elements.filter(F.col("reason").isNull())).filter(F.col("doc").isNotNull())
    out = project_documents(good, keep=["file_path"])
    loaded: Column = F.to_timestamp(F.lit(run_ts)) if run_ts else F.current_timestamp()
    return out.withColumn("loaded_at", loaded), bad


def schedule_document(df: DataFrame, extra: dict[str, Column] | None = None) -> Column:
    """Nested document of a schedule-view row (S21 JSON encode); ``extra``
    adds further top-level keys."""
    more = [c.alias(n) for n, c in (extra or {}).items()]
    return F.to_json(F.struct(
        F.col("flight_date"),
        F.col("flight_status"),
        F.struct(F.col("departure_iata").alias("airport"), F.col("departure_iata").alias("iata"),
                 F.date_format("departure_scheduled", "yyyy-MM-dd'T'HH:mm:ssXXX")
                 .alias("scheduled")).alias("departure"),
        F.struct(F.col("arrival_iata").alias("airport"), F.col("arrival_iata").alias("iata"),
                 F.lit(None).cast("string").alias("scheduled")).alias("arrival"),
        F.struct(F.col("airline_name").alias("name"), F.col("airline_iata").alias("iata")).alias("airline"),
        F.struct(F.col("flight_iata").alias("number"), F.col("flight_iata").alias("iata"),
                 F.lit(None).cast("struct<airline_name:string,flight_iata:string>")
                 .alias("codeshared")).alias("flight"),
        F.col("price_usd"),
        *more,
    ))
