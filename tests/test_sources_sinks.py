"""Ingress validation, document loading, sinks, DQ and semantic layer."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pricelens.operators.dq import silver_checks
from pricelens.operators.semantic import MODEL, semantic_query
from pricelens.sinks.versions import read_live
from pricelens.sinks.writers import read_mark, upsert_best, write_mark
from pricelens.sources.documents import load_documents
from pricelens.sources.events import parse_events
from pricelens.sources.tables import read_increment


def _tick(**kw):
    base = {"route_id": "ORD-LAX", "origin": "ORD", "destination": "LAX", "airline_code": "UA",
            "airline_name": "United", "price_usd": 199.5, "event_timestamp": 100,
            "ingestion_timestamp": 110}
    base.update(kw)
    return json.dumps(base)


def test_parse_events_reasons(spark):
    missing = json.loads(_tick())
    del missing["origin"]
    msgs = [_tick(), "{not json", "[1, 2]", json.dumps(missing), _tick(airline_name=None),
            _tick(price_usd="abc"), _tick(flight_number="UA1")]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    good, bad = parse_events(df)
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad_type", "malformed", "missing_key", "not_object"]
    assert good.count() == 3 and good.count() + bad.count() == len(msgs)
    good2, bad2 = parse_events(df, mode="non_null")
    assert "null_value" in {r.reason for r in bad2.collect()}
    row = good.filter(F.col("flight_number") == "UA1").first()
    assert row.price_usd == 199.5 and row.event_timestamp == 100


def test_load_documents_broken_file_and_extra_keys(spark, tmp):
    docs = [{"flight_date": "2026-07-22", "departure": {"iata": "ORD", "scheduled": "2026-07-22T10:00:00+00:00"},
             "arrival": {"iata": "LAX"}, "airline": {"name": "United", "iata": "UA"},
             "flight": {"number": "500", "iata": "UA500", "codeshared": None}, "extra_key": 1},
            {"departure": {"iata": "ORD"}, "arrival": {"iata": ""}, "airline": {"iata": "AA"},
             "flight": {"iata": "AA1", "codeshared": {"airline_name": "BA", "flight_iata": "BA9"}}}]
    os.makedirs(os.path.join(tmp, "stage"))
    with open(os.path.join(tmp, "stage", "good.json"), "w") as fh:
        json.dump(docs, fh)
    with open(os.path.join(tmp, "stage", "broken.json"), "w") as fh:
        fh.write('[{"flight_date": ')
    rows, bad = load_documents(spark, os.path.join(tmp, "stage"), run_ts="2026-07-22 12:00:00")
    got = rows.orderBy("flight_iata").collect()
    assert [r.flight_iata for r in got] == ["AA1", "UA500"]
    assert got[0].codeshared_airline == "BA" and got[0].arrival_iata == ""
    assert got[1].departure_scheduled is not None and "extra_key" in got[1].raw_json
    assert [os.path.basename(r.file_path) for r in bad.collect()] == ["broken.json"]


def test_upsert_best_is_idempotent(spark, tmp):
    path = os.path.join(tmp, "fact")
    b1 = spark.createDataFrame([("F1", 0, 3, 1, "d1"), ("F2", 0, 1, 1, "d1")],
                               "k string, w int, message_count int, processing_timestamp int, day string")
    upsert_best(spark, b1, path, ["k", "w"], [("message_count", True), ("processing_timestamp", True)], "day")
    b2 = spark.createDataFrame([("F1", 0, 5, 2, "d1"), ("F3", 0, 1, 2, "d2")],
                               "k string, w int, message_count int, processing_timestamp int, day string")
    for _ in range(2):
        upsert_best(spark, b2, path, ["k", "w"], [("message_count", True), ("processing_timestamp", True)], "day")
    got = sorted((r.k, r.message_count) for r in read_live(spark, path, b1.schema, "day").collect())
    assert got == [("F1", 5), ("F2", 1), ("F3", 1)]


def test_marks_and_increment_bounds(spark, tmp):
    p = os.path.join(tmp, "marks")
    assert read_mark(spark, p, "daily", "default") == "default"
    write_mark(spark, p, "daily", "2026-01-01 00:00:10", "run1")
    assert read_mark(spark, p, "daily", None) == "2026-01-01 00:00:10"
    df = spark.createDataFrame([(10,), (11,), (20,), (21,)], "t int")
    assert [r.t for r in read_increment(df, "t", 10, 20).orderBy("t").collect()] == [11, 20]


def test_dq_edges(spark):
    schema = ("processing_timestamp timestamp, flight_number string, avg_price_usd double, "
              "window_start timestamp, airline_code string")
    empty = spark.createDataFrame([], schema)
    rows = {r.check: r for r in silver_checks(empty, "2026-01-02 00:00:00").collect()}
    assert rows["silver_freshness_hours"].value == 999 and not rows["silver_freshness_hours"].passed
    assert rows["null_rate_flight_number"].value is None and rows["null_rate_flight_number"].passed
    df = spark.createDataFrame(
        [("2026-01-01 21:01:00", None if i == 0 else "F", 1.0, "2026-01-01 21:00:00", "UA")
         for i in range(99)], "p string, flight_number string, avg_price_usd double, w string, airline_code string") \
        .select(F.to_timestamp("p").alias("processing_timestamp"), "flight_number", "avg_price_usd",
                F.to_timestamp("w").alias("window_start"), "airline_code")
    rows = {r.check: r for r in silver_checks(df, "2026-01-01 23:59:59").collect()}
    assert rows["silver_freshness_hours"].value == 2 and rows["silver_freshness_hours"].passed
    assert rows["silver_rows_today"].value == 99 and not rows["silver_rows_today"].passed
    assert not rows["null_rate_flight_number"].passed  # 1/99 > 1 %


def test_semantic_rejects_unknown_and_global(spark):
    df = spark.createDataFrame([("R1", "Summer", 10.0, 5.0, 20.0, 2, 1),
                                ("R1", "Winter", 20.01, 6.0, 30.0, 3, 0)],
                               "route_id string, season string, avg_price double, min_price double, "
                               "max_price double, airline_count long, total_anomalies long")
    t = MODEL["hourly_route_summary"]
    with pytest.raises(KeyError):
        semantic_query(df, t, ["revenue"], ["route_id"])
    one = semantic_query(df, t, ["avg_price", "total_anomalies", "airline_count"]).collect()
    assert len(one) == 1 and one[0].avg_price == 15.01 and one[0].airline_count == 3


def test_stage_listing_misses_no_file(spark, tmp, monkeypatch):
    from pricelens.plans import q_tables
    spark.range(100).withColumnRenamed("id", "o_orderkey").repartition(3).write.parquet(f"{tmp}/orders.parquet")
    got = lambda: [tuple(r) for r in q_tables.stage_listing(spark, tmp).collect()]
    assert got() == [(True, True)]
    listed = q_tables.list_files
    monkeypatch.setattr(q_tables, "list_files", lambda *a: listed(*a).orderBy("path").limit(1))
    assert got() == [(False, True)]


def test_a_record_schema_names_keys_defaults_and_nulls(spark):
    from pricelens.sources.events import tag_events
    from pricelens.sources.message_schema import message_schema
    record = {"type": "record", "name": "T", "fields": [
        {"name": "a", "type": "string"}, {"name": "b", "type": ["null", "long"]}, {"name": "c", "type": "double", "default": 1.5},
        {"name": "d", "type": ["null", "string"], "default": None}]}
    s = message_schema(json.dumps(record))
    assert (s.required, s.not_null, s.defaults) == (["a", "b"], ["a", "c"], {"c": 1.5})
    assert s.columns.simpleString() == "struct<a:string,b:bigint,c:double,d:string>"
    texts = ['{"a":"x","b":1}', '{"a":"x","b":null,"c":2,"d":null}', '{"a":"x"}', '{"a":null,"b":1}', '{"a":"x","b":"z"}', '{"a":"x","b":1,"c":null}', "[1]", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = tag_events(df, schema=s.columns, required=s.required, not_null=s.not_null, defaults=s.defaults).orderBy("i").collect()
    assert [r["reason"] for r in got] == [None, None, "missing_key", "null_value", "bad_type", "null_value", "not_object", "malformed"]
    assert [(r["b"], r["c"], r["d"]) for r in got[:2]] == [(1, 1.5, None), (None, 2.0, None)]
    for bad in ({"type": "enum"}, {"type": "record", "fields": [{"name": "x", "type": {"type": "array", "items": "long"}}]},
                {"type": "record", "fields": [{"name": "x", "type": "long", "default": None}]}):
        with pytest.raises(ValueError):
            message_schema(json.dumps(bad))
