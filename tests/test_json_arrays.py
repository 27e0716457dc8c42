"""Array files: any byte ranges give the elements of a plain byte-by-byte scan."""

import gzip
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelens.sources import json_arrays as J
from pricelens.sources.documents import load_documents, project_text_documents


class Held:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def plain(data):
    """One byte at a time: (position, byte, text, reason)."""
    body = data.lstrip(J._BLANK)
    if body[:1] != b"[":
        return [(0, 0, None, "not_an_array")]
    start = len(data) - len(body) + 1
    depth, string, escaped, nth, closed, out = 1, False, False, 0, None, []
    for k in range(start, len(data)):
        c = data[k:k + 1]
        if c == b"\n":
            string = escaped = False
        elif c == b"\\" and not escaped:
            escaped = True
            continue
        elif c == b'"' and not escaped:
            string = not string
        elif not string and c in b"{[":
            depth += 1
        elif not string and c in b"}]":
            if depth == 1 and c == b"]" and closed is None:
                closed = k
            depth = max(1, depth - 1)
        elif not string and c == b"," and depth == 1:
            out.append((nth, start, *J.judged(data[start:k].strip(J._BLANK))))
            nth, start, closed = nth + 1, k + 1, None
        escaped = False
    if closed is None:
        text, reason = J.judged(data[start:].strip(J._BLANK))
        return out + ([(nth, start, text, "array_not_closed")] if reason else [(nth, start, text, None), (nth + 1, len(data), None, "array_not_closed")])
    last, rest = data[start:closed].strip(J._BLANK), data[closed + 1:].strip(J._BLANK)
    out += [(nth, start, *J.judged(last))] if last or nth else []
    return out + ([(nth + 1, closed + 1, rest.decode(errors="replace"), "text_after_array")] if rest else [])


def in_ranges(data, size, read):
    before, J.READ = J.READ, read
    try:
        head = J.array_start(Held(data), len(data))
        if head < 0:
            return [(0, 0, None, "not_an_array")]
        out, state = [], (False, False, 1, 0)
        for k, a in enumerate(range(head, len(data), size) if head < len(data) else [head]):
            z = min(a + size, len(data))
            out += J.elements(Held(data), len(data), a, z, state, k == 0)
            state = J.follow(state, json.loads(json.dumps(J.summaries(J._pieces(Held(data), a, z))))[2 * state[0] + state[1]])
        return out
    finally:
        J.READ = before


PIECES = [b"{", b"}", b"[", b"]", b",", b'"', b"\\", b"\n", b"a", b" ", b'{"k":1}', b'"x"', b'{"a":"\\\\"}', b'{"a":"\\"]"}', b"\xc3\xa9", b"\xff"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25), st.sampled_from([b"]", b"", b"] x"]), st.sampled_from([(1000, 1000), (3, 3), (7, 2), (1, 1), (5, 1000)]))
def test_any_ranges_are_the_plain_scan(pieces, end, sizes):
    data = b" [" + b"".join(pieces) + end
    assert in_ranges(data, *sizes) == plain(data)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=6), st.one_of(st.text(), st.integers(), st.lists(st.text())), max_size=3), max_size=8), st.integers(1, 40))
def test_well_formed_arrays_come_back(documents, size):
    data = json.dumps(documents, ensure_ascii=False, indent=size % 3 or None).encode("utf-8", "surrogatepass")
    assert [json.loads(t) for _, _, t, reason in in_ranges(data, size, 16) if reason is None] == documents


def stage(tmp, name, data):
    os.makedirs(f"{tmp}/stage", exist_ok=True)
    with open(f"{tmp}/stage/{name}", "wb") as f:
        f.write(data)
    return f"{tmp}/stage"


def test_the_load_goes_on_after_bad_elements(spark, tmp):
    good = b'{"flight": {"iata": "UA%d"}}'
    path = stage(tmp, "a.json", b"[%s,{\"a\":tru},%s,%s]" % (good % 1, good % 2, good % 3))
    stage(tmp, "b.json", b"[%s,\n{\"open\": \"never closed\n}, %s, {\"a\": 1}}}, , \"s\", {\"pad\": \"%s\"}, \xff, %s" % (good % 4, good % 5, b"x" * 50_000, good % 6))
    rows, rejects = load_documents(spark, path, "2024-01-02 00:00:00", range_bytes=64, longest=40_000)
    assert sorted(r["flight_iata"] for r in rows.collect()) == ["UA1", "UA2", "UA3", "UA4", "UA5", "UA6"]
    got = sorted((os.path.basename(r["file_path"]), r["position"], r["reason"], len(r["text"] or "")) for r in rejects.collect())
    assert got == [("a.json", 1, "malformed", 9), ("b.json", 1, "malformed", 24), ("b.json", 3, "malformed", 10), ("b.json", 4, "empty_element", 0),
                   ("b.json", 5, "not_an_object", 3), ("b.json", 6, "element_too_long", J.REJECT_TEXT), ("b.json", 7, "not_utf8", 1), ("b.json", 9, "array_not_closed", 0)]


@pytest.mark.parametrize("data", [b"  \n", b"{}", b"x"])
def test_files_that_are_no_arrays(spark, tmp, data):
    rows, rejects = load_documents(spark, stage(tmp, "a.json", data))
    assert rows.count() == 0 and [r["reason"] for r in rejects.collect()] == ["not_an_array"]


def test_empty_arrays_and_marks(spark, tmp):
    path = stage(tmp, "a.json", b" [ \n ] ")
    stage(tmp, "b.json", b'\xef\xbb\xbf[{"flight": {"iata": "B1"}}]')
    rows, rejects = load_documents(spark, path)
    assert [r["flight_iata"] for r in rows.collect()] == ["B1"] and rejects.count() == 0


def test_one_file_is_read_by_several_tasks(spark, tmp):
    n = 5000
    path = stage(tmp, "a.json", b"[" + b",".join(b'{"flight_date": "%d"}' % i for i in range(n)) + b"]")
    files = spark.createDataFrame([(f"{path}/a.json",)], "path string")
    rows = J.array_rows(files, range_bytes=4096).withColumn("task", F.spark_partition_id())
    got = rows.agg(F.countDistinct("position").alias("d"), F.max("position").alias("last"), F.count(F.lit(1)).alias("n"), F.countDistinct("task").alias("tasks")).first()
    assert (got["d"], got["last"], got["n"]) == (n, n - 1, n) and got["tasks"] > 1


def test_a_range_reads_little_past_its_end():
    data = b"[" + b",".join(b'{"flight_date": "%d"}' % i for i in range(400_000)) + b"]"
    asked = []

    class Counted(Held):
        def read_at(self, n, at):
            asked.append(n)
            return super().read_at(n, at)

    found = list(J.elements(Counted(data), len(data), 1, 100_000, (False, False, 1, 0), True))
    assert found[-1][1] < 100_000 and sum(asked) <= 100_000 + J.PAST


def test_gzip_files_give_what_plain_ones_do(spark, tmp):
    for k in range(3):
        docs = [{"flight": {"iata": f"UA{k}-{i}"}, "pad": "\\\"}{," * (i % 40)} for i in range(300)]
        data = json.dumps(docs).encode() if k else b'[{"a": tru}, ' + json.dumps(docs).encode()[1:-1] + b', 7, {"flight": {"iata": "last"}}]'
        stage(tmp, f"{k}.json", data)
        stage(tmp, f"{k}.json.gz", gzip.compress(data[:1000]) + gzip.compress(data[1000:]))  # two members
    path = f"{tmp}/stage"
    whole = lambda df: sorted(tuple(r) for r in df.selectExpr("replace(file_path, '.gz', '')", *df.columns[1:]).collect())
    for plain, packed in zip(load_documents(spark, path, "2024-01-02 00:00:00", "*.json", range_bytes=500),
                             load_documents(spark, path, "2024-01-02 00:00:00", "*.json.gz", range_bytes=500), strict=True):
        assert whole(plain) == whole(packed) and plain.count() in (901, 2)


def test_an_unpacked_file_is_read_at_any_place(tmp, monkeypatch):
    monkeypatch.setattr(J, "READ", 7)
    monkeypatch.setattr(J, "RANGE", 20)
    data = bytes(range(256)) * 3
    with open(f"{tmp}/a.gz", "wb") as f:
        f.write(gzip.compress(data))
    with J.open_file(f"{tmp}/a.gz") as held:
        assert held.size() == len(data)
        assert all(held.read_at(n, at) == data[at:at + n] for n, at in [(5, 0), (9, 3), (40, 100), (1, 139), (3, 90), (50, 750), (4, 768), (2, 0)])


def test_an_element_is_parsed_once(spark, tmp):
    rows, _ = load_documents(spark, stage(tmp, "a.json", b'[{"position": {"k": 1}}]'), "2024-01-02 00:00:00")
    found = project_text_documents(rows, "raw_json", [("k", "$.position.k", "int")], keep=["flight_date"]).where("k is not null").select("flight_date", "k")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("from_json") == 1 and [r["k"] for r in found.collect()] == [1]


@pytest.mark.parametrize("read", [7, 100, 1000])
def test_the_head_of_a_long_element_is_whole_wherever_pieces_end(read, monkeypatch):
    monkeypatch.setattr(J, "READ", read)
    data = b'[{"a": 1}, {"pad": "' + b"x" * 3000 + b'"}, {"b": 2}]'
    found = list(J.elements(Held(data), len(data), 1, len(data), (False, False, 1, 0), True, longest=50))
    assert found[1][2:] == (data[11:-11].decode(), "element_too_long")
