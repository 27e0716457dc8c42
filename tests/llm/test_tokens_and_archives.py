"""op2, op4, op10: against the library, exact round trips, odd rows."""

import base64
import gzip
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from pricelens.llm import packing, token_counts, warc

from . import brute as B

PATH = public_tokenizers.path("word_bpe_49k.json")


def odd_texts():
    rng = random.Random(4)
    char = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0, 0x500), rng.randrange(0x500, 0xD7FF), 39, 32, 115, 0xDF, 0x130]))
    made = ["".join(char() for _ in range(rng.randrange(40))) for _ in range(300)]
    return ["", " \n", "<|endoftext|>a<|startoftext|> <|x|>", "don't WE'LL 12½ aaaaaaaaaaaa", "\x1c\x85\xa0 a　b", "x" * 30_000, "na " * 9_000, *made]


def docs():
    return [(i, t) for i, t in enumerate(odd_texts())] + [(5, None), (None, "null id"), (1, "twice"), (1, "twice")]


def frame(spark, values):
    return spark.createDataFrame([(d, t, 1) for d, t in values], "doc_id long, text string, n_tokens int")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_counts_are_the_librarys(spark):
    got = token_counts.count_tokens(frame(spark, docs()).repartition(3), PATH)
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(B.token_counts(docs(), PATH), key=repr)


def test_merging_in_rounds_with_a_small_cache(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    monkeypatch.setattr(token_counts, "MERGE_WORDS", 2)
    texts = [t.encode() for t in odd_texts()]
    assert token_counts.Counter(PATH).count(texts) == [n for _, _, n, _ in B.token_counts(list(enumerate(odd_texts())), PATH)]


def test_a_result_of_lower_rank_goes_one_by_one():
    """'ab' made by the later merge takes part in an earlier one: the leftmost place first."""
    model = {"vocab": {c: i for i, c in enumerate("abc")}, "merges": [["ab", "c"], ["a", "b"]], "end_of_word_suffix": ""}
    table = token_counts.MergeTable.of(model)
    assert table.lone.tolist() == [False, True]
    assert token_counts.merge_counts([b"ababc", b"", b"ccc"], table).tolist() == [2, 0, 3]


def test_pieces_and_sequences(spark):
    got = packing.pack(frame(spark, docs()).repartition(3), PATH)
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(B.pieces(docs(), PATH), key=repr)
    placed = [tuple(r) for r in got.select("sequence_id", "offset", "length").collect()]
    assert B.packing_faults(placed) == []
    total = sum(n for _, _, n in placed)
    assert len({s for s, _, _ in placed}) <= -(-total // 4096) + 1


@pytest.mark.parametrize("tasks", [2, 20_000])
def test_many_groups_stay_whole(spark, monkeypatch, tasks):
    monkeypatch.setattr(packing, "GROUP_PIECES", 20)
    monkeypatch.setattr(packing, "MOST_TASKS", tasks)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = packing.pack(frame(spark, docs()), PATH)
    assert B.packing_faults([tuple(r) for r in got.select("sequence_id", "offset", "length").collect()]) == []
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(B.pieces(docs(), PATH), key=repr)
    assert got.select((got["sequence_id"] / 2**32).cast("int").alias("g")).distinct().count() > 10
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    lengths = np.array([random.Random(i).randrange(1, 100) for i in range(400)])
    bins, offsets = packing.best_fit(lengths, 100, 3, 4_000, weights=(1, 1, 1), rule=rule)
    for b in set(bins.tolist()):
        inside = lengths[bins == b]
        assert inside.sum() <= 100 and len(inside) <= 3 and (len(inside) == 1 or (inside ** 2).sum() <= 4_000)
        assert sorted(offsets[bins == b].tolist()) == np.r_[0, np.cumsum(inside[np.argsort(offsets[bins == b])])[:-1]].tolist()


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert token_counts.count_tokens(none, PATH).count() == 0
    assert packing.pack(none, PATH).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0


PAGES = [(3, "http://a/\r\nWARC-Type: x", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (1, None, "same"), (2, "u", "same"), (2, "u", "same"), (7, "u", None), (8, "u", ""), (None, "u", "same"),
         (None, "v", "only null"), (9, "u", "x" * 300_000), (1, "w", "same")]


def expected(pages, least_size=0):
    body = lambda h: (h or "").encode()
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[body(h)] = min(first.get(body(h), p), p)
    out = []
    for p, _, h in pages:
        b, f = body(h), first.get(body(h))
        revisit = len(b) >= least_size and p != f
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_size", [0, 100])
def test_warc_round_trip(spark, least_size):
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int").repartition(3)
    got = warc.round_trip(df, least_size)
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected(PAGES, least_size)


def test_warc_predicates_reach_the_headers(spark, tmp):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write(df, f"{tmp}/w")
    got = warc.read(spark, f"{tmp}/w")
    some = got.where("record_type = 'response' and target_uri like 'http://a%'")
    assert "Filter (" not in some._jdf.queryExecution().executedPlan().toString()  # none is left to Spark
    assert [bytes(r["payload"]).decode() for r in some.collect()] == ["<p>é\r\n\r\nWARC/1.1\r\n</p>"]
    assert got.where("record_type in ('revisit')").count() == 4
    assert got.where("block_bytes > 1000").count() == 1  # not a header: stays with Spark
    assert warc.read(spark, f"{tmp}/w", payload=False).where("payload is not null").count() == 0


def test_warc_reads_plain_and_many_member_archives_and_refuses_broken_ones(spark, tmp):
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    for name, data in (("plain.warc", one + two), ("members.warc.gz", gzip.compress(one) + gzip.compress(two))):
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(data)
    got = warc.read(spark, tmp).where("target_uri is not null")
    assert [bytes(r["payload"]) for r in got.collect()] == [b"hi", b"hi"]
    with open(f"{tmp}/broken.warc", "wb") as f:
        f.write(two[:-5])
    with pytest.raises(Exception, match="cut short"):
        warc.read(spark, tmp).collect()
