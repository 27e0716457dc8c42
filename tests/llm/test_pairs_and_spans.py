"""op3, op5, op8: against brute force, with nulls, empty texts, ties, repeats."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm import decontaminate, graph, simhash, substring_dedup

from . import brute as B


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def corpus(seed, n=120, vocabulary=60):
    """Documents with copies, near copies, shared passages, repeats, nulls and odd white space."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = " ".join(word() for _ in range(45))
    docs = []
    for i in range(n):
        kind = rng.randrange(10)
        text = " ".join(word() for _ in range(rng.randrange(1, 90)))
        if kind == 0 and docs:
            text = rng.choice(docs)[1]
        elif kind == 1 and docs and docs[-1][1]:
            words = docs[-1][1].split(" ")
            words[rng.randrange(len(words))] = word()
            text = " ".join(words)
        elif kind == 2:
            text = f"{text} {passage}\n{word()}"
        elif kind == 3:
            text = " ".join([word()] * rng.randrange(20, 60))
        elif kind == 4:
            text = rng.choice([None, "", " \t\n", "É\x1f x\x0bÀ " * 15])
        docs.append((i, text))
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    """With a further column whose name an operator uses itself."""
    return spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, version string")


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_is_brute_force(spark, seed):
    docs = corpus(seed)
    docs += [docs[0], docs[3]] + [(None, docs[5][1]), (None, docs[7][1])]  # repeated rows, null ids
    got = substring_dedup.digest(substring_dedup.parse(frame(spark, docs).repartition(5)))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(B.substring_dedup(docs), key=repr)


def test_factors_point_to_their_source(spark):
    a = " ".join(f"a{i}" for i in range(50))
    b = " ".join(f"b{i}" for i in range(30))
    docs = [(1, a), (2, b), (3, f"x y {a} {b} z"), (4, a)]
    found = {r["doc_id"]: r for r in substring_dedup.parse(frame(spark, docs)).collect()}
    # two factors side by side; the windows across their boundary stand nowhere before
    assert [tuple(f) for f in found[3]["factors"]] == [(2, 50, 1, 0), (52, 30, 2, 0)]
    assert found[3]["kept"] == "x y z"
    assert found[4]["n_removed"] == 50 and found[1]["n_removed"] == 0


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART", 7)
    rng = random.Random(3)
    text = [f"w{rng.randrange(4)}" for _ in range(300)]
    x = substring_dedup.word_hashes([w.encode() for w in text])
    whole = set(substring_dedup.seeds(x, 20, 5).tolist())
    in_parts = {s for _, p in substring_dedup.parts([w.encode() for w in text], 20) for s in substring_dedup.seeds(p, 20, 5).tolist()}
    assert whole == in_parts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=80))
def test_equal_windows_have_seeds_among_the_places(values):
    x = np.array(values, np.uint64)
    assert set(substring_dedup.seeds(x, 20, 5).tolist()) <= set(substring_dedup.seed_places(x, 20, 5).tolist())


@pytest.mark.parametrize("block", [4_096, 2])
def test_simhash_is_brute_force(spark, monkeypatch, block):
    """Also with buckets dealt in block pairs."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    docs = corpus(5, n=80, vocabulary=6) + [(None, "w1 w2"), (3, "other text for id three")]
    got = simhash.digest(simhash.components(frame(spark, docs)))
    assert rows(got, "doc_id", "fingerprint", "component_id") == sorted(B.simhash(docs), key=repr)


@pytest.mark.parametrize(("distance", "block"), [(1, 3), (2, 4_096), (3, 3), (4, 3), (4, 4_096)])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, distance, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (2**64 - 1) for b in base for _ in range(40)}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    found = {r["node"]: r["component"] for r in graph.connected_components(simhash.links(df, distance)).collect()}
    parent = {p: p for p in signed}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {p: root(p) for p in signed}
    assert {p: found.get(p, p) for p in signed} == least


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (201, 200)], "u long, v long")
    got = {r["node"]: r["component"] for r in graph.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 200: 200, 201: 200}


def test_representatives_keep_one_row_and_all_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(5, text, "a"), (2, text, "b"), (2, text, "b"), (9, "something else here now", "c"), (None, None, "d"), (7, "", "e")], "doc_id long, text string, k1 string")
    assert rows(simhash.representatives(df), "doc_id", "k1") == sorted([(2, "b"), (9, "c"), (7, "e")], key=repr)


def items(spark, values):
    return spark.createDataFrame(values, "item_id long, text string")


BENCH = [(1, "The quick brown fox jumps over the lazy dog again and again today"), (2, "short item"), (10, "Short, ITEM!"), (3, None), (4, "..."), (None, "null id words"), (2, "second text of two")]


def bench_docs():
    rng = random.Random(8)
    filler = lambda n: " ".join(f"f{rng.randrange(99)}" for _ in range(n))
    return [(0, filler(30)), (1, f"{filler(5)} QUICK brown-fox jumps over the lazy dog again and, again {filler(5)}"), (2, "é short\titem é short item x"),
            (3, None), (4, ""), (5, "quick brown fox jumps over the lazy dog again"), (6, "null id words second text of two"), (6, "null id words second text of two"), (None, "short item")]


@pytest.mark.parametrize("shard", [8_000_000, 40])
def test_decontamination_is_brute_force(spark, monkeypatch, shard):
    """Also with the benchmark in several shards."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    got = decontaminate.digest(decontaminate.find(frame(spark, bench_docs()), items(spark, BENCH)))
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(B.decontaminate(bench_docs(), BENCH), key=repr)
    kept = decontaminate.clean(frame(spark, bench_docs()), items(spark, BENCH))
    assert rows(kept, "doc_id") == rows(got.where("not contaminated"), "doc_id") and kept.columns == ["doc_id", "text", "version"]


@pytest.mark.parametrize(("words", "block"), [(3, 1), (7, 400), (2_000, 64_000_000)])
def test_long_items_and_texts_are_scanned_in_pieces(spark, monkeypatch, words, block):
    """One item of 300 words in several pieces and shards, one document of 40,000 words, clashing column names."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 600)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", words)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(words)
    item = [f"q{rng.randrange(50)}" for _ in range(300)]
    far = [f"z{k}" for k in range(40_000)]
    docs = [(1, " ".join(far[:20_000] + item[4:50] + far[20_000:] + item[290:])), (2, " ".join(item)), (2, " ".join(item)), (3, " ".join(item[-9:])), (4, " ".join(item[-10:])), (5, "")]
    bench = [(11, " ".join(item)), (11, " ".join(item)), (None, " ".join(item[100:112])), (12, "..."), (13, None)]
    df = spark.createDataFrame([(i, t, 7, "s") for i, t in docs], "doc_id long, text string, item bigint, shard string")
    got = decontaminate.digest(decontaminate.find(df, items(spark, bench)))
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(
        B.decontaminate(docs, bench), key=repr)
    kept = decontaminate.clean(df, items(spark, bench))
    assert rows(kept, "doc_id", "item", "shard") == [(3, 7, "s"), (5, 7, "s")]


def test_spans_are_offsets_of_the_original(spark):
    text = "Ünïcode: a – SHORT... item; z"
    got = decontaminate.find(frame(spark, [(1, text)]), items(spark, [(1, "short item")])).first()
    assert [text[s["start"]:s["end"]] for s in got["spans"]] == ["SHORT... item"]


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert substring_dedup.parse(none).count() == 0
    assert simhash.components(none).count() == 0
    assert simhash.representatives(none).count() == 0
    assert decontaminate.find(none, items(spark, BENCH)).count() == 0
    one = decontaminate.digest(decontaminate.find(frame(spark, [(1, "a b")]), items(spark, []).limit(0))).first()
    assert one["n_words"] == 2 and not one["contaminated"]
