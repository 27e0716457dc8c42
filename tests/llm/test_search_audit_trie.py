"""op11, op12, op13: against brute force, with nulls, ties, repeats, long inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import bit_sliced, divergence, prefix_trie

from .brute import LOWER


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --------------------------------------------------------------------- op11
def brute_top_k(table, k=5):
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in table
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q is None or q % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in whole if i != q]
        out += [(q, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows,levels", [(64, 3), (32_768, 400)])
def test_top_k_is_brute_force(spark, monkeypatch, block_rows, levels):
    """Few levels of values give many ties; the query itself, odd lengths and unfit vectors are among the rows."""
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(bit_sliced, "QUERY_ROWS", 3)
    rng = random.Random(levels)
    table = [(i, [rng.randrange(-levels, levels) / 256 for _ in range(7)]) for i in range(400)]
    table += [(1000, None), (1050, [0.1, None]), (1100, [0.1, float("nan")]), (1150, [float("inf")]), (1200, []), (1250, [0.5, -0.25]),
              (None, [0.9] * 7), (None, None), (7, [0.3] * 7), (1300, [-1e12, 3e9, 0.001])]
    table += [table[3], table[5]]
    rng.shuffle(table)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in table], "vec_id long, embedding array<double>, key int, g string").repartition(5)
    got = bit_sliced.top_k(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows(got) == brute_top_k(table)


def test_top_k_of_few_and_of_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0])], schema)
    assert rows(bit_sliced.top_k(few, F.col("vec_id") % 50 == 0)) == [(0, 1, 1, 256 * 256 * 5)]
    assert rows(bit_sliced.top_k(few.where("vec_id = 1"), F.col("vec_id") % 50 == 0)) == []
    assert rows(bit_sliced.top_k(few.where("false"), F.col("vec_id") % 50 == 0)) == []


def test_repeated_queries_answer_each(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [-1.0]), (1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert rows(bit_sliced.top_k(df, F.col("vec_id") % 50 == 0, k=1)) == [(0, 1, 1, -65536), (0, 1, 2, 131072)]


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\^60"):
        bit_sliced.top_k(df, F.col("vec_id") % 50 == 0).collect()


def test_signed_digits_give_the_number_back():
    x = np.concatenate([np.arange(2000), [2 ** 59 + 12345, 2 ** 60]]).astype(np.uint64)
    plus, minus = bit_sliced.signed_digits(x)
    assert (plus - minus == x).all() and not (plus & minus).any()
    both = plus | minus
    assert not (both & (both << np.uint64(1))).any()


# --------------------------------------------------------------------- op12
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute_audit(docs, min_docs=30, k=50):
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted((t for t, n in seen[lang].items() if n >= min_docs), key=str.encode)
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: count[lang, s][t] for t in kept})

        def rate(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = rate(whole), {s: rate(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:k])):
                out += [(lang, s, part, i.decode(), -v, n + 1) for n, (v, i) in enumerate(sorted(found))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_audit_is_brute_force(spark, monkeypatch, small):
    if small:  # many partitions, blocks, tiles and flushes
        for name, value in (("HELD_TERMS", 40), ("PART_TERMS", 7), ("MERGED", 2), ("BLOCK_CELLS", 30), ("TILE_SOURCES", 2), ("TEXT_PART", 50)):
            monkeypatch.setattr(divergence, name, value)
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdé" for b in ["", "x", "Ö", "zz", "日"]] + ["rare"]
    docs = []
    for _ in range(300):
        lang, source = rng.choice(["en", "en", "fr", None, "tiny"]), rng.choice(["s1", "s1", "s2", "s3", None])
        text = " ".join(rng.choice(words[:5] if source == "s2" else words) for _ in range(rng.randrange(40)))
        docs.append((rng.choice([text, text.upper(), text.replace(" ", "3\n_"), text, text, None, "", "12 @ {}"]), lang, source))
    docs += [("a x " * 500 + "y" * 400 + " a", "en", "long"), ("y" * 300, "en", "long"), (None, "en", "empty"), ("", "alone", "s1")] + docs[:5]
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "text string, lang string, source string, term string, n long").repartition(4)
    got = divergence.audit(df, min_docs=20, k=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(got) == brute_audit(docs, 20, 7)


def test_audit_without_kept_terms_and_of_nothing(spark):
    docs = [("one two", "en", "a"), ("three", "en", "b"), ("four", "en", "b")]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert rows(divergence.audit(df)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == brute_audit(docs)
    assert rows(divergence.audit(df.where("false"))) == []


def test_skyband_holds_the_best_of_every_monotone_order():
    rng = np.random.default_rng(0)
    for n, k, top in ((400, 5, 12), (900, 1, 1000), (300, 400, 3)):
        up, down, order = rng.integers(0, top, n), rng.integers(0, top, n), rng.permutation(n)
        got = set(divergence.skyband(up, down, order, k).tolist())
        by = [sum(1 for j in range(n) if up[j] >= up[i] and down[j] <= down[i] and order[j] < order[i]) for i in range(n)]
        assert got == {i for i in range(n) if by[i] < k}


def test_rates_are_exact_beyond_what_doubles_hold():
    n, whole = np.array([0, 7, 10 ** 13, 2 * 10 ** 14]), np.array([2 * 10 ** 14 + 1003] * 4)
    assert divergence.rates(n, whole).tolist() == [1 + 10 ** 9 * (int(a) + 5) // int(b) for a, b in zip(n, whole)]


# --------------------------------------------------------------------- op13
def brute_trie(table, family=5, share=9):
    own = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, role.encode(), key, role, text))
    turns = {c: [x[4:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % share
        built[c] = tuple(turns.get(c - math.fmod(c, family), [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        total[node] = (sum(total[x][0] for x in kids[node]) or 1, saved + sum(total[x][1] for x in kids[node]))
    out = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(built[c]) == len(node))
        out.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(kids[node]), *total[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n=60, longest=12):
    rng = random.Random(seed)
    table = []
    for c in range(n):
        c = c if c < n // 2 else c + 3  # a gap: families whose first is absent
        if c in (10, 25):
            continue
        for t in range(rng.randrange(1, longest)):
            table.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(["a", "b", "é", "", None])))
    table += [(-7, 0, "user", "a"), (-7, 0, "user", "b"), (-7, 0, "assistant", "a"), (None, 0, "user", "a"), *table[:9]]
    rng.shuffle(table)
    return table


@pytest.mark.parametrize("bits", [2, 12])
def test_trie_is_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", bits)
    monkeypatch.setattr(prefix_trie, "END_IDS", 2 ** bits)
    table = conversations(bits)
    table += [(100 + i, t, "user", "x" * (t % 3)) for i in (0, 1, 7) for t in range(21 - i)]  # long, shared to depth 14
    df = spark.createDataFrame([(*r, 1, "x") for r in table], "conv_id long, turn long, role string, text string, depth int, name string").repartition(4)
    got = prefix_trie.trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows(got) == brute_trie(table)


def test_one_conversation_longer_than_chunks_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 2)
    table = [(0, t, "user", str(t % 5)) for t in range(70)] + [(5, t, "user", str(t % 5) if t < 64 else "end") for t in range(66)] + [(1, 0, None, "é" * 100_000)]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    assert rows(prefix_trie.trie(df)) == brute_trie(table)


def test_turnless_and_no_conversations(spark):
    table = [(c, 0, "user", "a") for c in (11, 12, 13, 14, 16)]  # no family heads: the first h turns are gone
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    assert rows(prefix_trie.trie(df)) == brute_trie(table)
    assert rows(prefix_trie.trie(df.where("false"))) == []
