"""op1, op6, op7, op9 and the pipeline: exact parts against brute force,
fitted parts on held-out rows and built cases."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pricelens.llm import quality_ordinal, quality_rules, secrets, toxicity
from pricelens.llm.labelled import Sparse

from . import brute as B

SF = "/root/testdata/sf0.01"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


ODD = ["", None, " \n\t", "one two", "a b c d e " * 9, "x\nx\n\nx \n y", "ÉÀ #* 漢字 <|>\x1f\x85 " * 4, "word " * 40_000, "A!! B!! " * 12]


def frame(spark, texts):
    """Rows twice, a null id, and a column whose name the operators use."""
    return spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(0, texts[0], 0.5), (None, texts[-1], 0.5)], "doc_id long, text string, score double")


def ids_and_texts(texts):
    return [*enumerate(texts), (0, texts[0]), (None, texts[-1])]


# ---------------------------------------------------------------- op6
def test_base_rules_are_brute_force(spark):
    got = quality_rules.judge(frame(spark, ODD).repartition(2), quality_rules.Trees())
    want = sorted(((d, *B.quality_base(t)) for d, t in ids_and_texts(ODD)), key=repr)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(got, *columns) == want
    assert rows(got.where("kept and base_failed"), "doc_id") == []


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((2_000, 3))
    y = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 1]) + 0.2 * rng.normal(size=2_000)) < 0.7).astype(float)
    model = quality_rules.fit(x, y, [-1, 0, 0], trees=30)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.85
    line = np.repeat(rng.random((50, 1, 3)), 40, axis=1)
    line[:, :, 0] = np.linspace(0, 1, 40)
    assert (np.diff(model.score(line.reshape(-1, 3)).reshape(50, 40), axis=1) <= 1e-12).all()


def test_flattened_trees_are_the_walked_ones():
    rng = np.random.default_rng(2)
    x, y = rng.random((500, 2)), rng.integers(0, 2, 500).astype(float)
    m = quality_rules.fit(x, y, [0, 1], trees=7, depth=3)

    def walk(row):
        total = m.start
        for t in range(len(m.feature)):
            at = 0
            while m.left[t, at] != at:
                at = m.left[t, at] if row[m.feature[t, at]] <= m.cut[t, at] else m.right[t, at]
            total += m.value[t, at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(m.score(x[:60]), [walk(r) for r in x[:60]])


def test_trees_keep_good_documents_and_refuse_poor_ones(spark):
    documents, labels = read(spark, "documents"), read(spark, "labels")
    model = quality_rules.train(documents, labels.where("doc_id % 3 <> 0"))
    got = quality_rules.judge(documents, model).join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").select("kept", "quality").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in got]) > 0.95


def test_without_labels_all_are_kept(spark):
    labels = read(spark, "labels").limit(0)
    assert quality_rules.train(read(spark, "documents"), labels).score(np.zeros((2, 11))).min() >= 0.5
    ordinal = quality_ordinal.train(read(spark, "documents"), labels, quality_ordinal.grade_of(), 3)
    assert (ordinal.tails(np.array([0.0]))[0] > 0.99).all()
    assert toxicity.score(frame(spark, ODD), toxicity.train(read(spark, "documents"), labels)).where("predicted = 1").count() == 0


# ---------------------------------------------------------------- op9
def test_ordinal_fit_orders_thresholds_and_grades():
    rng = np.random.default_rng(3)
    z = rng.random(900)
    y = np.digitize(z + 0.05 * rng.normal(size=900), [0.3, 0.6])
    x = Sparse(pa.chunked_array([pa.array([[5, 9]] * 900, pa.list_(pa.int32()))]), pa.chunked_array([pa.array([[float(v), 1.0] for v in z], pa.list_(pa.float32()))]), quality_ordinal.WIDTH)
    m = quality_ordinal.fit(x, y, 3, steps=600)
    assert m.thresholds[0] < m.thresholds[1]
    tails = m.tails(x.dot(m.weights))
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert np.corrcoef(tails.sum(axis=1), y)[0, 1] > 0.85


def test_grades_hold_on_other_rows(spark):
    documents, labels = read(spark, "documents"), read(spark, "labels")
    model = quality_ordinal.train(documents, labels.where("doc_id % 3 <> 0"), quality_ordinal.grade_of(), 3)
    got = quality_ordinal.score(documents, model).join(labels.where("doc_id % 3 = 0"), "doc_id").select("kept", "quality").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in got]) > 0.97
    odd = quality_ordinal.score(frame(spark, ODD), model)
    assert odd.count() == len(ODD) + 2 and odd.where("tail is null or isnan(tail)").count() == 0


# ---------------------------------------------------------------- op1
def test_toxicity_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    labels = read(spark, "labels", sf)
    got = toxicity.score(read(spark, "documents", sf), toxicity.train(read(spark, "documents", sf), labels)).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["toxic"]]
    clean = [r["predicted"] for r in got if not r["toxic"]]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) < 0.02  # README has the figures by language


def test_held_out_rows_teach_nothing(spark):
    import zlib
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    documents = spark.createDataFrame([(i, f"plain words {'insultword' if i in held else ''}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in held)) for i in range(400)], "doc_id long, toxic int")
    scores = toxicity.score(documents, toxicity.train(documents, labels))
    assert scores.where("predicted = 1").count() == 0 and scores.where("held_out").count() == len(held)


def test_counterfactuals_clear_neutral_mentions(spark):
    """Mentions of one group come with insults in the labelled rows; the penalty takes the blame off the group."""
    rng = random.Random(6)
    word = lambda: f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}"
    docs = []
    for i in range(700):
        toxic = i % 2
        group = rng.choice(["muslims"] * 9 + ["hindus"]) if toxic else rng.choice(["hindus"] * 9 + ["muslims"])
        docs.append((i, " ".join([word() for _ in range(8)] + [group] + (["horridfool"] if toxic and rng.random() < 0.8 else [])), toxic))
    documents = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(d[0], d[2]) for d in docs], "doc_id long, toxic int")
    gap = {}
    for penalty in (0.0, 5.0):
        m = toxicity.train(documents, labels, penalty=penalty)
        gap[penalty] = m.raw("neutral talk about muslims") - m.raw("neutral talk about christians")
        assert m.raw("you horridfool") > m.raw("you there")
    assert gap[0.0] > 0.5 and abs(gap[5.0]) < 0.3 * gap[0.0]


def test_odd_texts_get_scores(spark):
    got = toxicity.score(frame(spark, ODD), toxicity.Linear(-3.0, {toxicity.runs_of("word")[0]: 9.0}))
    assert got.count() == len(ODD) + 2
    assert rows(got.where("predicted = 1"), "doc_id") == [(7,)]
    assert got.where("doc_id is null and held_out").count() == 1


# ---------------------------------------------------------------- op7
SECRETS = ["password=abc12 secret:token : abcdefgh TOKEN = \"0123456789abcdef0123456789\"", "AKIA" + "A1" * 8 + " AKIAAKIA AKIA" + "B" * 15, "é password : 'x/y+z=._-9'é deadbeef" * 3 + "0123456789abcdef01234567",
           "api_key=abcdef Apikey:abcdef passwd  =  =abcdef", "hex " + "ab" * 5_000, "token=abcdef " * 3_000, "", None, "x token", "secret==abcdef\nsecret\t=abcdef"]


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.train(secrets.samples(read(spark, "documents"), read(spark, "labels")))


def test_base_kinds_are_brute_force(spark, ratios):
    texts = [*SECRETS, *ODD]
    got = secrets.digest(secrets.scan(frame(spark, texts).withColumnRenamed("score", "base"), ratios))
    want = sorted(((d, a, b, c, B.sha(listed)) for d, (a, b, c, listed) in ((d, B.secret_base(t)) for d, t in ids_and_texts(texts))), key=repr)
    assert rows(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_markov_tells_random_strings_from_names(spark, ratios):
    rng = random.Random(9)
    letters = secrets.ALPHABET[:62]
    made = ["".join(rng.choice(letters) for _ in range(32)) for _ in range(40)]
    names = ["get_user_account_by_identifier", "donaudampfschifffahrtsgesellschaft", "internationalization-of-things", "the_whole_thing_and_then_some", "nnnnnnnnnnnnnnnnnnnnnnnnnnnn", "________________________", "usr/local/share/applications/menu", "Some-Header-Name-With-Many-Words"]
    found = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.scan(frame(spark, [f"see {t} there" for t in made + names]), ratios)).collect()}
    assert sum(found[i] == "markov:4:36" for i in range(40)) >= 38, found
    assert [found[40 + i] for i in range(len(names))] == [""] * len(names)


def test_markov_finds_secrets_glued_to_names(spark, ratios):
    rng = random.Random(9)
    letters, words = secrets.ALPHABET[:62], [w for r in read(spark, "documents").orderBy("doc_id").limit(50).collect() for w in re.findall("[A-Za-z]{4,}", r["text"] or "")]
    token = lambda n, of=letters: "".join(rng.choice(of) for _ in range(n))
    glued = lambda n: "".join(rng.choice(words) + rng.choice("/=_-") for _ in range(n))
    texts, want = [], []
    for made in [[token(n)] for n in (20, 24, 32) for _ in range(20)] + [[token(32, letters + "-_")] for _ in range(20)] + [[token(24), token(24), token(24)] for _ in range(20)]:
        text, spans = "é ", []
        for t in made:
            text += glued(8)
            spans.append((len(text), len(text) + len(t)))
            text += t + "/"
        texts.append(text + glued(4) + "end")
        want.append(spans)
    texts.append(glued(60) + "end")
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["found"] if s["kind"] == 3] for r in secrets.scan(frame(spark, texts), ratios).where("doc_id is not null").collect()}
    missed = [texts[i][a:b] for i, spans in enumerate(want) for a, b in spans if not any(s <= a and b <= e for s, e in found[i])]
    assert len(missed) <= 2, missed
    assert found[len(want)] == []
    assert all(sum(e - s for s, e in found[i]) < len(texts[i]) - 40 for i in range(len(want)))  # the names before stay
    secret, names = token(32), glued(8)
    masked = secrets.redact(frame(spark, [f"see {names}{secret} there"]), ratios).first()["text"]
    assert secret not in masked and masked.startswith("see " + names[:10]) and masked.endswith("[SECRET] there"), masked


def test_masking(spark, ratios):
    df = spark.createDataFrame([(1, "a password=abcdef b", 0, "k"), (2, "nothing", 7, "k"), (3, None, None, "k")], "doc_id long, text string, n_chars long, found string")
    got = rows(secrets.redact(df, ratios, length_col="n_chars"), *df.columns)
    assert got == [(1, "a [SECRET] b", 12, "k"), (2, "nothing", 7, "k"), (3, None, None, "k")]


def test_blocked_sums_and_maxima(spark):
    from pyspark.sql import functions as F
    values = [[3, 1, 2] * 70, [5], [], list(range(4200)) + [1, 9000, 2]]
    got = spark.createDataFrame([(v,) for v in values], "v array<int>").select("v", secrets.ahead(F.col("v"), secrets.add).alias("s"), secrets.ahead(F.col("v"), F.greatest).alias("m")).collect()
    for r in got:
        assert list(r["s"]) == [sum(r["v"][:i]) for i in range(len(r["v"]))]
        assert list(r["m"]) == [max(r["v"][:i], default=0) for i in range(len(r["v"]))]


def test_many_spans_of_one_long_text(spark, ratios):
    """Work grows with the length: twice the text takes at most twice the time (and a second)."""
    import time

    def spent(n):
        text = " ".join(f"token=abc{k:05d}" for k in range(n))
        df, at = frame(spark, [text]), time.monotonic()
        masked = secrets.redact(df, ratios).first()["text"]
        found = secrets.digest(secrets.scan(df, ratios)).first()
        assert masked == " ".join(["[SECRET]"] * n) and found["n_assign"] == n
        return time.monotonic() - at

    spent(100)
    assert spent(20_000) <= 2 * spent(10_000) + 1


def test_masking_joins_overlaps_over_chunks(spark, ratios):
    """Marks at chunk borders, beyond the basic plane, at both ends of the text."""
    secret = "AKIA" + "Z" * 20
    texts = [f"{'é😀' * k}{secret}" for k in (511, 512, 1024, 1500)] + [f"{secret}{'x ' * 3000}password={secret}", secret, "😀 " * 5000 + f"token={secret}/ab 😀"]
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(frame(spark, texts), ratios).collect()}
    got = [masked[k] for k in range(len(texts))]
    assert got[:4] == [t.replace(secret, "[SECRET]") for t in texts[:4]]
    assert got[4] == f"[SECRET]{'x ' * 3000}[SECRET]" and got[5] == "[SECRET]" and got[6].startswith("😀 " * 5000 + "[SECRET]")


# ---------------------------------------------------------------- pipeline
def staged_by_hand(spark, documents, labels, benchmark, sf):
    """The pipeline's documents before packing, by the brute-force versions on fitted models."""
    model = quality_ordinal.train(documents, labels, quality_ordinal.grade_of(), 3)
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    _, tail = quality_ordinal.score_batch(model, [(t or "").encode() for _, t in docs], 1)
    docs = [d for d, p in zip(docs, tail, strict=True) if p >= 0.5]
    docs = list({(d, t): (d, t) for (d, t), (_, _, c) in zip(docs, B.simhash(docs), strict=True) if d == c}.values())
    found = B.decontaminate(docs, [(r["item_id"], r["text"]) for r in benchmark.collect()])
    return [d for d, f in zip(docs, found, strict=True) if not f[5]]


def test_pipeline_is_brute_force(spark, tmp):
    sf = "/root/testdata/sf0.001"
    odd = [(10_000 + i, t, "en", "odd", 0) for i, t in enumerate(["", None, "mit password=abcdef99 und so", "mit password=abcdef99 und so"])]
    documents = read(spark, "documents", sf)
    documents = documents.union(spark.createDataFrame([*odd, odd[2]], documents.schema))
    documents.write.parquet(f"{tmp}/documents.parquet")
    for t in ("labels", "benchmark"):
        read(spark, t, sf).write.parquet(f"{tmp}/{t}.parquet")
    documents = read(spark, "documents", tmp)
    want = staged_by_hand(spark, documents, read(spark, "labels", tmp), read(spark, "benchmark", tmp), tmp)
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp)
        assert docs.columns == documents.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(kept) == sorted(d for d, _ in want)
    for d, t in want:
        masked = B.secret_base(t)[3] != ""
        assert kept[d] != t if masked else kept[d] == t
    got = corpus_pipeline.run(spark, tmp)
    assert {r[0] for r in rows(got, "doc_id")} == set(kept)
    assert sorted(got.columns) == sorted(["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def test_pipeline_of_an_empty_table(spark, tmp):
    sf = "/root/testdata/sf0.001"
    read(spark, "documents", sf).limit(0).write.parquet(f"{tmp}/documents.parquet")
    for t in ("labels", "benchmark"):
        read(spark, t, sf).write.parquet(f"{tmp}/{t}.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0
