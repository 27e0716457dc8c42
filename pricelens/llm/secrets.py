"""Secret scans in plain DataFrame functions.

Base kinds are found by their patterns.  Beyond them, long runs of identifier
characters are judged by two character Markov models, one of random strings
and one of ordinary identifiers.  Judged are the best stretches of a run's
pieces between the characters of ``GLUE``: the running sum of the transitions'
log-likelihood ratios, less ``MIN_MEAN`` a character, begins anew after a piece
where it has fallen to nothing, or by ``MIN_RATIO`` from its height, so ordinary
names joined to a secret don't outweigh it, and several secrets in one run are
all found (transitions from or to a character of ``GLUE`` weigh nothing here).
A stretch's ratio must reach ``MIN_RATIO``.  It is widened over neighbouring
pieces that weigh less than ``MIN_RATIO`` against it, so that no end of a secret
stays, and must have ``MIN_SIZE`` characters, ``MIN_DISTINCT`` different ones
(rules of dashes don't).  A run without such a stretch counts as a whole when
its sum over all transitions reaches both bounds.
Both models are counted from labelled samples: (string, label) rows.

Offsets come from the lengths of what stands between the matches (split) and
of the matches, added in blocks of blocks, all inside the row: no shuffle.  No
step takes a text's part by its offset in the whole text or compares spans with
spans, so the work on a text grows with its length, however many matches it has
(``ahead``: but for the square of a 4,096th of them).  A single run of
identifier characters is the exception: its judging grows faster than its length.

Null texts are empty.  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import pick
from pricelens.llm.labelled import labelled_texts

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # greedy runs: the same matches as any length, then 20 characters or more
HEX = "[0-9a-f]{24,}"
MIN_SIZE = 20
RUN = f"[A-Za-z0-9+/_=-]{{{MIN_SIZE},}}"
GLUE = "/_=-"  # the last of ALPHABET
KINDS = ["assign", "access", "hex", "markov"]
MIN_ASSIGNED = 6
MIN_RATIO, MIN_MEAN, MIN_DISTINCT = 10.0, 0.3, 8
SAMPLE_DOCUMENTS, SAMPLE_RANDOM = 400, 2_000
BLOCK = 64
CHUNK = 1024
SPAN = "array<struct<start:int,kind:int,end:int>>"
STRETCHES = "array<struct<start:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value evaluated once however often it is used
    (a column inside a lambda is evaluated for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def add(a: Column, b: Column) -> Column:
    return a + b


def ahead(numbers: Column, merge: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """For each place the numbers (none below 0) before it, merged, by blocks of
    BLOCK places, whose own numbers are merged the same way: m numbers take
    about 64 m + (m / 4096)^2 steps."""
    def fold(values):
        return F.aggregate(values, F.lit(0), lambda acc, x: merge(acc, x))

    def block(i):
        return F.floor(i / F.lit(BLOCK)).cast("int")

    def merged_before(all_):
        if not levels:
            return F.transform(all_, lambda _, i: fold(F.slice(all_, F.lit(1), i)))
        each = F.transform(F.sequence(F.lit(0), block(F.size(all_))), lambda b: fold(F.slice(all_, b * BLOCK + 1, F.lit(BLOCK))))
        return let(ahead(each, merge, levels - 1), lambda before: F.transform(
            all_, lambda _, i: merge(F.get(before, block(i)), fold(F.slice(all_, block(i) * BLOCK + 1, i % BLOCK)))))

    return let(numbers, merged_before)


def matches(text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the pattern's matches whose ``group`` has ``least`` characters."""
    lengths = lambda strings: F.transform(strings, lambda s: F.length(s))
    gaps = lengths(F.split(text, pattern, -1))
    sizes = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    wanted = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))) if group else sizes
    found = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), wanted.alias("wanted"))  # the last gap has no match after it

    def spans(m):
        before = ahead(F.transform(m, lambda x: x["gap"] + F.coalesce(x["size"], F.lit(0))), add)
        placed = F.zip_with(m, before, lambda x, b: F.struct((b + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (b + x["gap"] + x["size"]).alias("end"), x["wanted"].alias("wanted")))
        good = F.filter(placed, lambda s: s["end"].isNotNull() & (s["wanted"] >= least))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(SPAN)

    return F.when(F.col(text).rlike(pattern), let(found, spans)).otherwise(F.array().cast(SPAN))


def samples(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """(value, label) rows: 1 random strings of three alphabets (digests of
    counted numbers), 0 ordinary identifiers (words of well-rated documents,
    alone and in compound names).  Bounded by SAMPLE_RANDOM and SAMPLE_DOCUMENTS."""
    spark = documents.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = spark.range(SAMPLE_RANDOM).select(F.explode(F.array(
        F.translate(F.base64(F.unhex(digest)), "\r\n", ""), F.substring(digest, 1, 40), F.upper(F.translate(F.base64(F.unhex(digest)), "+/=\r\n", "xyz")))).alias("value"), F.lit(1).alias("label"))
    texts = labelled_texts(documents, labels, F.col(f"`{quality_col}`"), {1: SAMPLE_DOCUMENTS}, id_col, text_col, label_id)
    words = texts.select(F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), F.lit(0)).alias("words"))
    marks = F.split(F.lit("_ - / ="), " ")
    pairs = F.transform("words", lambda w, i: F.concat(F.lower(w), F.get(marks, i % 4), F.lower(F.get("words", i + 1))))  # the last one is null
    dashed = F.transform("words", lambda w, i: F.concat(w, F.lit("-"), (i % 100).cast("string")))
    names = F.concat("words", F.transform("words", lambda w: F.upper(w)), pairs, dashed)
    return random.union(words.where(F.size("words") > 1).select(F.explode(names).alias("value"), F.lit(0).alias("label")))


def train(labelled: DataFrame) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) for every pair of
    ALPHABET, row by row.  Only pair counts (bounded by the alphabet) leave Spark."""
    k = len(ALPHABET)
    codes = labelled.select("label", F.transform(F.filter(F.split("value", ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)).alias("codes"))
    pairs = codes.select("label", F.explode(F.zip_with(F.slice("codes", 1, F.greatest(F.size("codes") - 1, F.lit(0))), F.slice("codes", 2, F.size("codes")), lambda a, b: F.when((a > 0) & (b > 0), (a - 1) * k + b - 1))).alias("pair"))
    seen = [[1.0] * (k * k), [1.0] * (k * k)]  # add-one
    for row in pairs.where("pair is not null").groupBy("label", "pair").count().collect():
        seen[row["label"]][row["pair"]] += row["count"]
    of = [[math.log(n / sum(c[p // k * k:p // k * k + k])) for p, n in enumerate(c)] for c in seen]
    return [r - o for r, o in zip(of[1], of[0], strict=True)]


def steps(codes: Column, table: list[float]) -> Column:
    """The transitions' log-likelihood ratios."""
    k = len(ALPHABET)
    values = F.split(F.lit(",".join(f"{v:.4f}" for v in table)), ",").cast("array<double>")  # folded to one literal
    return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: F.get(values, (a - 1) * k + b - 1))


def forward(codes: Column, ratios: Column) -> Column:
    """Stretches (start, end) of a run's pieces in one pass: from the piece at which
    the sum begins to the last one before it falls by MIN_RATIO."""
    def named(**values):
        return F.struct(*[v.alias(k) for k, v in values.items()])

    def one(start, end):
        return F.array(named(start=start, end=end)).cast(STRETCHES)

    def piece_end(acc, total, ratio):
        on = acc["on"] | ((total > 0) & (ratio >= MIN_RATIO))
        fell = acc["best"] - total >= MIN_RATIO
        anew = F.when(on, fell).otherwise(total <= 0)
        zero = lambda v: F.when(anew, F.lit(0.0)).otherwise(v)
        return named(at=acc["at"] + 1, start=F.when(anew, acc["at"] + 1).otherwise(acc["start"]), end=F.when(on & ~fell, acc["at"]).otherwise(acc["end"]),
                     sum=zero(total), ratio=zero(ratio), best=zero(F.greatest(acc["best"], total)), on=on & ~anew,
                     found=F.when(on & fell, F.when(full(acc), one(acc["start"], acc["end"])).otherwise(F.concat(acc["found"], one(acc["start"], acc["end"])))).otherwise(acc["found"]),
                     earlier=F.when(on & fell & full(acc), F.concat(acc["earlier"], F.array(acc["found"]))).otherwise(acc["earlier"]))

    def full(acc):
        return F.size(acc["found"]) >= BLOCK

    def step(acc, c):
        total, ratio = acc["sum"] + c["x"] - MIN_MEAN, acc["ratio"] + c["x"]
        inside = named(at=acc["at"] + 1, start=acc["start"], end=acc["end"], sum=total, ratio=ratio, best=acc["best"], on=acc["on"], found=acc["found"], earlier=acc["earlier"])
        return F.when(c["cut"], piece_end(acc, total, ratio)).otherwise(inside)

    x = F.concat(F.array(F.lit(0.0)), ratios, F.array(F.lit(0.0)))  # into each character, and the run's end
    cut = F.concat(F.transform(codes, lambda c: c > len(ALPHABET) - len(GLUE)), F.array(F.lit(True)))
    state = named(at=F.lit(0), start=F.lit(0), end=F.lit(0), sum=F.lit(0.0), ratio=F.lit(0.0), best=F.lit(0.0), on=F.lit(False), found=F.array().cast(STRETCHES),
                  earlier=F.array().cast(f"array<{STRETCHES}>"))  # full blocks, so that arrays are not copied for each stretch
    return F.aggregate(F.arrays_zip(x.alias("x"), cut.alias("cut")), state, step, lambda acc: F.concat(
        F.flatten(acc["earlier"]), acc["found"], F.when(acc["on"], one(acc["start"], acc["end"])).otherwise(F.array().cast(STRETCHES))))


def joined(spans: Column) -> Column:
    """Overlapping spans as one (start, end), in order."""
    def firsts(s, before):
        """Spans that begin at or after the end of all before them."""
        return F.filter(F.zip_with(s, before, lambda x, b: F.struct(x["start"].alias("start"), b.alias("before"))), lambda x: x["start"] >= x["before"])

    def groups(s):
        ends = F.transform(s, lambda x: x["end"])
        return let(F.array_max(ends), lambda last: let(firsts(s, ahead(ends, F.greatest)), lambda first: F.transform(first, lambda x, i: F.struct(
            x["start"].alias("start"), F.coalesce(F.get(first, i + 1)["before"], last).alias("end"))).cast(STRETCHES)))

    return let(F.array_sort(spans), groups)


def stretches(codes: Column, table: list[float]) -> Column:
    """The stretches (start, end) of a run that count as secrets."""
    k, own = len(ALPHABET), len(ALPHABET) - len(GLUE)
    inner = [v if p // k < own and p % k < own else 0.0 for p, v in enumerate(table)]

    def judged(r):
        size, ratio = F.size(codes), F.aggregate(steps(codes, table), F.lit(0.0), lambda acc, x: acc + x)
        back = F.transform(forward(F.reverse(codes), F.reverse(r)), lambda s: F.struct((size - s["end"]).alias("start"), (size - s["start"]).alias("end")))
        mixed = lambda s: F.size(F.array_distinct(F.slice(codes, s["start"] + 1, s["end"] - s["start"]))) >= MIN_DISTINCT
        whole = F.array(F.struct(F.lit(0).alias("start"), size.alias("end"))).cast(STRETCHES)
        best = F.filter(joined(F.concat(forward(codes, r), back)), lambda s: (s["end"] - s["start"] >= MIN_SIZE) & mixed(s))
        return let(best, lambda b: F.when((F.size(b) > 0) | (ratio < MIN_RATIO) | (ratio < MIN_MEAN * size), b).otherwise(F.filter(whole, mixed)))

    return let(steps(codes, inner), judged)


def scan(df: DataFrame, table: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, base (spans of the three base kinds) and found (base and
    markov spans by start, then kind) of every row."""
    rows = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return with_spans(rows, table)


def with_spans(rows: DataFrame, table: list[float]) -> DataFrame:
    """The same on any frame with a non-null ``text``, whose columns stay."""
    base = F.array_sort(F.concat(matches("text", ASSIGN, 0, 2, MIN_ASSIGNED), matches("text", ACCESS, 1), matches("text", HEX, 2)))
    rows = rows.withColumn("base", base).withColumn("runs", matches("text", RUN, 3))
    values = F.when(F.size("runs") > 0, F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    runs = F.transform(F.arrays_zip(F.col("runs").alias("span"), values.alias("value")), lambda r: F.struct(
        r["span"].alias("span"), F.transform(F.filter(F.split(r["value"], F.lit("")), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)).alias("codes")))
    best = F.flatten(F.transform(runs, lambda r: F.transform(stretches(r["codes"], table), lambda s: F.struct(
        (r["span"]["start"] + s["start"]).alias("start"), r["span"]["kind"].alias("kind"), (r["span"]["start"] + s["end"]).alias("end")))))
    found = F.when(F.size("runs") > 0, uncovered(F.col("base"), best)).otherwise(F.col("base"))
    return rows.withColumn("found", found).drop("runs")


def uncovered(base: Column, best: Column) -> Column:
    """Base spans and those of the best that lie in no base span, sorted."""
    def marked(spans, new):
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(new).alias("new"), s["kind"].alias("kind"), s["end"].alias("end")))

    def kept(both):  # base spans come before others of the same start
        reach = ahead(F.transform(both, lambda s: F.when(s["new"] == 0, s["end"]).otherwise(0)), F.greatest)
        seen = F.zip_with(both, reach, lambda s, r: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), ((s["new"] == 0) | (r < s["end"])).alias("use")))
        return F.transform(F.filter(seen, lambda s: s["use"]), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(SPAN)

    return F.array_sort(let(F.array_sort(F.concat(marked(base, 0), marked(best, 1))), kept))


def listed(spans: str) -> Column:
    names = F.lit(KINDS)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])], F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("found").alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by the mark: the
    pieces between them are put together from chunks of the text."""
    def whole(n):
        return F.floor(n / F.lit(CHUNK)).cast("int")

    def piece(chunks, start, end):
        a, z = whole(start), whole(end - 1)
        parts = F.transform(F.slice(chunks, a + 1, z - a + 1), lambda c, k: F.substr(
            c, F.when(k == 0, start % CHUNK).otherwise(0) + 1, F.when(k == z - a, (end - 1) % CHUNK + 1).otherwise(CHUNK) - F.when(k == 0, start % CHUNK).otherwise(0)))
        return F.when(end > start, F.array_join(parts, "")).otherwise("")

    def out(chunks, gone):
        between = F.transform(gone, lambda s, i: piece(chunks, F.coalesce(F.get(gone, i - 1)["end"], F.lit(0)), s["start"]))
        rest = piece(chunks, F.coalesce(F.get(gone, F.size(gone) - 1)["end"], F.lit(0)), F.length(text))
        return F.array_join(F.concat(between, F.array(rest)), mark)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), lambda chunks: let(joined(spans), lambda gone: out(chunks, gone)))


def redact(df: DataFrame, table: list[float], text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows with every span masked, all other columns as they are (but for
    ``length_col``, counted again where the text has changed)."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = with_spans(rows, table).withColumn("changed", F.size("found") > 0)
    found = found.withColumn("masked", F.when(F.col("changed"), redacted(F.col("text"), F.col("found"))))
    new = {text_col: F.when(F.col("changed"), F.col("masked")).otherwise(F.col(f"row.`{text_col}`"))}
    if length_col:
        old = F.col(f"row.`{length_col}`")
        new[length_col] = F.when(F.col("changed"), F.length("masked").cast(df.schema[length_col].dataType)).otherwise(old)
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in df.columns])
