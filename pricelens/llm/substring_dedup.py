"""Substring dedup by an exact window index over the whole corpus, in place of
a greedy relative Lempel-Ziv parse (no longest match is sought).

The corpus is its own reference, indexed in blocks dealt by window
fingerprint: an entry says where the word sequence of a window of ``window``
words starts first (smallest doc_id, then smallest start).  Every window that
may repeat is looked up; factors are put together afterwards: one copies from a
source, goes on while the next window's entry is the next place of the same
source, and ends where it is not.  At each such factor boundary the windows that cross it are looked up by
themselves, so a repeat that spans two factors is not missed.  Factors are a
window long at least; the words they cover are duplicate spans.

A text that equals one of a smaller doc_id is one factor as a whole, and is
left out of the rest.  Of the other windows most occur once and never leave
their task: a window's seed is the SEED consecutive words with the least
scrambled hash inside it, equal windows have equal seeds, and only windows
whose seed occurs more than once in the corpus are sent to the index.

Words are runs without ASCII white space, unchanged.  Null texts have none.
Rows that share a doc_id are told apart by text: an identical repeat of a row
is a copy (not earlier than itself, so nothing is removed on its account).
A null doc_id is later than any other.  A text may have 2^32 words.  Documents shorter than a window have
no window.  Very long texts are worked through in parts of PART words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from pricelens.llm.common import fields, kind_of, map_rows, mix, pick, rolling, staged, text_bytes, word_hashes

WINDOW = 20
SEED = 5
PART = 200_000
ALL = 1 << 40  # windows of a whole text
KNOWN, TELLS = 1, 2  # a seed row that needs no meeting; one that stands for a batch
BASES = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd multipliers of the two halves of a window's fingerprint


def parts(words: list[bytes], window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first word, word hashes) of overlapping parts; every window is in one of them."""
    for at in range(0, max(1, len(words) - window + 1), PART):
        yield at, word_hashes(words[at:at + PART + window - 1])


def seeds(x: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The seed of each window: the least scrambled hash of its seed-sized runs."""
    h = mix(rolling(x, seed, BASES[0]))
    span, n = window - seed + 1, len(x) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # sliding minimum by doubling
    low, width = h, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:n], low[span - width:span - width + n])


def window_max(x: np.ndarray, before: int) -> np.ndarray:
    """Of each place of an array ``before`` longer than x: the largest of x[i - before .. i] inside x."""
    wide = np.concatenate([np.zeros(before, np.uint64), x, np.zeros(before, np.uint64)])
    width = 1
    while 2 * width <= before + 1:
        wide = np.maximum(wide[:-width], wide[width:])
        width *= 2
    n = len(x) + before
    return np.maximum(wide[:n], wide[before + 1 - width:before + 1 - width + n])


def seed_places(x: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Hashes of the seeds at every place that is some window's seed (ties included)."""
    h = mix(rolling(x, seed, BASES[0]))
    least = seeds(x, window, seed)
    return h[h == window_max(least, window - seed)] if len(least) else h[:0]


def seed_counts(text: bytes, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A document's seeds and how often each occurs (a place in the overlap of
    two parts counts twice, which only sends a window to the index in vain)."""
    words = text.split()
    found = [seed_places(x, window, seed) for _, x in parts(words, window)] if len(words) >= window else []
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, version (tells rows of one doc_id apart by text), text."""
    return pick(df, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("text").alias("version"), "text")


def whole_copies(docs: DataFrame) -> DataFrame:
    """doc_id, version, src_doc of the rows whose text a smaller doc_id has."""
    same = ["version", "more", "size"]
    rows = docs.select("doc_id", "version", F.hash("text").alias("more"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    first = rows.groupBy(*same).agg(F.min("doc_id").alias("src_doc"))
    return rows.join(first, same).where(~F.col("doc_id").eqNullSafe(F.col("src_doc"))).select("doc_id", "version", "src_doc").distinct()


def without(rows: DataFrame, more: DataFrame) -> DataFrame:
    gone = more.select(F.col("doc_id").alias("doc_id2"), F.col("version").alias("version2"))
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["doc_id2"]) & (rows["version"] == gone["version2"]), "left_anti")


def beside(docs: DataFrame, more: DataFrame, name: str, how: str) -> DataFrame:
    """The documents with a column from a table of (doc_id, version, column)."""
    more = more.toDF("doc_id2", "version2", name)
    same = docs["doc_id"].eqNullSafe(more["doc_id2"]) & (docs["version"] == more["version2"])
    return docs.join(more, same, how).drop("doc_id2", "version2")


def repeated_seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """version, seeds: those of a text's seeds that occur more than once among
    different texts of the corpus.  What repeats inside a batch is known at
    once and needs no meeting: such rows are dealt anywhere, and one row for
    the batch tells the seed's partition.  So a hot seed sends a row per batch
    there, and a text of many copies too.  Two texts of one version (a 64-bit
    hash) would only get each other's seeds as well."""
    schema = fields(seed=LongType(), version=LongType(), known=IntegerType())

    def rows_of(batch: pa.RecordBatch) -> dict:
        version, rows = np.unique(batch["version"].to_numpy(), return_index=True)
        found = [seed_counts(t, window, seed) for t in text_bytes(batch["text"].take(pa.array(rows)))]
        value = np.concatenate([s for s, _ in found])
        unique, back = np.unique(value, return_inverse=True)
        known = np.bincount(back, np.concatenate([c for _, c in found]), len(unique)) > 1
        told = unique[known]
        return {"seed": np.concatenate([value, told]).view(np.int64),
                "version": np.concatenate([np.repeat(version, [len(s) for s, _ in found]), np.zeros(len(told), np.int64)]),
                "known": np.concatenate([known[back].astype(np.int32), np.full(len(told), TELLS, np.int32)])}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by seed and text: rows whose seed has another text's row beside it."""
        held, before = None, None  # the last row that counts, and the seed of the one before it
        for batch in batches:
            known = batch["known"].to_numpy()
            yield batch.filter(pa.array(known == KNOWN)).select(out)
            batch = batch.filter(pa.array(known != KNOWN))
            batch = batch if held is None else joined(held, batch)
            s, v, k = (batch[c].to_numpy() for c in ("seed", "version", "known"))
            if not len(s):
                continue
            first = np.r_[True, (s[1:] != s[:-1]) | (v[1:] != v[:-1]) | (k[1:] != k[:-1])]
            batch, s = batch.filter(pa.array(first)), s[first]
            same = np.r_[before is not None and s[0] == before, s[1:] == s[:-1]]
            last = len(s) - 1
            yield told_apart(batch.slice(0, last), same[:-1] | same[1:])
            held, before = batch.slice(last), s[last - 1] if last else before
        if held is not None:
            yield told_apart(held, np.array([before is not None and held["seed"][0].as_py() == before]))

    def told_apart(batch: pa.RecordBatch, same: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array(same & (batch["known"].to_numpy() != TELLS))).select(out)

    out = ["version", "seed"]
    place = F.when(F.col("known") == KNOWN, F.xxhash64("seed", "version")).otherwise(F.col("seed"))
    dealt = map_rows(docs, rows_of, schema).repartition(place).sortWithinPartitions("seed", "version", "known")
    return dealt.mapInArrow(meet, fields(version=LongType(), seed=LongType())).groupBy("version").agg(F.collect_set("seed").alias("seeds"))


def joined(a: pa.RecordBatch, b: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches([a, b]).combine_chunks().to_batches()[0]


def window_hashes(text: bytes, wanted: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, two fingerprints) of the windows whose seed is wanted."""
    words, wanted = text.split(), np.sort(wanted)
    out = [], [], []
    for at, x in parts(words, window):
        s = seeds(x, window, seed)
        start = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, s), len(wanted) - 1)] == s)
        if len(start):
            for part, more in zip(out, (start + at, *(rolling(x, window, b)[start] for b in BASES)), strict=True):
                part.append(more)
    return tuple(np.concatenate(p) if p else np.empty(0, t) for p, t in zip(out, (np.int64, np.uint64, np.uint64), strict=True))


def ranks(ids: pa.Array) -> np.ndarray:
    """Dense ranks of document ids, null last, equal ids alike."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    s = ids.take(pa.array(order))
    new = ~equal(s.slice(1), s.slice(0, len(s) - 1)) if len(s) > 1 else np.empty(0, bool)
    out = np.empty(len(s), np.int64)
    out[order] = np.r_[0, np.cumsum(new)]
    return out


def equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    both = pc.and_(a.is_null(), b.is_null())
    return pc.or_(pc.fill_null(pc.equal(a, b), False), both).to_numpy(zero_copy_only=False)


def copies(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, version, start, n, src_doc, src_start: n windows from ``start``
    on that also stand, one after the other, from an earlier place on."""
    kind = kind_of(docs, "doc_id")
    whole = staged(whole_copies(docs), "copies")
    wanted = without(docs.select("doc_id", "version").distinct(), whole).join(repeated_seeds(docs, window, seed), "version")
    wanted = wanted.select("doc_id", "version", "seeds")
    picked = beside(docs, wanted, "seeds", "inner")
    out = fields(doc_id=kind, version=LongType(), start=LongType(), n=LongType(), src_doc=kind, src_start=LongType())
    run = fields(n=LongType(), src_doc=kind, src_start=LongType())
    schema = fields(h1=LongType(), h2_start=LongType(), doc_id=kind, version=LongType(), run=run)  # few columns, as there are many rows

    def rows_of(batch: pa.RecordBatch) -> dict:
        """Windows of one batch: the first of equal ones goes to the index,
        the others have found an earlier place already."""
        flat = batch["seeds"]
        off = flat.offsets.to_numpy()
        value = flat.values.to_numpy().view(np.uint64)
        found = [window_hashes(t, value[a:z], window, seed) for t, a, z in zip(text_bytes(batch["text"]), off[:-1], off[1:], strict=True)]
        row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        start, h1, h2 = (np.concatenate([f[k] for f in found]) for k in range(3))
        h2 >>= np.uint64(32)  # 96 bits in all
        rank = ranks(batch["doc_id"])[row]
        order = np.lexsort((start, rank, h2, h1))
        row, start, h1, h2, rank = (c[order] for c in (row, start, h1, h2, rank))
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(row) else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
        late = (rank != rank[first]) | (start != start[first])
        # the late ones in runs: next window, next place of one source
        place = np.flatnonzero(late)[np.lexsort((start[late], row[late]))]
        src = first[place]
        goes_on = np.r_[False, (row[place][1:] == row[place][:-1]) & (start[place][1:] == start[place][:-1] + 1)
                        & (row[src][1:] == row[src][:-1]) & (start[src][1:] == start[src][:-1] + 1)] if len(place) else np.empty(0, bool)
        head = np.flatnonzero(~goes_on)
        n = np.diff(np.r_[head, len(place)])
        at, src = place[head], src[head]
        ask = np.flatnonzero(~late)
        ask = ask[np.lexsort((start[ask], row[ask]))]  # neighbours share most bytes, so they pack well
        rows = np.concatenate([row[ask], row[at]])
        source = pa.array(np.concatenate([row[ask], row[src]]), pa.int64(), mask=np.arange(len(rows)) < len(ask))
        spread = mix(mix(np.arange(len(at), dtype=np.uint64)) ^ h1[at])  # settled rows are dealt anywhere
        packed = h2 << np.uint64(32) | start.astype(np.uint64)
        settled = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(len(ask), np.int64), n])), batch["doc_id"].take(source),
                                              pa.array(np.concatenate([np.zeros(len(ask), np.int64), start[src]]))], ["n", "src_doc", "src_start"], mask=pa.array(np.arange(len(rows)) < len(ask)))
        return {"h1": np.concatenate([h1[ask], spread]).view(np.int64), "h2_start": np.concatenate([packed[ask], packed[at]]).view(np.int64),
                "doc_id": batch["doc_id"].take(pa.array(rows)), "version": batch["version"].take(pa.array(rows)), "run": settled}

    names = [f.name for f in out]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by fingerprint and place, the first row of a run is the
        index entry and the rest copy from it."""
        held = None  # the entry of the run that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if held is None else joined(held, batch)
            h1, packed = (batch[c].to_numpy() for c in ("h1", "h2_start"))
            h2, start, settled = packed >> 32, packed & 0xFFFFFFFF, batch["run"].is_valid().to_numpy(zero_copy_only=False)
            index = np.arange(len(h1))
            entry = np.maximum.accumulate(np.where(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])], index, 0))
            mine = batch["doc_id"]
            late = ~settled & ((start != start[entry]) | ~equal(mine, mine.take(pa.array(entry))))
            new = index >= (held is not None)
            take, source = np.flatnonzero(late & new), entry[late & new]
            found = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([found["doc_id"], found["version"], pa.array(start[take]), pa.array(np.ones(len(take), np.int64)),
                                              mine.take(pa.array(source)), pa.array(start[source])], names)
            known = batch.filter(pa.array(settled & new))
            yield pa.RecordBatch.from_arrays([known["doc_id"], known["version"], pa.array(start[settled & new]), *known["run"].flatten()], names)
            held = batch.slice(int(entry[-1]), 1)

    order = [F.col("h1"), F.shiftright("h2_start", 32), F.col("doc_id").asc_nulls_last(), F.col("h2_start")]
    found = map_rows(picked, rows_of, schema).repartition("h1").sortWithinPartitions(*order).mapInArrow(look_up, out)
    return found.union(whole.select("doc_id", "version", F.lit(0).cast("long"), F.lit(ALL).cast("long"), "src_doc", F.lit(0).cast("long")))


def factors_of(found: list[dict] | None, n_words: int, window: int) -> list[tuple[int, int, object, int]]:
    """(first word, words, source document, first word there) of each factor: windows whose places follow each other."""
    out: list[list] = []
    for f in sorted(found or [], key=lambda f: f["start"]):
        if out and out[-1][0] + out[-1][1] == f["start"] and out[-1][2] == f["src_doc"] and out[-1][3] + out[-1][1] == f["src_start"]:
            out[-1][1] += f["n"]
        else:
            out.append([f["start"], f["n"], f["src_doc"], f["src_start"]])
    return [(a, min(n + window - 1, n_words - a), doc, at) for a, n, doc, at in out if n_words >= window]


def parse(df: DataFrame, window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_words, n_removed, kept (the text's remaining words
    joined by a space) and factors (start, length, src_doc, src_start)."""
    docs = keyed(df, id_col, text_col)
    kind = kind_of(docs, "doc_id")
    found = copies(docs, window, seed).groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n", "src_doc", "src_start")).alias("found"))
    whole = beside(docs, found, "found", "left")
    factor = ArrayType(fields(start=LongType(), length=LongType(), src_doc=kind, src_start=LongType()))
    schema = fields(doc_id=kind, n_words=LongType(), n_removed=LongType(), kept=StringType(), factors=factor)

    def run(batch: pa.RecordBatch) -> dict:
        n, removed, kept, factors = [], [], [], []
        for text, found in zip(text_bytes(batch["text"]), batch["found"].to_pylist(), strict=True):
            words = text.split()
            parsed = factors_of(found, len(words), window)
            left, edge = words, 0
            if parsed:
                left = []
                for a, size, _, _ in parsed:  # by first word; they may overlap
                    left += words[edge:a] if a > edge else []
                    edge = max(edge, a + size)
                left += words[edge:]
            n.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8", "replace"))
            factors.append([{"start": a, "length": z, "src_doc": d, "src_start": s} for a, z, d, s in parsed])
        return {"doc_id": batch["doc_id"], "n_words": n, "n_removed": removed, "kept": kept, "factors": factors}

    return map_rows(whole, run, schema)


def digest(parsed: DataFrame) -> DataFrame:
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
