"""op12: how far each source of a language departs from the language's words.

Terms are counted per (language, source) in one pass over the texts, merged in
the task before anything is shuffled.  A language keeps the terms found in
enough of its documents.  A term's rate in a group is a whole number,
p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)), all in exact integers.

``term`` rows, a group's most over-used terms, come from dominance skybands.
The value p - q rises with the group's count and falls with the language's, and
ties go to the earlier term in UTF-8, so a term that k others dominate in
(group count up, language count down, UTF-8 order up) cannot be among the k
best.  Partitions of a group's terms keep their k-skyband, skybands are merged
level by level, and what remains is ranked exactly.

``pair`` rows, the distances between all sources of a language (the result
itself has a row for each ordered pair), are summed over blocks of terms: a
task holds the counts of a bounded number of terms for two tiles of sources.

Defined results: null text, lang and source count as empty; repeated rows are
documents of their own; texts of any length are counted in parts; a group
without kept terms still has its pairs (value 0 in a language that keeps
none); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import pick, staged, text_bytes

SCALE, PRIOR = 1_000_000_000, 5
HELD_TERMS = 300_000    # distinct (group, term) counts that a task holds before it sends them on
TEXT_PART = 4_000_000   # bytes of a text that are split at a time
PART_TERMS = 8_192      # terms of a group's first skybands
MERGED = 16             # skybands merged at a time
BLOCK_CELLS = 100_000   # counts in a block of terms
TILE_SOURCES = 512      # sources of a tile

# ASCII letters in lower case, all bytes of other characters, the rest blank
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


# ----------------------------------------------------------------- counting
def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded part of it at a time."""
    at = 0
    while len(text) - at > TEXT_PART:
        end = at + TEXT_PART
        flat = text[at:end].translate(_TABLE)
        cut = flat.rfind(b" ")
        while cut < 0 and end < len(text):  # a term longer than a part
            end = min(len(text), end + TEXT_PART)
            flat = text[at:end].translate(_TABLE)
            cut = flat.rfind(b" ")
        if cut < 0:
            break
        yield flat[:cut].split()
        at += cut
    yield text[at:].translate(_TABLE).split()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Partial counts (lang, source, term, n occurrences, docs documents); a
    group's row with the empty term holds its documents."""
    schema = "lang string, source string, term string, n long, docs long"

    def sent(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for lang, source, text in zip(langs, sources, text_bytes(batch.column(0)), strict=True):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                n[b""] += 1
                docs[b""] += 1
                if len(text) <= TEXT_PART:
                    terms = text.translate(_TABLE).split()
                    n.update(terms)
                    docs.update(set(terms))
                else:
                    seen = set()
                    for terms in _parts(text):
                        n.update(terms)
                        seen.update(terms)
                    docs.update(seen)
                size += len(n) - before
                if size > HELD_TERMS:
                    yield from sent(held)
                    held, size = {}, 0
        yield from sent(held)

    read = pick(docs, text=text_col, lang=lang_col, source=source_col)
    return read.select("text", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).mapInArrow(count, schema)


def kept_cells(counts: DataFrame, min_docs: int = 30) -> DataFrame:
    """Counts of the kept terms (lang, source, term, n, lang_n, lead) and every
    group's row with the empty term.  One shuffle, by (lang, term): a term's
    sources meet, ``lead`` marks one row of each term."""
    cells = (counts.repartition("lang", "term").groupBy("lang", "source", "term")
             .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")
    return (cells.withColumn("lang_n", F.sum("n").over(term)).withColumn("lang_docs", F.sum("docs").over(term))
            .withColumn("lead", F.col("source") == F.min("source").over(term))
            .where((F.col("term") == "") | (F.col("lang_docs") >= min_docs))
            .select("lang", "source", "term", "n", "lang_n", "lead"))


def totals(cells: DataFrame) -> DataFrame:
    """One row per group: lang, source, total (N), lang_total, terms (V)."""
    real = F.col("term") != ""
    groups = cells.groupBy("lang", "source").agg(F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("total"))
    langs = cells.groupBy("lang").agg(F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("lang_total"),
                                      F.count(F.when(real & F.col("lead"), 1)).alias("terms"))
    return groups.join(langs, "lang")


# ------------------------------------------------------------------ skyband
def skyband(up: np.ndarray, down: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than k others dominate: ``up`` not lower,
    ``down`` not higher, ``order`` earlier.  Sorted by (up falling, down rising,
    order), all that dominate a row come before it; counting among rows already
    kept is enough, as dominance is transitive."""
    ranked = np.lexsort((order, down, -up))
    d, o = down[ranked], order[ranked]
    kept = np.empty(0, np.int64)
    step = 256
    for at in range(0, len(ranked), step):
        cd, co = d[at:at + step], o[at:at + step]
        n = ((d[kept] <= cd[:, None]) & (o[kept] < co[:, None])).sum(axis=1)
        alive = np.flatnonzero(n < k)
        ad, ao = cd[alive], co[alive]
        within = (ad <= ad[:, None]) & (ao < ao[:, None]) & np.tri(len(alive), k=-1, dtype=bool)
        kept = np.concatenate([kept, at + alive[n[alive] + within.sum(axis=1) < k]])
    return ranked[kept]


def skybands(cells: DataFrame, k: int, most_terms: int) -> DataFrame:
    """Each group's terms that fewer than k others dominate, from partitions of its terms."""
    def run(part: pa.Table) -> pa.Table:
        terms = part.column("term").cast(pa.large_binary()).combine_chunks()
        order = np.empty(len(terms), np.int64)
        order[pa.compute.sort_indices(terms).to_numpy()] = np.arange(len(terms))
        return part.take(pa.array(skyband(part.column("n").to_numpy(), part.column("lang_n").to_numpy(), order, k)))

    parts = max(1, -(-most_terms // PART_TERMS))
    band = cells.where(F.col("term") != "").select("lang", "source", "term", "n", "lang_n",
                                                   F.pmod(F.xxhash64("term"), F.lit(parts)).alias("part"))
    band = band.groupBy("lang", "source", "part").applyInArrow(run, band.schema)
    while parts > 1:
        parts = -(-parts // MERGED)
        band = band.withColumn("part", F.floor(F.col("part") / MERGED))
        band = band.groupBy("lang", "source", "part").applyInArrow(run, band.schema)
    return band.drop("part")


def _rate(n: str, total: str) -> F.Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exactly."""
    wide = lambda e: f"cast({e} as decimal(19,0))"
    return F.expr(f"1 + (({wide(f'{n} + {PRIOR}')} * {wide(SCALE)}) div {wide(f'{total} + {PRIOR} * terms')})")


def over_used(cells: DataFrame, groups: DataFrame, k: int, most_terms: int) -> DataFrame:
    """The ``term`` part: lang, source, item, value, rank up to k."""
    value = _rate("n", "total") - _rate("lang_n", "lang_total")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (skybands(cells, k, most_terms).join(groups, ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


# -------------------------------------------------------------------- pairs
def rates(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + PRIOR) / whole) in 64 bits: SCALE = 32,000 * 31,250, divided in two steps."""
    if len(whole) and int(whole.max()) > 2 ** 63 // 32_000:
        raise ArithmeticError("a language's counts lie beyond the exact range")
    first, rest = np.divmod((n + PRIOR) * 32_000, whole)
    return 1 + first * 31_250 + rest * 31_250 // whole


def distances(cells: DataFrame, groups: DataFrame, most_cells: int, most_sources: int) -> DataFrame:
    """The ``pair`` part without ranks: lang, source, item, value for both
    orders of every two sources of a language."""
    blocks, tiles = max(1, -(-most_cells // BLOCK_CELLS)), max(1, -(-most_sources // TILE_SOURCES))
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles))
    # where a pair of tiles (a <= b) meets: a source goes to every pair with its tile
    met = F.explode(F.transform(F.sequence(F.lit(0), F.lit(tiles - 1)), lambda other: F.struct(
        F.least(other, F.col("tile")).alias("a"), F.greatest(other, F.col("tile")).alias("b"))))
    sums = groups.withColumn("whole", F.col("total") + PRIOR * F.col("terms"))
    held = (sums.select("lang", "source", tile.alias("tile"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "whole", "terms",
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
            .union(cells.where(F.col("term") != "").select(
                "lang", "source", tile.alias("tile"), "term", "n", F.lit(None).cast("long").alias("whole"), F.lit(None).cast("long").alias("terms"),
                F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"))))
    held = held.withColumn("met", met).select("lang", "block", F.col("met.a").alias("a"), F.col("met.b").alias("b"), "source", "tile", "term", "n", "whole", "terms")

    def run(part: pa.Table) -> pa.Table:
        group = part.filter(pa.compute.is_null(part.column("term")))
        names = group.column("source").to_pylist()
        place = {s: i for i, s in enumerate(names)}
        whole, in_tile = group.column("whole").to_numpy(), group.column("tile").to_numpy()
        a, b, block = (int(part.column(c)[0].as_py()) for c in ("a", "b", "block"))
        lang, n_terms = part.column("lang")[0].as_py(), int(group.column("terms")[0].as_py())
        left, right = np.flatnonzero(in_tile == a), np.flatnonzero(in_tile == b)
        out = np.zeros((len(names), len(names)), np.int64)
        if n_terms:
            none = rates(np.zeros(len(names), np.int64), whole)
            found = part.filter(pa.compute.is_valid(part.column("term")))
            column = np.array([place[s] for s in found.column("source").to_pylist()], np.int64)
            row = found.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
            rate = rates(found.column("n").to_numpy(), whole[column])
            order = np.argsort(row, kind="stable")
            row, column, rate = row[order], column[order], rate[order]
            step = max(1, 1_000_000 // len(names))
            n_rows = int(row[-1]) + 1 if len(row) else 0
            for at in range(0, n_rows, step):
                m = min(step, n_rows - at)
                here = slice(*np.searchsorted(row, [at, at + m]))
                table = np.tile(none, (m, 1))
                table[row[here] - at, column[here]] = rate[here]
                for i in left:
                    out[i, right] += np.abs(table[:, right] - table[:, i:i + 1]).sum(axis=0) - m * np.abs(none[right] - none[i])
            if block == 0:  # terms that neither source has; the others' share was taken off above
                out += n_terms * np.abs(none[:, None] - none)
        i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
        if a == b:
            i, j = i[i < j], j[i < j]
        source = pa.array(names, pa.string())
        return pa.Table.from_arrays([pa.array([lang] * len(i), pa.string()), source.take(pa.array(i)), source.take(pa.array(j)), pa.array(out[i, j])],
                                    names=["lang", "source", "item", "value"])

    half = (held.groupBy("lang", "block", "a", "b").applyInArrow(run, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    return half.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p"),
                       "value").select("lang", "p.source", "p.item", "value")


def audit(docs: DataFrame, min_docs: int = 30, k: int = 50, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    cells = staged(kept_cells(term_counts(docs, text_col, lang_col, source_col), min_docs), "cells")
    groups = staged(totals(cells), "groups")
    # sizes of the largest language, for the number of parts; nothing else reaches the driver
    sizes = groups.agg(F.max("terms").alias("terms")).first()
    per_lang = cells.groupBy("lang").agg(F.count(F.lit(1)).alias("cells"), F.count(F.when(F.col("term") == "", 1)).alias("sources"))
    most = per_lang.agg(F.max("cells").alias("cells"), F.max("sources").alias("sources")).first()
    pair = distances(cells, groups, most["cells"] or 1, most["sources"] or 1)
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = pair.withColumn("rank", F.row_number().over(ranked))
    term = over_used(cells, groups, k, sizes["terms"] or 1)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("part", F.lit("pair")).select(columns).unionByName(term.withColumn("part", F.lit("term")).select(columns))
