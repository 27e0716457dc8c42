"""op11: exact top-k inner products from a bit-sliced index.

Components are quantised to integers and stored column by column as bit
slices: slice s of dimension j is a bitmap over the rows of a block, holding
bit s of (value - least value of the block).  A query's score of *all* rows of
a block is one sum of slices: every non-zero signed binary digit of a weight
adds the dimension's slices (their complements for a negative digit), shifted
by the digit's place.  Carry-save adders add three bitmaps of one place into
one of that place and one of the next.  The sum's own slices are then walked
from the most significant one downward, keeping the rows that are surely
among the k best and those still level; rows level at the end are the
boundary, resolved by their order (ids ascending).  Scores are read off the
sum's slices, so they are exact.

Blocks are built where the rows are read (no shuffle).  Queries are held in
blocks, too; each group of index blocks meets each query block in one task,
and only k rows a query and group go on.

Defined results: a row whose vector is null, or has a null or non-finite
component, takes no part; vectors of different lengths are compared over the
shorter one's components; rows that share the query's id are its own and not
among its candidates; a null id is a candidate (last among ties), never a
query; a repeated query row is answered again; repeated candidate rows each
take a rank; an empty table gives no rows; further columns are not read.
Quantised components must lie within 2^60 and scores within 64 bits, or the
query raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import pick, staged

BLOCK_ROWS = 32_768     # rows of an index block
QUERY_ROWS = 16_384     # queries of a query block
GROUP_BLOCKS = 8        # index blocks that a task holds, once there are many
LARGEST = 2.0 ** 60     # of a quantised component

_BLOCK = "n_rows int, n_known int, dims int, ids binary, low binary, widths binary, slices binary"
_QUERY = "n_rows int, dims int, keys binary, ids binary, weights binary"


# ------------------------------------------------------------- quantisation
def quantised(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(places of the rows that take part, their integers [rows, dims]);
    shorter vectors are filled with zeros."""
    if isinstance(column.type, pa.FixedSizeListType):
        column = column.cast(pa.list_(column.type.value_type))
    starts = np.asarray(column.offsets)[:-1]
    lengths = np.where(np.asarray(column.is_valid()), np.diff(np.asarray(column.offsets)), -1)
    values = column.values.cast(pa.float64())
    flat = values.to_numpy(zero_copy_only=False)  # null components come as NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    takes = (lengths >= 0) & (bad[starts + np.maximum(lengths, 0)] == bad[starts])
    rows = np.flatnonzero(takes)
    dims = int(lengths[rows].max(initial=0))
    at = starts[rows, None] + np.arange(dims)
    there = np.arange(dims) < lengths[rows, None]
    with np.errstate(over="ignore"):
        scaled = np.floor(np.where(there, flat[np.where(there, at, 0)], 0.0) * scale) if dims else np.zeros((len(rows), 0))
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ArithmeticError("a quantised component lies beyond 2^60")
    return rows, scaled.astype(np.int64)


def _padded(parts: list[np.ndarray]) -> np.ndarray:
    dims = max(p.shape[1] for p in parts)
    return np.vstack([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for p in parts])


# -------------------------------------------------------------------- index
def sliced(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """[rows, dims] integers -> least value and slice count of each dimension,
    and the slices [sum of counts, words] in order of dimension, then place."""
    n, dims = values.shape
    low = values.min(axis=0)
    above = (values - low).astype(np.uint64)
    widths = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
    first = np.concatenate([[0], np.cumsum(widths)])
    slices = np.zeros((int(first[-1]), -(-n // 64)), np.uint64)
    for s in range(int(widths.max(initial=0))):
        held = np.flatnonzero(widths > s)
        bits = np.packbits(((above[:, held] >> np.uint64(s)) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        slices[first[held] + s] = np.pad(bits, ((0, 0), (0, slices.shape[1] * 8 - bits.shape[1]))).view(np.uint64)
    return low, widths, slices


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """One row per block of up to BLOCK_ROWS rows of an input partition; the
    rows of a block are in order of their ids, null last."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, parts, held = [], [], [], 0
        for batch in batches:
            rows, values = quantised(batch.column(1), scale)
            key = batch.column(0).cast(pa.int64())
            for at in range(0, len(rows), BLOCK_ROWS):
                chosen = rows[at:at + BLOCK_ROWS]
                ids.append(key.fill_null(0).to_numpy(zero_copy_only=False)[chosen])
                known.append(np.asarray(key.is_valid())[chosen])
                parts.append(values[at:at + BLOCK_ROWS])
                held += len(chosen)
                if held >= BLOCK_ROWS:
                    yield block(np.concatenate(ids), np.concatenate(known), _padded(parts))
                    ids, known, parts, held = [], [], [], 0
        if held:
            yield block(np.concatenate(ids), np.concatenate(known), _padded(parts))

    def block(ids, known, values):
        order = np.lexsort((ids, ~known))
        low, widths, slices = sliced(values[order])
        return pa.RecordBatch.from_pydict({
            "n_rows": pa.array([len(ids)], pa.int32()), "n_known": pa.array([int(known.sum())], pa.int32()),
            "dims": pa.array([values.shape[1]], pa.int32()), "ids": [ids[order].tobytes()], "low": [low.tobytes()],
            "widths": [widths.tobytes()], "slices": [slices.tobytes()]})

    return pick(vectors, id=id_col, vector=vector_col).mapInArrow(build, _BLOCK)


def query_blocks(queries: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """The queries' weights, up to QUERY_ROWS in a row; ``keys`` tells query rows apart."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(at, QUERY_ROWS)
                rows, values = quantised(pa.concat_arrays([part.column(1)]), scale)
                if len(rows):
                    yield pa.RecordBatch.from_pydict({
                        "n_rows": pa.array([len(rows)], pa.int32()), "dims": pa.array([values.shape[1]], pa.int32()),
                        "keys": [part.column(2).to_numpy()[rows].tobytes()], "ids": [part.column(0).cast(pa.int64()).to_numpy()[rows].tobytes()],
                        "weights": [values.tobytes()]})

    return pick(queries, id=id_col, vector=vector_col, key="key").mapInArrow(build, _QUERY)


# ----------------------------------------------------------------- addition
def signed_digits(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-adjacent form of non-negative integers: x = plus - minus, no two neighbouring digits set."""
    half = x >> np.uint64(1)
    sum_ = x + half
    differs = half ^ sum_
    return sum_ & differs, half & differs


def _columns(rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Carry-save addition of bitmaps of one place: (the place's slice, bitmaps of the next place)."""
    carries = []
    while len(rows) > 1:
        m = len(rows) // 3
        if m:
            a, b, c = rows[:m], rows[m:2 * m], rows[2 * m:3 * m]
            odd = a ^ b
            carry = a & b
            carry |= odd & c
            odd ^= c
            rows = np.concatenate([odd, rows[3 * m:]])
        else:
            carry = rows[:1] & rows[1:]
            rows = rows[:1] ^ rows[1:]
        carries.append(carry)
    return rows[0], carries


class Block:
    """An index block in memory, ready to score queries."""

    def __init__(self, row: dict):
        self.n, self.known = row["n_rows"], row["n_known"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.low = np.frombuffer(row["low"], np.int64)
        self.widths = np.frombuffer(row["widths"], np.int64)
        self.words = -(-self.n // 64)
        slices = np.frombuffer(row["slices"], np.uint64).reshape(-1, self.words)
        self.both = np.concatenate([slices, ~slices])
        self.count = len(slices)
        self.dim_of = np.repeat(np.arange(len(self.widths)), self.widths)
        self.place = np.concatenate([np.arange(w) for w in self.widths] or [np.empty(0, np.int64)]).astype(np.int64)
        self.rows = self._bitmap(np.arange(self.n))

    def _bitmap(self, at: np.ndarray) -> np.ndarray:
        bits = np.zeros(self.words * 64, np.uint8)
        bits[at] = 1
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def summed(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices (least significant first) of score - base over all rows, and base."""
        w = np.zeros(len(self.widths), np.int64)
        common = min(len(w), len(weights))
        w[:common] = weights[:common]
        plus, minus = signed_digits(np.abs(w).astype(np.uint64))
        plus, minus = np.where(w < 0, minus, plus), np.where(w < 0, plus, minus)
        most = [(1 << int(k)) - 1 for k in self.widths]
        # a digit -1 adds the complement, which is 2^width - 1 too much
        base = sum(int(a) * int(b) for a, b in zip(w, self.low)) - sum(int(a) * b for a, b in zip(minus, most))
        digits = int(max(plus.max(initial=0), minus.max(initial=0))).bit_length()
        places, rows = [], []
        for shift in range(digits):
            for held, offset in ((plus, 0), (minus, self.count)):
                at = np.flatnonzero((held[self.dim_of] >> np.uint64(shift)) & np.uint64(1))
                places.append(self.place[at] + shift)
                rows.append(at + offset)
        places = np.concatenate(places) if places else np.empty(0, np.int64)
        rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
        order = np.argsort(places, kind="stable")
        rows, ends = rows[order], np.cumsum(np.bincount(places)) if len(places) else []
        out, carried, start, p = [], [], 0, 0
        while p < len(ends) or carried:
            stop = int(ends[p]) if p < len(ends) else start
            now = np.concatenate([self.both[rows[start:stop]], *carried]) if stop > start or carried else np.zeros((1, self.words), np.uint64)
            slice_, carried = _columns(now)
            out.append(slice_)
            start, p = stop, p + 1
        return out, base

    def best(self, weights: np.ndarray, own: int, k: int) -> tuple[list[int], list[int]]:
        """Places and scores of the k best rows (own ids apart), ties to the earlier row."""
        sums, base = self.summed(weights)
        a, z = np.searchsorted(self.ids[:self.known], [own, own + 1])
        level = self.rows if a == z else self.rows & ~self._bitmap(np.arange(a, z))
        sure = np.zeros(self.words, np.uint64)
        n_sure = 0
        if int(np.bitwise_count(level).sum()) <= k:
            sure, level = level, sure
        else:
            for bits in reversed(sums):
                high = level & bits
                n = n_sure + int(np.bitwise_count(high).sum())
                if n > k:
                    level = high
                    continue
                sure, n_sure, level = sure | high, n, level & ~bits
                if n == k:
                    level = np.zeros(self.words, np.uint64)
                    break
        chosen = self._places(sure)
        if len(chosen) < k:
            chosen = np.concatenate([chosen, self._places(level)[:k - len(chosen)]])
        scores = [base] * len(chosen)
        for p, bits in enumerate(sums):
            for i, on in enumerate((bits[chosen >> 6] >> (chosen & 63).astype(np.uint64)) & np.uint64(1)):
                scores[i] += int(on) << p
        return chosen.tolist(), scores

    def _places(self, bitmap: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        word, bit = np.nonzero(bits)
        return words[word] * 64 + bit


# ------------------------------------------------------------------- search
_FOUND = "query_key long, query_id long, vec_id long, score long"


def _searcher(k: int):
    def run(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["n_rows", "n_known", "dims", "ids", "low", "widths", "slices"]
        asked = []
        for q in queries.select(["n_rows", "dims", "keys", "ids", "weights"]).to_pylist():
            asked += zip(np.frombuffer(q["keys"], np.int64).tolist(), np.frombuffer(q["ids"], np.int64).tolist(),
                         np.frombuffer(q["weights"], np.int64).reshape(q["n_rows"], q["dims"]))
        best = [[] for _ in asked]
        for at in range(blocks.num_rows):
            block = Block(blocks.select(names).slice(at, 1).to_pylist()[0])
            for found, (_, own, weights) in zip(best, asked):
                places, scores = block.best(weights, own, k)
                found += [(-s, p >= block.known, int(block.ids[p])) for p, s in zip(places, scores)]
                found.sort()
                del found[k:]
        out = [(key, own, None if unknown else row, -s) for found, (key, own, _) in zip(best, asked) for s, unknown, row in found]
        if any(not -2 ** 63 <= r[3] < 2 ** 63 for r in out):
            raise ArithmeticError("a score lies beyond 64 bits")
        columns = zip(*out) if out else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_key", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """The k highest integer inner products of every query row (``is_query``,
    over the ids) with all other rows: query_id, rank (from 1), vec_id, score;
    ties to the smaller id."""
    spark = vectors.sparkSession
    rows = pick(vectors, vec=vector_col, id=id_col)
    asked = staged(vectors.where(is_query & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vec"))
                   .withColumn("key", F.monotonically_increasing_id()), "queries")
    n = asked.count()
    queries = staged(query_blocks(asked.repartition(max(1, -(-n // QUERY_ROWS))), "id", "vec", scale)
                     .withColumn("q", F.monotonically_increasing_id()), "query-blocks")
    blocks = staged(index(rows, "id", "vec", scale).withColumn("at", F.monotonically_increasing_id()), "index")
    # blocks' keys are few (one row in BLOCK_ROWS or QUERY_ROWS); each side is repeated for the other's groups
    n_blocks, n_queries = blocks.count(), queries.count()
    groups = max(1, min(n_blocks, max(-(-n_blocks // GROUP_BLOCKS), 2 * spark.sparkContext.defaultParallelism)))
    left = blocks.withColumn("g", F.pmod(F.xxhash64("at"), F.lit(groups))).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_queries - 1)))))
    number = queries.select("q").withColumn("h", F.row_number().over(Window.orderBy("q")) - 1)
    right = queries.join(number, "q").withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    found = left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(_searcher(k), _FOUND)
    order = Window.partitionBy("query_key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
