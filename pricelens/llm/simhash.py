"""SimHash near-duplicates, candidates filtered by the pigeonring principle.

A fingerprint is cut into distance + 1 parts (three at least) on a ring.  If two fingerprints
differ in at most ``distance`` bits, then from some segment on every chain of
consecutive segments stays within its proportional budget
floor(length * distance / SEGMENTS).  With five segments and distance 4 the
first segment must agree and the first two may differ in one bit.  So each
fingerprint is indexed under its five (segment, next segment) pairs and asks
for the pairs with one 0 bit of the second part set (the other direction is
found from the other side).  A candidate passes chain by chain before its full
distance, which is the last chain.

Equal fingerprints are one node, so copies cost nothing.  A bucket gives only
a spanning forest of its links, not all pairs.  Buckets above BLOCK
fingerprints are dealt out as pairs of blocks, so no task has more than two
blocks of one.  Components come from distributed star contraction.

Null or word-less texts have the fingerprint zero and link like any other.
Repeated rows stay rows.  A null doc_id names a component only if the
component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from pricelens.llm.common import fields, kind_of, map_rows, row_key, staged, text_bytes
from pricelens.llm.graph import connected_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
HELD, ASKING, HELD_APART = 0, 1, 2  # a row's role in a bucket
BLOCK = 4_096
PART = 200_000  # shingles hashed at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A-Z in lower case (bytes.lower leaves other bytes), words between ASCII
    white space, each shingle's XXH64 with seed 42; bits set in over half."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, PART):
        h = np.array([xxh64_intdigest(joined[a:z], 42) for a, z in zip(starts[k:min(k + PART, n)], last[k:k + PART], strict=True)], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k1, k2 (the row's key) and fp of every row."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), *row_key(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    schema = fields(doc_id=kind_of(df, id_col), k1=LongType(), k2=IntegerType(), fp=LongType())
    return map_rows(rows, lambda b: {"doc_id": b["doc_id"], "k1": b["k1"], "k2": b["k2"], "fp": [fingerprint(t, shingle) for t in text_bytes(b["text"])]}, schema)


def layout(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments, as even as can be."""
    cuts = [BITS * k // segments for k in range(segments + 1)]
    return [(a, z - a) for a, z in zip(cuts, cuts[1:], strict=False)]


def bucket_rows(fps: np.ndarray, segments: int, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, role, index into fps): HELD rows are indexed there, ASKING rows
    look there for a neighbour of one more set bit in the second segment (if
    the first chain of two has a budget of one)."""
    u, parts = fps.view(np.uint64), layout(segments)
    bit = lambda x: np.uint64(x)
    seg = [(u >> bit(a)) & bit((1 << w) - 1) for a, w in parts]
    keys, roles, rows = [], [], []
    every = np.arange(len(u))
    for i in range(segments):
        j = (i + 1) % segments
        base = (bit(i) << bit(60)) | (seg[i] << bit(28))
        keys.append(base | seg[j])
        roles.append(np.full(len(u), HELD, np.int32))
        rows.append(every)
        for b in range(parts[j][1] if budget else 0):
            off = np.flatnonzero((seg[j] >> bit(b)) & bit(1) == 0)
            keys.append((base | seg[j] | bit(1 << b))[off])
            roles.append(np.full(len(off), ASKING, np.int32))
            rows.append(off)
    return np.concatenate(keys).view(np.int64), np.concatenate(roles), np.concatenate(rows)


def linked(x: np.ndarray, y: np.ndarray, start: int, distance: int, segments: int) -> np.ndarray:
    """Which pairs pass every chain from segment ``start``; the full chain is the Hamming check."""
    diff, parts = x ^ y, layout(segments)
    total = np.zeros(diff.shape, np.uint8)
    alive = np.ones(diff.shape, bool)
    for length in range(1, segments + 1):
        a, w = parts[(start + length - 1) % segments]
        total = total + np.bitwise_count((diff >> np.uint64(a)) & np.uint64((1 << w) - 1))
        alive &= total <= length * distance // segments
    return alive


def forest(held: np.ndarray, others: np.ndarray, start: int, distance: int, segments: int, among: bool) -> list[tuple[int, int]]:
    """A spanning forest of one bucket's links: held fingerprints with the
    others, and (if ``among``) with each other."""
    nodes = np.concatenate([held, others])
    u, parent, out = nodes.view(np.uint64), list(range(len(nodes))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(held)):
        first = i + 1 if among else len(held)
        for j in (first + np.flatnonzero(linked(u[first:], u[i], start, distance, segments))).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], np.ndarray, np.ndarray]]:
    """((key, a, b), role, fp) of each run of equal keys of two or more rows, across batches."""
    rest = None
    for batch in batches:
        now = [batch[n].to_numpy() for n in ("key", "a", "b", "role", "fp")]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        cuts = cut_points(now)
        yield from runs(now, cuts)
        rest = [x[cuts[-1]:] for x in now]  # the last run may go on
    if rest is not None and len(rest[0]):
        yield from runs(rest, np.array([0, len(rest[0])]))


def cut_points(columns: list[np.ndarray]) -> np.ndarray:
    key, a, b = columns[:3]
    new = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.flatnonzero(np.r_[True, new])


def runs(columns: list[np.ndarray], cuts: np.ndarray) -> Iterator[tuple[tuple[int, int, int], np.ndarray, np.ndarray]]:
    for k in np.flatnonzero(np.diff(cuts) > 1).tolist():
        rows = slice(cuts[k], cuts[k + 1])
        yield tuple(int(columns[n][cuts[k]]) for n in range(3)), columns[3][rows], columns[4][rows]


def asked_from(key: np.ndarray, count: np.ndarray, segments: int) -> dict:
    """A large bucket and those its fingerprints ask."""
    widths = [w for _, w in layout(segments)]
    keys, sizes = [key], [count]
    for i in range(segments):
        at = np.flatnonzero(key >> 60 == i)
        for b in range(widths[(i + 1) % segments]):
            off = at[(key[at] >> b) & 1 == 0]
            keys.append(key[off] | (1 << b))
            sizes.append(count[off])
    return {"key": np.concatenate(keys), "size": np.concatenate(sizes)}


def links(distinct: DataFrame, distance: int = DISTANCE, segments: int | None = None) -> DataFrame:
    """(u, v): enough links between distinct fingerprints ``fp`` to connect
    whatever links of at most ``distance`` bits connect."""
    segments = segments or max(3, distance + 1)
    if segments < 3 or distance >= segments:
        raise ValueError("the first segment of a chain must agree: more segments than bits of distance, three at least")

    def rows_of(batch: pa.RecordBatch) -> dict:
        fps = batch["fp"].to_numpy()
        key, role, at = bucket_rows(fps, segments, 2 * distance // segments)
        return {"key": key, "role": role, "fp": fps[at]}

    rows = map_rows(distinct, rows_of, fields(key=LongType(), role=IntegerType(), fp=LongType()))
    held = map_rows(distinct, lambda b: {"key": bucket_rows(b["fp"].to_numpy(), segments, 0)[0]}, fields(key=LongType()))
    large = staged(held.groupBy("key").count().where(F.col("count") > BLOCK), "buckets")
    if large.isEmpty():
        dealt = rows.withColumns({"a": F.lit(0), "b": F.lit(0)})
    else:
        asked = map_rows(large, lambda b: asked_from(b["key"].to_numpy(), b["count"].to_numpy(), segments), fields(key=LongType(), size=LongType()))
        sizes = asked.groupBy("key").agg(F.ceil(F.max("size") / F.lit(BLOCK)).cast("int").alias("n"))
        rows = rows.join(sizes, "key", "left").withColumn("n", F.coalesce("n", F.lit(1)))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
        kept = ["key", "role", "fp"]
        dealt = rows.where(f"role = {HELD}").select(*kept, F.col("block").alias("a"), every.alias("b"))
        dealt = dealt.union(rows.where(f"role = {ASKING}").select(*kept, every.alias("a"), F.col("block").alias("b")))
        below = F.explode(F.sequence(F.lit(0), F.col("block") - 1))
        dealt = dealt.union(rows.where(f"role = {HELD} and block > 0").select("key", F.lit(HELD_APART).alias("role"), "fp", below.alias("a"), F.col("block").alias("b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, a, b), role, fp in groups_of(batches):
            mine, others = fp[role == HELD], fp[role != HELD]
            if len(mine) and (len(others) or len(mine) > 1):
                if found := forest(mine, others, key >> 60, distance, segments, a == b):
                    u, v = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    order = ["key", "a", "b"]
    ready = dealt.select(*order, "role", "fp").repartition(*order).sortWithinPartitions(*order)
    return ready.mapInArrow(run, fields(u=LongType(), v=LongType()))


def classes(prints: DataFrame, distance: int) -> DataFrame:
    """fp, component (a fingerprint of it) and least (doc_id) for every distinct fingerprint."""
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    joined = connected_components(links(nodes.select("fp"), distance)).withColumnRenamed("node", "fp")
    return nodes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def components(df: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (the least doc_id reachable) of every row."""
    prints = staged(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    nodes = classes(prints, distance)
    names = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = nodes.join(names, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def representatives(df: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns as they are: that of the least
    doc_id (a null one only if there is no other); of repeated rows one."""
    prints = staged(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    best = prints.groupBy("fp").agg(F.min(order).alias("best")).join(classes(prints, distance).select("fp", "component"), "fp")
    stay = best.groupBy("component").agg(F.min("best").alias("best")).select(F.col("best.k1").alias("k1"), F.col("best.k2").alias("k2"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *row_key(id_col, text_col))
    return rows.dropDuplicates(["k1", "k2"]).join(stay, ["k1", "k2"], "left_semi").select("row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
