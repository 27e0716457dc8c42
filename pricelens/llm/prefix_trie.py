"""op13: the prefix trie of all conversations by van Emde Boas recursion.

A sequence's depths 1 .. D-1 (D a power of two) are cut at D/2, each half at
its half, and so on.  Instances of one level of the recursion, the upper trie
and every lower forest alike, are handled together.

*Down*: names.  The name of a cut prefix is a digest of the name of the prefix
it extends (the forest's root) and the digest of the half between, so D/2 is
named first, then D/4 and 3D/4, down to single turns.  Digests of aligned
halves are built beforehand, two halves a level.  Equal names are equal
prefixes (128 bits of SHA-256).  Conversations are worked on in chunks of
CHUNK turns, whose digests are the turns of a shorter sequence, named the same
way; a conversation of any length is thus spread over tasks.

*Up*: totals.  A node is kept under its smallest member, which is then the
smallest of every deeper node on its path.  At a cut in depth d (an odd
multiple of 2^j) the totals of the lower forest's roots are added to the cut
node, and the cut node's total is grafted on its ancestors in the upper part,
the depths above d - 2^j, so all totals are whole after log2(D) levels.

Defined results: a null conversation id is no conversation; null turns come
first, null role or text counts as empty; turns of one number are ordered by
role, then by digest; repeated rows are turns of their own; an empty table
gives no rows (no root either); texts of any length enter by digest and byte
length only; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import pick, staged

CHUNK_BITS = 12          # 2^12 turns of a conversation in a task
END_IDS = 4096           # ids that are joined in one piece before hashing
_ROOT = b"\0" * 16       # name of the empty prefix


def _digest(of: Column) -> Column:
    return F.unhex(F.substring(F.sha2(of, 256), 1, 32))


# -------------------------------------------------------------------- turns
def numbered(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, pos (from 0), digest, bytes: every turn without its text.  Turns
    are range-partitioned by their order and numbered in their partition; a
    conversation's partitions are then put in a row, so none is too long."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv is not null")
             .select("conv", "turn", role.alias("role"), F.octet_length(text).cast("long").alias("bytes"),
                     _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest")))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = staged(turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
                    .select("conv", "digest", "bytes", "at", F.shiftright("at", 33).alias("part")), "turns")
    parts = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).select("conv", "part", "skip")
    return placed.join(parts, ["conv", "part"]).select("conv", (F.col("at") + F.col("skip")).alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame, family: int, share: int) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv, length; rows: conv, depth, digest, bytes).  Each
    conversation takes its first h = crc32 % share turns from the first of its
    family, then its own turns after its first h."""
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select("conv", "n", (F.crc32(F.col("conv").cast("string").cast("binary")) % share).alias("h"),
                         (F.col("conv") - F.col("conv") % family).alias("base"))
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = staged(convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
                   .select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length")), "conversations")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").where("pos >= h").select(
        "conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "bytes")
    first = turns.where(F.col("pos") < share).withColumnRenamed("conv", "base")
    given = convs.where("taken > 0").select("conv", "base", "taken").join(first, "base").where("pos < taken").select(
        "conv", (F.col("pos") + 1).alias("depth"), "digest", "bytes")
    return convs.select("conv", "length"), own.union(given)


# -------------------------------------------------------------------- names
def named(rows: DataFrame, longest: int) -> DataFrame:
    """Adds to (conv, depth, digest) rows the name of the prefix that ends
    there and of the one before it (``above``)."""
    levels = min(CHUNK_BITS, longest.bit_length())
    size = 1 << CHUNK_BITS
    at = F.col("at")
    path = Window.partitionBy("conv", "chunk").orderBy("at")
    rows = (rows.withColumn("chunk", F.floor((F.col("depth") - 1) / size)).withColumn("at", (F.col("depth") - 1) % size + 1)
            .withColumn("half", F.col("digest")))
    for j in range(1, levels + 1):  # digests of aligned stretches of 2^j turns, kept at their last turn
        rows = rows.withColumn("half", F.when(at % (1 << j) == 0, _digest(F.concat(F.lag("half", 1 << (j - 1)).over(path), F.col("half"))))
                               .otherwise(F.col("half")))
    rows = rows.withColumn("start", F.lit(_ROOT)).withColumn("name", F.lit(None).cast("binary"))
    if longest >= size:  # chunks' ends are named first, as the turns of a shorter sequence
        rows = staged(rows, "halves")
        tops = staged(named(rows.where(at == size).select("conv", (F.col("chunk") + 1).alias("depth"), F.col("half").alias("digest")), longest >> CHUNK_BITS), "tops")
        starts = tops.select("conv", F.col("depth").alias("chunk"), F.col("name").alias("from"))
        ends = tops.select("conv", (F.col("depth") - 1).alias("chunk"), F.lit(size).alias("at"), F.col("name").alias("end"))
        rows = (rows.join(starts, ["conv", "chunk"], "left").withColumn("start", F.coalesce("from", "start"))
                .join(ends, ["conv", "chunk", "at"], "left").withColumn("name", F.col("end")).drop("from", "end"))
    for j in range(levels, -1, -1):  # cuts at odd multiples of 2^j
        step = 1 << j
        forest = F.when(at == step, F.col("start")).otherwise(F.lag("name", step).over(path))
        rows = rows.withColumn("name", F.when(F.col("name").isNull() & (at % (2 * step) == step), _digest(F.concat(forest, F.col("half")))).otherwise(F.col("name")))
    return rows.withColumn("above", F.coalesce(F.lag("name", 1).over(path), F.col("start"))).drop("chunk", "at", "half", "start", "digest")


# ------------------------------------------------------------------- totals
def _sums(parts: list[DataFrame], *keys: str) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def grafted(paths: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Subtree sums of ``leaves`` and ``saved`` for every node (conv, depth).

    ``nodes``: conv, depth, parent, leaves, saved (own values); ``paths``: every
    conversation's way, conv, depth, rep, parent (the node there and above)."""
    sums, whole = [nodes.select("conv", "depth", "parent", "leaves", "saved")], []
    for j in range(1, longest.bit_length()):
        step = 1 << j
        # lower forests: their roots' totals, and the cut nodes' own values
        roots = [s.where((F.col("depth") - 1) % (2 * step) == step).select(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth"), "leaves", "saved") for s in sums]
        cuts = sums[0].where(F.col("depth") % (2 * step) == step).select("conv", "depth", "leaves", "saved")
        cuts = staged(_sums([cuts, *roots], "conv", "depth"), f"cuts-{j}")
        whole.append(cuts)
        # onto the ancestors in the upper part, found on the way of the cut node's smallest member
        way = paths.where(F.col("depth") % (2 * step) < step).where(F.col("depth") % step != 0).withColumn("cut", F.ceil(F.col("depth") / step) * step)
        upper = way.join(cuts.withColumnRenamed("depth", "cut"), ["conv", "cut"])
        upper = upper.select(F.col("rep").alias("conv"), "depth", "parent", "leaves", "saved")
        sums.append(staged(_sums([upper], "conv", "depth", "parent"), f"upper-{j}"))
    columns = ["conv", "depth", "leaves", "saved"]
    odd = [sums[0].where(F.col("depth") % 2 == 1).select(columns)]
    return _sums([*odd, *[c.select(columns) for c in whole], *[s.select(columns) for s in sums[1:]]], "conv", "depth")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(conv, depth, member) -> SHA-256 of each node's members, ascending and
    comma-joined.  Members are joined in pieces of neighbouring ids; a node's
    pieces then pass one after the other through one running hash."""
    pieces = ends.groupBy("conv", "depth", F.floor(F.col("member") / END_IDS).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    ordered = pieces.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv", "depth", "ids")), strict=True):
                if (conv, depth) == node:
                    digest.update(b",")
                else:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (conv, depth), hashlib.sha256()
                digest.update(ids.encode())
            yield out(done)
        if node:
            yield out([(*node, digest.hexdigest())])

    def out(rows):
        conv, depth, ends = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(ends, pa.string())], names=["conv", "depth", "ends_sha256"])

    return ordered.mapInArrow(run, "conv long, depth long, ends_sha256 string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
         family: int = 5, share: int = 9) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns = staged(numbered(conversations, conv_col, turn_col, role_col, text_col), "numbered")
    convs, rows = rebuilt(turns, family, share)
    seen = convs.agg(F.max("length").alias("longest"), F.min("conv").alias("first"), F.count(F.lit(1)).alias("n")).first()
    longest, root, n = int(seen["longest"] or 0), seen["first"], seen["n"]
    root_id = F.lit(root).cast("long")

    ways = staged(named(rows, max(1, longest)), "ways")
    groups = ways.groupBy("depth", "name").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.max("above").alias("above"))
    groups = staged(groups, "groups")
    parents = groups.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("above"), F.col("conv").alias("parent"))
    kids = parents.join(groups.select("depth", "above"), ["depth", "above"]).groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = (groups.join(parents, ["depth", "above"], "left").withColumn("parent", F.when(F.col("depth") == 1, root_id).otherwise(F.col("parent")))
             .join(kids, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
             .select("conv", "depth", "name", "parent", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                     ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))
    nodes = staged(nodes, "nodes")
    paths = staged(ways.select("conv", "depth", "name").join(nodes.select("depth", "name", F.col("conv").alias("rep"), "parent"), ["depth", "name"])
                   .select("conv", "depth", "rep", "parent"), "paths")
    totals = staged(grafted(paths, nodes, max(1, longest)), "totals")

    last = convs.where("length > 0").select("conv", F.col("length").alias("depth")).join(paths, ["conv", "depth"])
    ends = _end_hashes(last.select(F.col("rep").alias("conv"), "depth", F.col("conv").alias("member"))
                       .union(convs.where("length = 0").select(root_id, F.lit(0).cast("long"), "conv")))
    top = totals.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("leaves").alias("leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    top = top.select(root_id.alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(n).cast("long").alias("n_convs"),
                     "n_children", F.coalesce("leaves", F.lit(1).cast("long")).alias("leaves"), "saved").where(F.col("n_convs") > 0)
    body = nodes.select("conv", "depth", "parent", "n_convs", "n_children").join(totals, ["conv", "depth"])
    return (body.unionByName(top).join(ends, ["conv", "depth"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
