"""Best-fit packing of tokenised documents into fixed-length sequences.

Vector best-fit: an open sequence has three residual capacities (tokens,
document count, attention cost = sum of squared piece lengths).  Pieces go
from long to short; each is put into that open sequence, among those with
room under every constraint, which the weighted dot product of demand and
residual (largest) or the weighted norm of what would be left (smallest)
selects.  Only documents longer than a sequence are cut.

Scale: lengths are staged without the texts; random groups of about
``GROUP_SEQUENCES`` sequences' worth of tokens are packed independently, one
at a time, so a task holds a bounded number of pieces whatever the keys look
like, and each group wastes at most a few part-filled sequences.

Null text: as empty, a document of only the end id.  Repeated rows (also of
one doc_id) are separate documents.  An empty table gives no pieces.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructType

from pricelens.llm.common import fields, kind_of, map_rows, pick, staged
from pricelens.llm.token_counts import byte_symbols

CACHE_WORDS = 500_000
GROUP_SEQUENCES = 2_000
GROUP_PIECES = 50_000
MOST_TASKS = 20_000  # beyond so many groups a task packs several, one after the other
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")  # characters that the normaliser only lower-cases
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")  # the vocabulary's own pattern, on those


class Encoder:
    """Ids of a text, as the tokenizers library gives them.  White space never
    reaches a pre-token, so each distinct word is encoded once and kept.
    Words of printable ASCII and Latin-1 letters are only lower-cased and
    split here, and the library's model encodes each of their pre-tokens
    once; any other word goes through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        symbols = byte_symbols()
        self.as_symbols = {c: "".join(symbols[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.ids: dict[bytes, bytes] = {}
        self.pre: dict[str, bytes] = {}

    def encode_piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() else piece.translate(self.as_symbols)
        return struct.pack(f"<{len(ids)}I", *ids) if len(ids := [t.id for t in self.model.tokenize(symbols)]) > 1 else ids[0].to_bytes(4, "little")

    def learn(self, words: set[bytes]) -> None:
        other = []
        for w in words:
            text = w.decode("utf-8", "replace")
            if not _PLAIN.fullmatch(text) or "<|" in text:
                other.append((w, text))
                continue
            pieces = _PIECES.findall(text.lower())
            for piece in pieces:
                if piece not in self.pre:
                    self.pre[piece] = self.encode_piece(piece)
            self.ids[w] = b"".join(map(self.pre.__getitem__, pieces))
        found = self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)
        self.ids.update((w, np.array(e.ids, "<u4").tobytes()) for (w, _), e in zip(other, found, strict=True))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (a string array without nulls)."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.values.dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        if len(self.ids) > CACHE_WORDS:
            self.ids = {}
        if len(self.pre) > CACHE_WORDS:
            self.pre = {}
        self.learn(set(words).difference(self.ids))
        found = list(map(self.ids.__getitem__, words))
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        word = coded.indices.to_numpy()  # the distinct word at each place
        sizes = size[word]
        ends = np.cumsum(sizes)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[word] - (ends - sizes), sizes)]
        before = np.concatenate([[0], ends])
        off = lists.offsets.to_numpy()
        for a, z in zip(before[off[:-1]].tolist(), before[off[1:]].tolist(), strict=True):
            yield ids[a:z]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def piece_table(df: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        row, piece, start, length, crc = [], [], [], [], []
        end = np.array([end_id], "<u4")
        for i, ids in enumerate(encoder(path).encode(pc.fill_null(batch["text"].cast(pa.string()), ""))):
            ids = np.concatenate([ids, end])
            for k, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at:at + capacity]
                row.append(i)
                piece.append(k)
                start.append(at)
                length.append(len(part))
                crc.append(zlib.crc32(part))
        return {"doc_id": batch["doc_id"].take(pa.array(row, pa.int64())), "piece": piece, "start": start, "length": length, "ids_crc32": crc}

    schema = fields(doc_id=kind_of(df, id_col), piece=IntegerType(), start=LongType(), length=LongType(), ids_crc32=LongType())
    return map_rows(pick(df, doc_id=id_col, text=text_col), run, schema)


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_attention: int,
             weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece (see the module text)."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    limits = np.array([capacity, max_docs, max_attention], float)
    w = np.array(weights)[:, None]
    room = np.empty((3, 64))
    ids = np.empty(64, np.int64)
    m = made = 0
    order = np.argsort(-lengths, kind="stable")
    least = lengths.min(initial=capacity)
    for i in order.tolist():
        size = int(lengths[i])
        need = np.array([[size], [1.0], [float(size) ** 2]])
        at = -1
        if m:
            rest = room[:, :m] - need
            fits = (rest >= 0).all(axis=0)
            if fits.any():
                if rule == "norm":
                    cost = (w * (rest / limits[:, None]) ** 2).sum(axis=0)
                else:
                    cost = -(w * (need / limits[:, None]) * (room[:, :m] / limits[:, None])).sum(axis=0)
                at = int(np.argmin(np.where(fits, cost, np.inf)))
        if at < 0:  # a piece over the attention limit alone still gets a sequence of its own
            if m == room.shape[1]:
                room, ids = np.hstack([room, np.empty_like(room)]), np.r_[ids, np.empty_like(ids)]
            at, m = m, m + 1
            room[:, at], ids[at] = limits, made
            made += 1
        bins[i], offsets[i] = ids[at], capacity - int(room[0, at])
        room[:, at] -= need[:, 0]
        if room[0, at] < least or room[1, at] < 1 or room[2, at] < float(least) ** 2:  # closed: the last open one takes its place
            m -= 1
            room[:, at], ids[at] = room[:, m], ids[m]
    return bins, offsets


def pack(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, max_docs: int = 4096, max_attention: int = 4096 * 4096,
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece with its sequence_id and offset.  The defaults of
    max_docs and max_attention never bind beside 4096 tokens, so that as few
    sequences as possible are used; lower them to bound either."""
    pieces = staged(piece_table(df, path, capacity, end_id, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("n")).first()
    groups = max(1, math.ceil(total["tokens"] / (capacity * GROUP_SEQUENCES)), math.ceil(total["n"] / GROUP_PIECES))
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    schema = StructType([*pieces.drop("row").schema.fields, *fields(sequence_id=LongType(), offset=LongType()).fields])
    arrow = to_arrow_schema(schema)

    def packed(part: pa.Table) -> Iterator[pa.RecordBatch]:
        bins, offsets = best_fit(part["length"].to_numpy(), capacity, max_docs, max_attention, weights, rule)
        columns = [part[f.name].combine_chunks() for f in arrow if f.name not in ("sequence_id", "offset")]
        columns += [pa.array((part["group"][0].as_py() << 32) + bins), pa.array(offsets)]
        return pa.Table.from_arrays(columns, schema=arrow).to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by group, one group at a time."""
        held: list[pa.RecordBatch] = []  # the group that may go on
        for batch in batches:
            group = batch["group"].to_numpy()
            cuts = np.flatnonzero(np.r_[not held or group[:1] != held[0]["group"][0].as_py(), group[1:] != group[:-1]]) if len(group) else []
            for a, z in zip([0, *cuts], [*cuts, len(group)], strict=True):
                if a in cuts and held:
                    yield from packed(pa.Table.from_batches(held))
                    held = []
                if z > a:
                    held.append(batch.slice(a, z - a))
        if held:
            yield from packed(pa.Table.from_batches(held))

    return grouped.repartition(min(groups, MOST_TASKS), "group").sortWithinPartitions("group", "row").mapInArrow(run, schema)
