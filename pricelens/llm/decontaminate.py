"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items are normalised (A-Z in lower case; words are runs of ASCII
letters, digits and all non-ASCII characters) and cut into windows of
``size`` words, or one window if shorter.  All windows make one automaton
over " word word ... "; each normalised text is scanned once.  Matches are
mapped back by word index to character offsets of the original text.

Null texts have no words, very long ones are scanned whole, repeated rows
are each judged.  Items without words make no window.  Repeated item ids count
once, and a null id counts as the id "null".  An empty benchmark hits nothing.

The benchmark never passes the driver.  Items are cut into pieces that overlap
by a window less a word, and tasks write the pieces, in shards of at most
``SHARD_BYTES`` of text (or one piece), to the shared folder; the driver knows
the shards' names.  A task builds the automaton of one shard at a time from its
file (some 650 bytes of memory a byte of text), so its memory is bounded
however large the benchmark or one of its items grows.  Beyond one shard it
gathers ``BLOCK_BYTES`` of documents, which each automaton scans in turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from pricelens.llm.common import fields, kind_of, map_rows, pick, slices, text_bytes
from pricelens.llm.warc import store
from pricelens.session import scratch_dir

SHARD_BYTES = 1_000_000
PIECE_WORDS = 2_000
BLOCK_BYTES = 64_000_000
WINDOW = 10

# word bytes: digits, letters (in lower case) and everything beyond ASCII; the rest becomes a space
_NORMAL = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def word_spans(text: bytes) -> list[tuple[int, int]]:
    """Character offsets, in the original text, of the words."""
    flat = np.frombuffer(text.translate(_NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.r_[False, flat, False].astype(np.int8)))
    chars = np.cumsum(np.r_[0, (np.frombuffer(text, np.uint8) & 0xC0) != 0x80])  # code points before a byte
    return [(int(chars[a]), int(chars[z])) for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def item_windows(text: bytes, size: int) -> list[bytes]:
    words = normal_words(text)
    return [b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))] if words else []


def automaton(items: list[tuple[str, bytes]], size: int) -> ahocorasick.Automaton:
    """Each window's value is its number of words and the ids of its items."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in item_windows(text, size):
            owners.setdefault(w, set()).add(item)
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(sorted(ids))))
    a.make_automaton()
    return a


def scan(a: ahocorasick.Automaton, text: bytes) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, which of them are hit, and the items that occur."""
    words = normal_words(text)
    hit, items = np.zeros(0, bool), set()
    if words and len(a):
        found = list(a.iter(f" {b' '.join(words).decode('latin-1')} "))
        if found:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # of the space after each word
            last = np.searchsorted(ends, [e for e, _ in found])
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, last + 1, -1)
            np.add.at(edge, last + 1 - [n for _, (n, _) in found], 1)
            hit = np.cumsum(edge[:-1]) > 0
            for ids in {ids for _, (_, ids) in found}:
                items.update(ids)
    return len(words), hit, items


def pieces(benchmark: DataFrame, size: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """item, text (normalised): every item in pieces of ``words`` windows, each once."""
    def run(batch: pa.RecordBatch) -> dict:
        out = {"item": [], "text": []}
        for item, text in zip(batch["item"].to_pylist(), text_bytes(batch["text"]), strict=True):
            own = normal_words(text)
            for at in range(0, max(1, len(own) - size + 1) if own else 0, words):
                out["item"].append(item)
                out["text"].append(b" ".join(own[at:at + words + size - 1]))
        return out

    rows = pick(benchmark, item=id_col, text=text_col).select(F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"), "text")
    return map_rows(rows, run, fields(item=StringType(), text=BinaryType())).dropDuplicates()


class Shards:
    """The benchmark's automata, by the names of their files."""

    def __init__(self, folder: str, names: list[str], size: int):
        self.folder, self.names, self.size = folder, names, size

    def automaton(self, name: str) -> ahocorasick.Automaton:
        """Built once in a Python worker as long as no other is asked for."""
        key = (self.folder, name, self.size)
        if key not in _BUILT:
            _BUILT.clear()
            system, path = store(f"{self.folder}/shard={name}")
            items = pq.read_table(path, filesystem=system, columns=["item", "text"], partitioning=None)
            _BUILT[key] = automaton(list(zip(items["item"].to_pylist(), items["text"].to_pylist(), strict=True)), self.size)
        return _BUILT[key]

    def scan(self, texts: list[bytes]) -> list[tuple[int, np.ndarray, set[str]]]:
        """scan() of each text by all automata; the one at hand comes first."""
        found = [(len(normal_words(t)), np.zeros(0, bool), set()) for t in texts] if len(self.names) != 1 else []
        for name in sorted(self.names, key=lambda n: (self.folder, n, self.size) not in _BUILT):
            now = [scan(self.automaton(name), t) for t in texts]
            found = [(n, either(h, old), i | more) for (n, h, i), (_, old, more) in zip(now, found, strict=True)] if found else now
        return found

    def blocks(self, batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
        """Batches that are scanned together."""
        held, size = [], 0
        for batch in batches:
            for part in slices(batch):
                held.append(part)
                size += part.nbytes
                if size >= least or len(self.names) < 2:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def judged(self, batches: Iterator[pa.RecordBatch], at: int, least: int) -> Iterator[tuple[pa.RecordBatch, list]]:
        """Each batch with what its texts (column ``at``) hold."""
        for block in self.blocks(batches, least):
            found = iter(self.scan([t for part in block for t in text_bytes(part.column(at))]))
            for part in block:
                yield part, [next(found) for _ in range(part.num_rows)]


_BUILT: dict[tuple, ahocorasick.Automaton] = {}


def either(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a | b if len(a) and len(b) else a if len(a) else b


def shards(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> Shards:
    """Writes the benchmark's pieces by running bytes; a task's shards are its own."""
    spark, most = benchmark.sparkSession, SHARD_BYTES
    cut = pieces(benchmark, size, PIECE_WORDS, id_col, text_col)
    total = cut.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    kind = fields(item=StringType(), text=BinaryType(), shard=StringType())

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, shard, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            names = []
            for n in (len(t) for t in batch["text"].to_pylist()):
                if held and held + n > most:
                    shard, held = shard + 1, 0
                held += n
                names.append(f"t{task}-{shard}")
            yield pa.RecordBatch.from_arrays([batch["item"].cast(pa.string()), batch["text"].cast(pa.binary()), pa.array(names, pa.string())], names=kind.names)

    folder = scratch_dir(spark, "benchmark")
    cut.coalesce(max(1, -(-total // most))).mapInArrow(numbered, kind).write.partitionBy("shard").parquet(folder)
    names = spark.read.schema(kind).parquet(folder).select("shard").distinct().collect() if total else []
    return Shards(folder, sorted(r["shard"] for r in names), size)


def clean(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, in which no window of any item occurs."""
    parts, at, least = shards(benchmark, size, item_col, item_text_col), documents.columns.index(text_col), BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in parts.judged(batches, at, least):
            yield part.filter(pa.array([not h.any() for _, h, _ in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))


def find(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted as strings), spans (character
    offsets of the runs of hit words in the original text) for every row."""
    row = fields(doc_id=kind_of(documents, id_col), n_words=LongType(), n_hit=LongType(), items=ArrayType(StringType()), spans=SPANS)
    parts, least, arrow = shards(benchmark, size, item_col, item_text_col), BLOCK_BYTES, to_arrow_schema(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in parts.judged(batches, 1, least):
            out = result(part, found)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c := out[f.name], pa.Array) else pa.array(c, f.type) for f in arrow], schema=arrow)

    return pick(documents, doc_id=id_col, text=text_col).mapInArrow(run, row)


def result(batch: pa.RecordBatch, found: list[tuple[int, np.ndarray, set[str]]]) -> dict:
    spans = []
    for t, (_, hit, _) in zip(text_bytes(batch["text"]), found, strict=True):
        runs = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))) if hit.any() else []
        at = word_spans(t) if len(runs) else []
        spans.append([{"start": at[a][0], "end": at[z - 1][1]} for a, z in zip(runs[::2], runs[1::2], strict=True)])
    return {"doc_id": batch["doc_id"], "n_words": [n for n, _, _ in found], "n_hit": [int(h.sum()) for _, h, _ in found],
            "items": [sorted(s) for _, _, s in found], "spans": spans}


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
