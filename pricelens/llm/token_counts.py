"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch are held as one ragged numpy array of symbol ids.
In every round each sequence finds the lowest rank among its adjacent pairs
and all sequences apply theirs at the same time; what is left when no pair
has a rank is the token count.  The vocabulary file is read where it lies,
by path; its own normaliser and pre-tokeniser prepare the words.

Null text: as empty (0 bytes, 0 tokens).  Repeated rows: one result each.
Very long texts: words are counted once each, so memory follows the number
of distinct words, which is bounded by ``CACHE_WORDS`` between batches.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType

from pricelens.llm.common import by_size, fields, kind_of, map_rows, pick, text_bytes

CACHE_WORDS = 300_000
GROUP_BYTES = 4_000_000
MERGE_WORDS = 100_000  # pre-tokens merged at a time
NO_RANK = np.iinfo(np.int64).max
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")  # letters that the normaliser only lower-cases


def byte_symbols() -> list[str]:
    """The printable stand-in for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


@dataclass
class MergeTable:
    keys: np.ndarray  # left << 32 | right, sorted
    ranks: np.ndarray
    results: np.ndarray
    lone: np.ndarray  # by rank: apply at the leftmost place only, as a result may take part in a lower rank
    first: np.ndarray  # symbol id of a byte
    last: np.ndarray  # symbol id of a byte that ends a word

    @classmethod
    def of(cls, model: dict) -> MergeTable:
        vocab, end = dict(model["vocab"]), model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = lambda s: vocab.setdefault(s, len(vocab))
        symbols = byte_symbols()
        first, last = [np.array([ids(s + e) for s in symbols], np.int64) for e in ("", end)]
        left, right, out = (np.array(x, np.int64) for x in zip(*[(ids(a), ids(b), ids(a + b)) for a, b in pairs], strict=True))
        used = np.full(len(vocab) + 1, NO_RANK)
        rank = np.arange(len(pairs))
        np.minimum.at(used, left, rank)
        np.minimum.at(used, right, rank)
        order = np.argsort(left << 32 | right, kind="stable")
        return cls((left << 32 | right)[order], rank[order], out[order], used[out] < rank, first, last)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.results[at]


def merge_counts(words: list[bytes], table: MergeTable) -> np.ndarray:
    """The number of symbols that each pre-token (its bytes) ends with."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.zeros(len(words), np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    sym = table.first[flat]
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)[sizes > 0] - 1
    sym[ends] = table.last[flat[ends]]
    while len(sym):
        rank = np.full(len(sym), NO_RANK)
        same = owner[1:] == owner[:-1]
        found, made = table.look_up(sym[:-1], sym[1:])
        rank[:-1] = np.where(same, found, NO_RANK)
        starts = np.flatnonzero(np.r_[True, ~same])
        best = np.minimum.reduceat(rank, starts)
        length = np.diff(np.r_[starts, len(sym)])
        done = best == NO_RANK
        if done.any():
            counts[owner[starts[done]]] = length[done]
        best = np.repeat(best, length)
        take = (rank == best) & (best != NO_RANK)
        # overlapping places (a pair of one symbol twice) go from the left: every second one of a run
        at = np.flatnonzero(take)
        if len(at):
            run = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            lone = table.lone[rank[at]]
            if lone.any():
                leftmost = np.r_[True, owner[at][1:] != owner[at][:-1]]
                at = at[leftmost | ~lone]
            sym[at] = made[at]
        keep = best != NO_RANK  # finished sequences leave
        keep[at + 1] = False
        sym, owner = sym[keep], owner[keep]
    return counts


class Counter:
    """Counts tokens of words (runs without ASCII white space) for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.table = MergeTable.of(spec["model"])
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.seen: dict[bytes, int] = {b"": 0}

    def pre_tokens(self, word: str) -> list[bytes]:
        if _PLAIN.fullmatch(word):
            return [word.lower().encode()]
        pieces = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(word)) if word else []
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in pieces]

    def learn(self, words: set[bytes]) -> None:
        if len(self.seen) + len(words) > CACHE_WORDS:
            self.seen = {b"": 0}
        new = [w for w in words if w not in self.seen]
        for k in range(0, len(new), MERGE_WORDS):
            part, flat, owner, extra = new[k:k + MERGE_WORDS], [], [], []
            for i, w in enumerate(part):
                text = w.decode("utf-8", "replace")
                pieces = self.special.split(text) if "<" in text else [text]
                extra.append(len(pieces) - 1)  # a special string counts as its own id
                got = [t for p in pieces for t in self.pre_tokens(p)]
                flat += got
                owner += [i] * len(got)
            total = np.bincount(np.array(owner, np.int64), merge_counts(flat, self.table), len(part)).astype(np.int64) + np.array(extra, np.int64)
            self.seen.update(zip(part, total.tolist(), strict=True))

    def count(self, texts: list[bytes]) -> list[int]:
        out: list[int] = []
        for group in by_size(texts, GROUP_BYTES):  # whose new words are merged together
            split = [t.split() for t in group]
            self.learn(set().union(*split))
            out += [sum(map(self.seen.__getitem__, words)) for words in split]
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row (see the module text)."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = text_bytes(batch["text"])
        n = counter(path).count(texts)
        return {"doc_id": batch["doc_id"], "n_bytes": [len(t) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    schema = fields(doc_id=kind_of(df, id_col), n_bytes=LongType(), n_tokens=LongType(), over_limit=BooleanType())
    return map_rows(pick(df, doc_id=id_col, text=text_col), run, schema)
