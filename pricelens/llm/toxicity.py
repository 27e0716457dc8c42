"""Toxicity: a counterfactual-regularised linear classifier.

Features are the 5-letter runs of a document's words (word ends marked,
hashed), so inflected forms share them: whether a run is there, and how often,
as the share of words that hold it (from ``LOW_SHARE`` up to ``FULL_SHARE``; a
rare stem that a clean text has in passing is frequent in a toxic one).  Length dilutes neither.

Every sampled document gets a counterfactual: one with identity terms against
itself with these terms swapped for others of their groups; one without any,
with a term of a group put in against the same with another term of that group
put in.  Beside the logistic loss the fit penalises the squared change of the
score between the two, so that neutral mentions of a group don't become
evidence.  Weights are evidence for toxicity only (none is negative), so a
long clean text cannot outweigh an insult in it, and a soft threshold (L1)
leaves only features that carry weight.

Fitted on a bounded sample of labelled rows outside the held-out fold
(``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``; feature ids only come to the driver).
Null and empty texts get the score of no evidence.  Without both labels every
score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DoubleType, IntegerType

from pricelens.llm.common import fields, kind_of, map_rows, text_bytes
from pricelens.llm.labelled import Adam, Sparse, bounded, labelled_texts, sigmoid

SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 3_500
FOLDS = 5
RUN = 5
WIDTH = 1 << 20
CACHE_WORDS = 300_000
LOW_SHARE, FULL_SHARE, LEVELS = 0.004, 0.02, 16  # shares between the first two, in steps
FALSE_ALARM = 5.0

# Identity terms by group; a term is swapped for the next of its group.
IDENTITY_TERMS = {
    "gender": ["women", "men", "girls", "boys"],
    "person": ["woman", "man"],
    "faith": ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    "faiths": ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    "origin": ["african", "asian", "european", "american", "mexican", "chinese", "indian", "arab"],
    "colour": ["black", "white", "brown"],
    "orientation": ["gay", "straight", "lesbian", "bisexual"],
    "age": ["old", "young"],
    "ability": ["deaf", "blind", "disabled"],
    "fr_gender": ["femmes", "hommes", "filles", "garçons"],
    "fr_faith": ["musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"],
    "fr_origin": ["africains", "asiatiques", "européens", "américains", "chinois", "indiens", "arabes"],
    "de_gender": ["frauen", "männer", "mädchen", "jungen"],
    "de_faith": ["muslime", "christen", "juden", "buddhisten", "atheisten"],
    "de_origin": ["afrikaner", "asiaten", "europäer", "amerikaner", "chinesen", "inder", "araber"],
    "es_gender": ["mujeres", "hombres", "chicas", "chicos"],
    "es_faith": ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"],
    "es_origin": ["africanos", "asiáticos", "europeos", "americanos", "chinos", "indios", "árabes"],
}

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter[str]:
    return Counter(_WORD.findall(text.lower()))


@lru_cache(CACHE_WORDS)
def runs_of(word: str, run: int = RUN) -> tuple[int, ...]:
    """Hashed columns of a word, each once."""
    marked = f"^{word}$"
    return tuple(dict.fromkeys(zlib.crc32(marked[k:k + run].encode()) % WIDTH for k in range(max(1, len(marked) - run + 1))))


def level(n: int, words: int) -> int:
    """A run's share of the words, in steps; 0 for what any text may have in passing."""
    return max(0, min(LEVELS, round((n / words - LOW_SHARE) / (FULL_SHARE - LOW_SHARE) * LEVELS)))


def levels(n: np.ndarray, words: int) -> np.ndarray:
    """level() of many runs of one text."""
    return np.clip(np.rint((n / max(1, words) - LOW_SHARE) / (FULL_SHARE - LOW_SHARE) * LEVELS), 0, LEVELS).astype(np.int8)


def features(held: Counter[int], words: int) -> tuple[np.ndarray, np.ndarray]:
    """A text's runs, ascending, and the level of each."""
    runs = np.fromiter(held.keys(), np.int32, len(held))
    order = np.argsort(runs)
    return runs[order], levels(np.fromiter(held.values(), np.int64, len(held))[order], words)


def held_by(words: dict[str, int], runs=runs_of) -> Counter[int]:
    """How many words hold each run."""
    held = Counter()
    for w, n in words.items():
        for c in runs(w):
            held[c] += n
    return held


def swaps(groups: dict[str, list[str]]) -> dict[str, str]:
    return {t: g[(i + 1) % len(g)] for g in groups.values() for i, t in enumerate(g)}


def counterfactual(words: Counter[str], held: Counter[int], groups: dict[str, list[str]], other_of: dict[str, str]) -> dict[int, float]:
    """What changes between a text and its counterfactual, as weights' factors
    by column.  The term put into a text without any goes round the groups by
    the text's words, so it is the same at every run."""
    found, size, put = [(w, n) for w, n in words.items() if w in other_of], words.total(), Counter()
    if not found:
        terms = [t for g in groups.values() if len(g) > 1 for t in g]
        if not terms:
            return {}
        found, size = [(terms[zlib.crc32(" ".join(sorted(words)).encode()) % len(terms)], 1)], size + 1
        put = held_by(Counter(dict(found)))
    moved = Counter()
    for w, n in found:
        moved.subtract(held_by(Counter({w: n})))
        moved.update(held_by(Counter({other_of[w]: n})))
    change = {}
    for c, d in sorted(moved.items()):
        before = held[c] + put[c]
        change[c] = float(before > 0) - float(before + d > 0)
        change[c + WIDTH] = (level(before, size) - level(before + d, size)) / LEVELS
    return {c: v for c, v in change.items() if v}


@dataclass
class Linear:
    bias: float
    weight: dict[int, float]  # by column; the rest are zero; a run's share is WIDTH after its presence
    seen: set[str] = field(default_factory=set)
    told: dict[str, tuple[int, ...]] = field(default_factory=dict)  # those of the seen words that hold a weighted run

    def raw(self, text: str) -> float:
        words = words_of(text)
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
            self.told.clear()
        new = set(words).difference(self.seen)
        for w in new:
            if runs := tuple(c for c in runs_of.__wrapped__(w) if c in self.weight or c + WIDTH in self.weight):
                self.told[w] = runs
        self.seen |= new
        size = words.total()
        held = held_by({w: words[w] for w in words.keys() & self.told.keys()}, self.told.__getitem__)
        return self.bias + sum(self.weight.get(c, 0.0) + self.weight.get(c + WIDTH, 0.0) * level(held[c], size) / LEVELS for c in sorted(held))


def descend(x: Sparse, y: np.ndarray, use: np.ndarray, change: Sparse, penalty: float, sparsity: float, steps: int, rate: float) -> np.ndarray:
    """Weights and bias fitted on the rows that ``use`` marks."""
    w, adam, share = np.zeros(x.width), Adam(x.width + 1, rate), np.clip((use * y).sum() / use.sum(), 0.01, 0.99)
    bias = float(np.log(share / (1 - share)))
    for _ in range(steps):
        g = use * (sigmoid(x.dot(w) + bias) - y) / use.sum()
        slope = x.back(g) + 2 * penalty / max(1, change.n) * change.back(change.dot(w))
        move = adam.step(np.concatenate([slope, [g.sum()]]))
        w, bias = w - move[:-1], bias - move[-1]
        w = np.maximum(w - sparsity, 0)
    return np.concatenate([w, [bias]])


def cut_of(s: np.ndarray, y: np.ndarray) -> float:
    """The raw score that parts clean from toxic rows at least cost: a share of
    clean rows above it weighs FALSE_ALARM times a share of toxic ones below;
    the middle of the cheapest gap."""
    order = np.argsort(s, kind="stable")
    s, y = s[order], y[order]
    below = np.concatenate([[0], np.cumsum(y)]) / max(1, y.sum())
    above = 1 - np.concatenate([[0], np.cumsum(1 - y)]) / max(1, (1 - y).sum())
    k = int(np.argmin(below + FALSE_ALARM * above))
    return float(s[0] if k == 0 else s[-1] if k == len(s) else (s[k - 1] + s[k]) / 2)


def fit(x: Sparse, y: np.ndarray, change: Sparse, penalty: float = 1.0, sparsity: float = 1e-3,
        steps: int = 120, rate: float = 0.1, least_documents: int = 3) -> Linear:
    """``change`` holds what each counterfactual changes.  As one
    class is rare, the bias is set so that the score 0.5 lies at the best cut
    of every fifth row, scored by a fit on the others."""
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return Linear(float(np.log(share / (1 - share))), {})
    often = np.flatnonzero(np.bincount(x.index, minlength=2 * WIDTH) >= least_documents)
    x, change = x.narrowed(often), change.narrowed(often)
    how = penalty, sparsity, steps, rate
    whole = descend(x, y, np.ones(len(y)), change, *how)
    w, bias = whole[:-1], whole[-1]
    apart = np.arange(len(y)) % 5 == 0
    if 0 < y[apart].sum() < apart.sum() and 0 < y[~apart].sum():
        inner = descend(x, y, 1.0 - apart, change, *how)
        bias -= cut_of((x.dot(inner[:-1]) + inner[-1])[apart], y[apart])
    kept = np.flatnonzero(w)
    return Linear(float(bias), dict(zip(often[kept].tolist(), w[kept].tolist(), strict=True)))


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as fold 0."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS, F.lit(0))


def train(documents: DataFrame, labels: DataFrame, groups: dict[str, list[str]] | None = None, penalty: float = 1.0,
          sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic") -> Linear:
    groups = IDENTITY_TERMS if groups is None else groups
    other_of = swaps(groups)
    seen = labels.where(fold(label_id) != 0)
    sample = labelled_texts(documents, seen, F.col(f"`{label_col}`"), {0: sample_clean, 1: sample_toxic}, id_col, text_col, label_id)
    schema = fields(doc_id=kind_of(sample, "doc_id"), label=IntegerType(), columns=ArrayType(IntegerType()), levels=ArrayType(ByteType()),
                    changed=ArrayType(IntegerType()), change=ArrayType(DoubleType()))

    def run(batch: pa.RecordBatch) -> dict:
        words = [words_of(t.decode()) for t in text_bytes(batch["text"])]
        held = [held_by(w) for w in words]
        other = [counterfactual(w, h, groups, other_of) for w, h in zip(words, held, strict=True)]
        own = [features(h, w.total()) for w, h in zip(words, held, strict=True)]
        return {"doc_id": batch["doc_id"], "label": batch["label"], "columns": [c for c, _ in own], "levels": [v for _, v in own],
                "changed": [list(o) for o in other], "change": [list(o.values()) for o in other]}

    got = bounded(map_rows(sample, run, schema), sample_toxic + sample_clean, ["doc_id", "columns"])
    x = with_shares(Sparse(got["columns"], got["levels"], 2 * WIDTH))
    return fit(x, got["label"].to_numpy().astype(float), Sparse(got["changed"], got["change"], 2 * WIDTH), penalty)


def with_shares(levels: Sparse) -> Sparse:
    """Presence and share columns from rows of (run, level)."""
    some = levels.value > 0
    out = object.__new__(Sparse)
    out.index = np.concatenate([levels.index, levels.index[some] + WIDTH])
    out.row = np.concatenate([levels.row, levels.row[some]])
    out.value = np.concatenate([np.ones(len(levels.value)), levels.value[some] / LEVELS])
    out.n, out.width = levels.n, levels.width
    return out


def score(df: DataFrame, model: Linear, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        p = sigmoid(np.array([model.raw(t.decode()) for t in text_bytes(batch["text"])]))
        return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": p, "predicted": (p >= 0.5).astype(np.int32)}

    schema = fields(doc_id=kind_of(df, id_col), held_out=BooleanType(), score=DoubleType(), predicted=IntegerType())
    held = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), (fold(id_col) == 0).alias("held_out"))
    return map_rows(held, run, schema)
