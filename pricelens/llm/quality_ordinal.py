"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w . x - threshold_k): one weight vector over hashed text
for all grades, thresholds in order.  x holds the shares of a document's words
that have a given hashed form (the word in lower case; its shape, with runs of
letters, digits and other characters; whether it doubles the word before), so
a document's score is a mean over its words and each word's value is computed
once.  Results: expected grade and the tail probability of a wanted grade,
which selects.

Fitted on a bounded sample (``SAMPLE_ROWS`` of each grade; sparse shares come
to the driver).  Null and empty texts have the score 0, and are judged by the
thresholds alone.  Without two grades every document gets the only grade (the
highest if there are no labels).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType

from pricelens.llm.common import fields, keep_rows, kind_of, map_rows, pick, text_bytes
from pricelens.llm.labelled import Adam, Sparse, bounded, labelled_texts, sigmoid

SAMPLE_ROWS = 2_500  # of each grade
WORDS, SHAPES = 1 << 15, 1 << 12  # hashed columns
DOUBLED = WORDS + SHAPES
WIDTH = DOUBLED + 1
SCALE = 20.0
CACHE_WORDS = 300_000

_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def columns(word: bytes) -> tuple[int, int]:
    shape = _RUN.sub(rb"\1", word.translate(_SHAPE))
    return zlib.crc32(word.lower()) % WORDS, WORDS + zlib.crc32(shape) % SHAPES


def shares(text: bytes) -> tuple[list[int], list[float]]:
    """Sparse x of a document."""
    words = text.split()
    total: Counter = Counter()
    for w, n in Counter(words).items():
        for c in columns(w):
            total[c] += n
    total[DOUBLED] = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return list(total), [SCALE * n / max(1, len(words)) for n in total.values()]


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray  # one less than the grades
    seen: dict[bytes, float] = field(default_factory=dict)

    def raw(self, text: bytes) -> float:
        words = text.split()
        if not words:
            return 0.0
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        distinct = set(words)
        for w in distinct.difference(self.seen):
            a, b = columns(w)
            self.seen[w] = float(self.weights[a] + self.weights[b])
        doubled = sum(map(bytes.__eq__, words, words[1:]))
        return SCALE * (sum(map(self.seen.__getitem__, words)) + doubled * float(self.weights[DOUBLED])) / len(words)

    def tails(self, raw: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return sigmoid(raw[:, None] - self.thresholds[None, :])


def fit(x: Sparse, y: np.ndarray, grades: int, steps: int = 200, rate: float = 0.05, ridge: float = 1e-4) -> Ordinal:
    present = np.unique(y)
    if len(present) < 2:  # no order to learn: every grade below the only one is passed
        only = int(present[0]) if len(present) else grades - 1
        return Ordinal(np.zeros(WIDTH), np.where(np.arange(grades - 1) < only, -50.0, 50.0))
    weight = np.bincount(y, minlength=grades)
    # share of documents above each threshold, as the start
    above = np.clip(1 - np.cumsum(weight)[:-1] / len(y), 0.01, 0.99)
    start = np.maximum.accumulate(-np.log(above / (1 - above)))
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])  # first threshold, logs of the gaps
    w, adam = np.zeros(x.width), Adam(x.width + len(theta), rate)
    low, high = y - 1, y
    for _ in range(steps):
        cut = theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])
        wide = np.concatenate([cut, [np.inf]])
        s = x.dot(w)
        # P(y) = sigmoid(cut_y - s) - sigmoid(cut_(y-1) - s), with the ends at 1 and 0
        up = np.where(high < grades - 1, sigmoid(wide[high] - s), 1.0)
        down = np.where(low >= 0, sigmoid(wide[np.maximum(low, 0)] - s), 0.0)
        p = np.maximum(up - down, 1e-9)
        du, dd = up * (1 - up) / p, down * (1 - down) / p
        by_score = (du - dd) / len(y)  # of -log P
        by_cut = (np.bincount(np.maximum(low, 0), np.where(low >= 0, dd, 0), grades) - np.bincount(high, np.where(high < grades - 1, du, 0), grades))[:grades - 1] / len(y)
        by_theta = np.concatenate([[by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(theta[1:])])
        move = adam.step(np.concatenate([x.back(by_score) + ridge * w, by_theta]))
        w, theta = w - move[:x.width], theta - move[x.width:]
    return Ordinal(w, theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))]))


def train(documents: DataFrame, labels: DataFrame, grade: Column, grades: int, sample_rows: int = SAMPLE_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> Ordinal:
    """``grade``: 0 to grades - 1, over the columns of ``labels``."""
    sample = labelled_texts(documents, labels, grade, dict.fromkeys(range(grades), sample_rows), id_col, text_col, label_id)
    schema = fields(doc_id=kind_of(sample, "doc_id"), label=IntegerType(), column=ArrayType(IntegerType()), share=ArrayType(FloatType()))

    def run(batch: pa.RecordBatch) -> dict:
        rows = [shares(t) for t in text_bytes(batch["text"])]
        return {"doc_id": batch["doc_id"], "label": batch["label"], "column": [c for c, _ in rows], "share": [v for _, v in rows]}

    got = bounded(map_rows(sample, run, schema), grades * sample_rows, ["doc_id", "share"])
    return fit(Sparse(got["column"], got["share"], WIDTH), got["label"].to_numpy().astype(np.int64), grades)


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Ratings in the labels table: 0 poor, 1 good but toxic, 2 good."""
    return F.when(F.col(quality) == 0, 0).when(F.col(quality) == 1, F.when(F.coalesce(F.col(toxic), F.lit(0)) == 1, 1).otherwise(2))


def score_batch(model: Ordinal, texts: list[bytes], wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, P(grade >= wanted)) of each text."""
    tails = model.tails(np.array([model.raw(t) for t in texts]))
    return tails.sum(axis=1), tails[:, wanted - 1]


def score(df: DataFrame, model: Ordinal, wanted: int = 1, at_least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, tail (P(grade >= wanted)) and kept of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        expected, tail = score_batch(model, text_bytes(batch["text"]), wanted)
        return {"doc_id": batch["doc_id"], "expected_grade": expected, "tail": tail, "kept": tail >= at_least}

    schema = fields(doc_id=kind_of(df, id_col), expected_grade=DoubleType(), tail=DoubleType(), kept=BooleanType())
    return map_rows(pick(df, doc_id=id_col, text=text_col), run, schema)


def keep(df: DataFrame, model: Ordinal, wanted: int = 1, at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, that score() keeps."""
    return keep_rows(df, lambda texts: score_batch(model, texts, wanted)[1] >= at_least, text_col)
