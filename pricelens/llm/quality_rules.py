"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``;
only the statistics come to the driver) with monotonic constraints: more
symbols, repeated lines, repeated words, exclamation marks or doubled words
never raise a document's quality.  All trees are flattened into node arrays
and walked together, level by level, for a whole batch.

Null text: no words.  Documents of fewer than ``MIN_WORDS`` words or with more
than ``REPEAT_PERCENT`` % of their words in repeated windows fail the base
rules, empty ones too.  Without labels of both classes the trees keep all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType

from pricelens.llm.common import fields, kind_of, map_rows, pick, rolling, text_bytes, word_hashes
from pricelens.llm.labelled import bounded, labelled_texts, sigmoid

SAMPLE_ROWS = 10_000  # of each class
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
BASE = 0x9E3779B97F4A7C15

# statistic: direction in which quality may move as it grows (0: any)
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "upper": 0, "letters": 0,
            "distinct": 0, "exclaims": -1, "doubled": -1, "lines": 0}

_SYMBOLS, _SPACE, _EXCLAIM, _INNER = b"#*$%&|<>", b" \t\n\r\x0b\x0c", b"!", bytes(range(0x80, 0xC0))
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def number_of(text: bytes, wanted: bytes) -> int:
    return len(text) - len(text.translate(None, wanted))


def repeat_words(x: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more (x: word hashes)."""
    g = rolling(x, window, BASE)
    if len(g) < 2:
        return 0
    _, back, n = np.unique(g, return_inverse=True, return_counts=True)
    if len(n) == len(g):
        return 0
    edge = np.zeros(len(x) + 1, np.int64)
    at = np.flatnonzero(n[back] > 1)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The contract's counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the trees' features."""
    words = text.split()
    n = len(words)
    chars = len(text) - number_of(text, _INNER)
    in_words = chars - number_of(text, _SPACE)
    symbols = number_of(text, _SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    x = word_hashes(words)
    repeats = repeat_words(x)
    upper, lower = number_of(text, _UPPER), number_of(text, _LOWER)
    share = lambda a, b: a / b if b else 0.0
    features = [float(np.log1p(n)), share(in_words, n), share(symbols, n), share(dup, len(lines)), share(repeats, n), share(upper, upper + lower),
                share(upper + lower, in_words), share(len(set(words)), n), share(number_of(text, _EXCLAIM), n),
                share(int((x[1:] == x[:-1]).sum()) if n > 1 else 0, n), share(len(lines), n)]
    return [n, in_words, symbols, dup, repeats], features


@dataclass
class Trees:
    """Node arrays of all trees, one row each; a leaf points to itself."""

    start: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    left: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    depth: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of features."""
        if not len(self.feature):
            return np.full(len(x), sigmoid(self.start))
        tree = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[tree, at]] <= self.cut[tree, at], self.left[tree, at], self.right[tree, at])
        return sigmoid(self.start + self.value[tree, at].sum(axis=1))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 20) -> Trees:
    """Newton boosting of the logistic loss on quantile bins.  A constrained
    split is taken only if its two values lie in the allowed order, and each
    side's later values stay on its side of their middle."""
    share = np.clip(y.mean() if len(y) else 1.0, 0.01, 0.99)
    model = Trees(float(np.log(share / (1 - share))), depth=depth)
    if len(set(y.tolist())) < 2:
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    size, total, grown = 2 ** (depth + 1) - 1, np.full(len(y), model.start), []
    for _ in range(trees):
        p = sigmoid(total)
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(size, np.int64), np.zeros(size)
        left, right, value = np.arange(size), np.arange(size), np.zeros(size)
        todo, step = [(0, np.arange(len(y)), -np.inf, np.inf, 0)], np.zeros(len(y))
        while todo:
            node, rows, low, high, level = todo.pop()
            best = best_split(binned[rows], g[rows], h[rows], edges, monotone, low, high, ridge, least) if level < depth else None
            if best is None:
                value[node] = rate * np.clip(g[rows].sum() / (h[rows].sum() + ridge), low, high)
                step[rows] = value[node]
                continue
            f, b, mid = best
            feature[node], cut[node], left[node], right[node] = f, edges[f][b], 2 * node + 1, 2 * node + 2
            below = binned[rows, f] <= b
            sides = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[monotone[f]]
            for child, part, (lo, hi) in ((2 * node + 1, rows[below], sides[0]), (2 * node + 2, rows[~below], sides[1])):
                todo.append((child, part, lo, hi, level + 1))
        total += step
        grown.append((feature, cut, left, right, value))
    model.feature, model.cut, model.left, model.right, model.value = (np.stack(c) for c in zip(*grown, strict=True))
    return model


def best_split(binned, g, h, edges, monotone, low, high, ridge, least):
    """(feature, bin, middle of the two values) of the largest allowed gain, or None."""
    best, G, H = (1e-6, None), g.sum(), h.sum()
    whole = G * G / (H + ridge)
    for f, e in enumerate(edges):
        if not len(e):
            continue
        n = len(e) + 1
        gl = np.cumsum(np.bincount(binned[:, f], g, n))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], h, n))[:-1]
        cl = np.cumsum(np.bincount(binned[:, f], minlength=n))[:-1]
        vl, vr = np.clip(gl / (hl + ridge), low, high), np.clip((G - gl) / (H - hl + ridge), low, high)
        gain = gl * gl / (hl + ridge) + (G - gl) ** 2 / (H - hl + ridge) - whole
        ok = (cl >= least) & (len(g) - cl >= least) & (monotone[f] * (vr - vl) >= 0)
        gain = np.where(ok, gain, -np.inf)
        b = int(np.argmax(gain))
        if gain[b] > best[0]:
            best = gain[b], (f, b, (vl[b] + vr[b]) / 2)
    return best[1]


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality") -> Trees:
    sample = labelled_texts(documents, labels, F.col(f"`{label_col}`"), {0: sample_rows, 1: sample_rows}, id_col, text_col, label_id)
    schema = fields(doc_id=kind_of(sample, "doc_id"), label=IntegerType(), **{n: DoubleType() for n in FEATURES})

    def run(batch: pa.RecordBatch) -> dict:
        rows = [statistics(t)[1] for t in text_bytes(batch["text"])]
        return {"doc_id": batch["doc_id"], "label": batch["label"], **dict(zip(FEATURES, zip(*rows, strict=True), strict=True))}

    got = bounded(map_rows(sample, run, schema), 2 * sample_rows, ["doc_id", *FEATURES])
    x = np.stack([got[n].to_numpy() for n in FEATURES], axis=1) if len(got) else np.zeros((0, len(FEATURES)))
    return fit(x, got["label"].to_numpy().astype(float), list(FEATURES.values()))


def judge(df: DataFrame, model: Trees, at_least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the five counts, base_failed, kept and the trees' score of every row."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batch: pa.RecordBatch) -> dict:
        both = [statistics(t) for t in text_bytes(batch["text"])]
        table = np.array([c for c, _ in both])
        score = model.score(np.array([f for _, f in both]))
        failed = (table[:, 0] < MIN_WORDS) | (100 * table[:, 4] > REPEAT_PERCENT * table[:, 0])
        return {"doc_id": batch["doc_id"], **dict(zip(counts, table.T, strict=True)), "base_failed": failed, "kept": ~failed & (score >= at_least), "score": score}

    schema = fields(doc_id=kind_of(df, id_col), **{c: LongType() for c in counts}, base_failed=BooleanType(), kept=BooleanType(), score=DoubleType())
    return map_rows(pick(df, doc_id=id_col, text=text_col), run, schema)
