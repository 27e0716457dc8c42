"""Bounded samples of labelled rows for fitting, and sparse rows for the fits."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import pick


def labelled_texts(documents: DataFrame, labels: DataFrame, label: Column, per_class: dict[int, int],
                   id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """doc_id, text, label of at most ``per_class[c]`` documents of each class:
    those whose ids have the least hashes, so the same at every run.  ``label``
    is over the columns of ``labels``; rows with a null id or label are left
    out, of several labels of one id the least counts.  The list of ids is
    bounded by ``per_class``, so it may be broadcast; the documents are read
    once.  (Rows that repeat an id are bounded by the caller.)"""
    classes = labels.select(F.col(f"`{label_id}`").alias("id"), label.cast("int").alias("label")).dropna().groupBy("id").agg(F.min("label").alias("label"))
    docs = pick(documents, doc_id=id_col, text=text_col)
    least = [classes.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(bound) for c, bound in per_class.items()]
    ids = reduce(DataFrame.union, least)
    return docs.join(F.broadcast(ids), docs["doc_id"] == ids["id"]).select("doc_id", "text", "label")


def bounded(features: DataFrame, bound: int, order: list[str]) -> pa.Table:
    """At most ``bound`` feature rows, as Arrow, in an order that does not
    depend on partitions."""
    return features.orderBy(*[F.xxhash64(c) for c in order], *order).limit(bound).toArrow()


class Sparse:
    """Rows of (index, value) pairs as flat arrays."""

    def __init__(self, index: pa.ChunkedArray, value: pa.ChunkedArray | None, width: int):
        index = index.combine_chunks()
        off = index.offsets.to_numpy()
        self.index = index.values.to_numpy()[off[0]:off[-1]].astype(np.int64)
        self.row = np.repeat(np.arange(len(index)), np.diff(off))
        self.n, self.width = len(index), width
        if value is None:
            self.value = np.ones(len(self.index))
        else:
            value = value.combine_chunks()
            at = value.offsets.to_numpy()
            self.value = value.values.to_numpy()[at[0]:at[-1]].astype(float)

    def narrowed(self, keep: np.ndarray) -> Sparse:
        """Only the columns of ``keep``, renumbered in its order."""
        to = np.full(self.width, -1)
        to[keep] = np.arange(len(keep))
        use = to[self.index] >= 0
        out = object.__new__(Sparse)
        out.index, out.row, out.value, out.n, out.width = to[self.index[use]], self.row[use], self.value[use], self.n, len(keep)
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index] * self.value, self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, g[self.row] * self.value, self.width)


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
