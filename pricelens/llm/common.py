"""Shared helpers: Arrow batches, word splitting, staging in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pricelens.session import scratch_dir

PART_BYTES = 8_000_000  # of an Arrow batch that is worked on at a time


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def by_size(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    """Consecutive texts in lists of about ``size`` bytes."""
    group, held = [], 0
    for t in texts:
        group.append(t)
        held += len(t)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def kind_of(df: DataFrame, column: str):
    return df.select(F.col(f"`{column}`")).schema[0].dataType


def fields(**types) -> StructType:
    return StructType([StructField(n, t) for n, t in types.items()])


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about PART_BYTES, a row at least."""
    n = max(1, int(batch.num_rows * PART_BYTES / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, n):
        yield batch.slice(at, n)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: StructType) -> DataFrame:
    """One output batch (a dict of column lists or arrays) for each part of an input batch."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c := out[f.name], pa.Array) else pa.array(c, f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, mask: Callable[[list[bytes]], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text the mask keeps."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(mask(text_bytes(part.column(at))), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """96 bits that tell rows apart by id and text (never null): k1, k2."""
    parts = [F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(f"`{text_col}`").isNull(), F.col(f"`{text_col}`")]
    return [F.xxhash64(*parts).alias("k1"), F.hash(*parts).alias("k2")]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage
    and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def rolling(x: np.ndarray, size: int, base: int) -> np.ndarray:
    """A polynomial fingerprint (mod 2^64) of every window of ``size`` values."""
    n = len(x) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    b, acc = np.uint64(base), x[:n].copy()
    for k in range(1, size):
        acc *= b
        acc += x[k:k + n]
    return acc


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that their order is arbitrary."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))
