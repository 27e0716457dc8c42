"""A training corpus from ``documents``: rejects poor texts, keeps one document
of each near-duplicate group, drops documents with benchmark passages, masks
secrets, and packs what stays into sequences of 4096 tokens.

Each stage takes (spark, docs, sf_dir) and returns the next one's documents;
run() writes them as Parquet in the shared folder and reads them again.

Null texts count as empty, repeated rows are near-duplicates of each other,
and an empty table gives no rows.  Further columns of ``documents`` pass
through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import decontaminate, packing, quality_ordinal, secrets, simhash
from pricelens.llm.common import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: documents of an estimated grade under 1 (poor)."""
    model = quality_ordinal.train(docs, table(spark, sf_dir, "labels"), quality_ordinal.grade_of(), grades=3)
    return quality_ordinal.keep(docs, model, wanted=1, at_least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stays: the document of the least doc_id of each group."""
    return simhash.representatives(docs, shingle=4, distance=4)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: documents in which ten words in a row of a benchmark item occur (or all of a shorter item)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), size=10)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets masked."""
    model = secrets.train(secrets.samples(docs, table(spark, sf_dir, "labels")))
    return secrets.redact(docs, model, length_col="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("contamination", contamination), ("secrets", masked_secrets), ("packing", packed)]

ORACLE_SQL = None  # the classifier, SimHash and the tokenizer are beyond SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
