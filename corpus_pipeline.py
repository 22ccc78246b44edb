"""The corpus pipeline: STAGES applied to ``documents`` one after another,
each on what its predecessor wrote.

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_duplicates``: of documents linked by similar shingle sets, directly
   or over others, that with the smallest id stays.
3. ``decontamination``: documents that hold a window of a benchmark item go.
4. ``personal_data``: found spans are replaced by their kind.
5. ``tokens``: texts are encoded; the ids and their number are added, and the
   text is what the ids decode to.

Columns ``n_tokens`` and ``ids`` of the input are replaced by the last stage;
others are kept, whatever their names.  Repeated rows are scored and judged
alike; of rows with one id, which are versions of one document, all stay or go.
Texts of any length are read whole.  Null texts are scored as empty, link with nothing, hold no window and no
personal data, and have no ids (they come out of the last stage as empty).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeledger.llm import bpe, decontam, jaccard, pii, quality
from lakeledger.llm.util import prepare, shared_path, table

#: Entries of an encoder's tables: workers have other operators' memory beside.
KEPT = 50_000
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, machine)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, RANKS, PATTERN, kept=KEPT)


STAGES = [("quality", good), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]

#: The classifier, the bootstrapping and the encoder have no SQL; tests/llm
#: compares run() with a plain version on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(prepare(spark), docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
