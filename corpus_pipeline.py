"""Corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator of ``voltaic.llm`` on all that the stage before it kept,
and all but the last return the columns of documents:

1. language identification: texts without letters, whose language is less likely than not, or that their language explains
   badly (noise, languages that weren't learned) go;
2. quality: importance resampling towards rows labelled good; documents that aren't sampled go;
3. near-duplicates by SimHash: one document of each component stays;
4. benchmark decontamination: documents in which a benchmark window occurs go;
5. packing: where each piece of each document stands in sequences of 4096 tokens.

Null and empty texts go in the first stage.  Rows that repeat an id are documents each, until near-duplicates are
removed; a null id is an id like others.  Empty tables pass through all stages; further columns stay as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voltaic.llm import decontamination, language, packing, quality, simhash
from voltaic.llm.common import let_workers_import, stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return language.keep_identified(docs, language.fit(docs), least=0.5)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.resample(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return simhash.deduplicate(docs, shingle=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"), n=10)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the stages; tests/llm/test_pipeline.py holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
