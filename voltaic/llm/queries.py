"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import (bitpack, codes, decontamination, jaccard, language, lexical, licenses, neighbours, packing, quality, simhash,
               token_counts, toxicity)
from .common import held_out, pick, stage, table
from .sql import ORACLE_SQL  # noqa: F401  DuckDB SQL by query; those that SQL can't express have none


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        capacity=4096, end_id=1)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_before, and after personal data is masked: n_tokens, n_edits, n_chars, n_encoded (characters
    encoded again)."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    # trees are stored, then edited: each pass has one Python function, and so one worker a core
    trees = stage(token_counts.with_trees(table(spark, sf_dir, "documents"), vocabulary), "trees")
    return token_counts.count_edited(trees, token_counts.masks, vocabulary)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0, k=20).found


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs)
    own = language.identify(pick(docs, doc_id="doc_id", text="text"), model)
    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      F.col("predicted.lang").alias("lang_pred"), F.col("predicted.score").alias("score"))


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_weight, key (with Gumbel noise) and whether the document is sampled."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    own = quality.select(docs, model, columns=["doc_id"])
    return own.rows.select(F.col("c0").alias("doc_id"), held_out(F.col("c0")).alias("held_out"), "log_weight", "key",
                           own.selected().alias("selected"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = simhash.components(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return own.select("doc_id", "fingerprint", "component_id")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    own = toxicity.score(pick(docs, doc_id="doc_id", text="text"), model, into="score")
    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bitpack.read_packed(bitpack.write_packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"), size=5, percent=80)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_language_id": op5_language_id,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_simhash": op7_simhash,
    "op8_license_scan": op8_license_scan,
    "op9_toxicity": op9_toxicity,
    "op10_bit_packed_ids": op10_bit_packed_ids,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_codes": op13_vector_codes,
}

