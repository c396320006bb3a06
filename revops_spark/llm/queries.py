"""The registered queries of this subpackage: `opN_<name>` and `pipeline`.

Each reads its whole table and runs its operator with production parameters;
the operator modules hold the logic.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontamination, fingerprints, licenses, lm_scoring, nearest, oracle, packing, quality,
               simhash_dedup, spelling, substring_dedup, suffix_dedup, token_rollup)
from ._shared import shared_dir, stored, table

#: numeric metadata the quality classifier sees besides the text
QUALITY_META = ("n_chars",)


def tokenizer_paths() -> tuple[str, str, str]:
    """Vocabulary, the same vocabulary as ranks, and its split pattern."""
    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_paths())


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = stored(lm_scoring.coded(docs), "codes")       # split once
    return lm_scoring.score(docs, lm_scoring.fit(docs, words=words), words=words)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, one row per benchmark item they hold."""
    return decontamination.pairs(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark")).drop("bits")


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: counts under two tokenizers
    are inserted, every word count is revised (letters and digits alone instead
    of white-space words), exact copies are deleted, and that batch is sent again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    rollup = token_rollup.Rollup(spark, f"{shared_dir(spark)}/{uuid.uuid4().hex}/rollup")
    about = ["doc_id", "source", "lang"]
    words, pieces = F.lit("words-1").alias("tokenizer_version"), F.lit("byte_bpe_50k")

    def counted(pattern: str) -> DataFrame:
        return docs.select(*about, words, token_rollup.word_count(F.col("text"), pattern)
                           .alias("n_tokens"))

    rollup.commit("insert", counted(r"[^ \t\n\x0B\f\r]+").unionByName(
        token_rollup.bpe_counts(docs, tokenizer_paths()).withColumn("tokenizer_version", pieces)))
    rollup.commit("revise", counted(r"[\p{L}\p{N}]+"))
    gone = token_rollup.copies(docs).select(
        "doc_id", F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("lang"),
        F.explode(F.array(F.lit("words-1"), pieces)).alias("tokenizer_version"),
        F.lit(None).cast("long").alias("n_tokens"))
    rollup.commit("copies", gone)
    rollup.commit("copies", gone)
    return rollup.totals()


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), meta_cols=QUALITY_META)
    return quality.score(docs, model, meta_cols=QUALITY_META)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"), with_text=False)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_token_rollup": op6_token_rollup,
    "op7_quality": op7_quality,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_nearest": op9_nearest,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_fingerprints": op12_fingerprints,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = dict(oracle.ORACLE_SQL)
