"""The corpus pipeline: quality, near duplicates, substrings, benchmark, packing.

Each stage takes the documents its predecessor kept and returns what it keeps;
the last returns packed sequences. `run` writes every stage to the shared
folder and reads it back, so a lost executor costs one stage at most.

Every stage handles nulls, empty and very long texts, repeated rows, empty
tables and further columns as its operator's docstring states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revops_spark.llm import (decontamination, packing, quality, queries, simhash_dedup,
                              substring_dedup)
from revops_spark.llm._shared import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents the quality classifier rejects."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), meta_cols=queries.QUALITY_META)
    return quality.accepted(docs, model, meta_cols=queries.QUALITY_META)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each SimHash component."""
    return simhash_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words and more that a document with a smaller id has."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = substring_dedup.remove_repeats(docs, carry=rest)
    size = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long"))
    kinds = dict(docs.dtypes)
    return cut.select(*[
        F.col("doc_id").cast(kinds[c]).alias(c) if c == "doc_id"
        else F.col("kept_text").alias(c) if c == "text"
        else F.coalesce(size, F.col("rest.n_chars")).cast(kinds[c]).alias(c) if c == "n_chars"
        else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences."""
    return packing.pack(docs, *queries.tokenizer_paths())


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("substrings", cut_repeats), ("benchmark", drop_benchmark), ("packing", pack_sequences)]

#: The stages need trained models, SimHash and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
