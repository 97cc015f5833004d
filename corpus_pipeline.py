"""From documents to packed training sequences: quality rules, near-duplicate join, repeated passages, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result in the shared folder and
reads it again as the next stage's docs. All but the last stage return the columns of documents. Empty and null texts
go at the first stage; the others take whatever they are given (see the operators for nulls, ties and repeated rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelweave.llm import chunk_dedup, jaccard_join, packing, pii, quality_rules
from pixelweave.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_dedup.remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("jaccard_join", near_duplicates), ("chunk_dedup", repeated_passages), ("pii", personal_data), ("packing", pack)]

#: SQL can't express the tokenizer and the packing; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
