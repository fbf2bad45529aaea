"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, packing.

Each stage works on all that the one before has kept. The first four return documents, the last one packed pieces.
What goes: documents that the rules reject; all but the smallest doc_id of each group of near duplicates (five-word
shingles, similarity 0.8 or more); passages of PASSAGE words or more that repeat, in all places (a document of which
nothing is left goes, too); documents that hold a benchmark item. A document with null text fails the rules.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontaminate, minhash_dedup, packing, quality_crf, suffix_dedup
from factloom.llm.common import bounded, shared_dir, table

#: Words of a repeated passage: more than 50.
PASSAGE = 51


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = bounded(docs)
    weights, stay = quality_crf.fit(docs, table(spark, sf_dir, "labels"))
    return quality_crf.judge(docs, weights, stay, keep_rows=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = bounded(docs)
    return minhash_dedup.representatives(docs, k=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = bounded(docs)
    return suffix_dedup.without_passages(docs, words=PASSAGE)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = bounded(docs)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(bounded(docs), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packed", packed),
]

#: The decoding, the suffix order and the tokenizer can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{at}/{k}-{name}")
            docs = spark.read.parquet(f"{at}/{k}-{name}")
    return docs
