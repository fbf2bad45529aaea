"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_repair, chat_windows, decontaminate, hilbert_sharding, langid, minhash_dedup, oracles, packing, quality_crf, spelling_variants, suffix_dedup, token_automaton, url_automaton, warc_segments
from .common import bounded, shared_dir, table


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_sharding.shard(table(spark, sf_dir, "documents"), n_shards=8)


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded(table(spark, sf_dir, "documents"))
    weights, stay = quality_crf.fit(docs, table(spark, sf_dir, "labels"))
    return quality_crf.judge(docs, weights, stay)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(bounded(table(spark, sf_dir, "documents")))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat_windows.digests(chat_windows.windows(chats.unionByName(extra)))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.dedup(bounded(table(spark, sf_dir, "documents")), k=4, percent=80)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(bounded(table(spark, sf_dir, "documents")), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(bounded(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc_segments.write_archives(bounded(table(spark, sf_dir, "pages")), path, min_revisit=0)
    return warc_segments.summary(warc_segments.reassembled(warc_segments.read_records(spark, path)))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded(table(spark, sf_dir, "documents"))
    return langid.predict(docs, langid.fit(docs))


def op10_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_automaton.judge(table(spark, sf_dir, "pages"))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(chat_repair.damaged(bounded(table(spark, sf_dir, "conversations"))))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op13_token_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_automaton.count(bounded(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (op1_hilbert_sharding, op2_quality_crf, op3_suffix_dedup, op4_chat_windows, op5_minhash_dedup, op6_packing, op7_decontaminate, op8_warc_segments, op9_langid, op10_url_automaton, op11_chat_repair, op12_spelling_variants, op13_token_automaton)}

SQL: dict[str, str] = {"op3_suffix_dedup": oracles.repeats(suffix_dedup.LENGTH, suffix_dedup.SHARED), "op8_warc_segments": oracles.archives(), "op4_chat_windows": oracles.chats(), "op5_minhash_dedup": oracles.near_duplicates(4, 80), "op10_url_automaton": oracles.urls(), "op11_chat_repair": oracles.repairs(), "op12_spelling_variants": oracles.spellings()}
