"""Whole plans: extraction for a list of entities, an ad-hoc question, and the report on records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import extraction as X
from ..operators import metrics as M
from ..operators import retrieval as R
from ..operators import vectors as W


def ranked_hits(queries: DataFrame, chunks: DataFrame, k: int, embed=W.hashed_embedding) -> DataFrame:
    """The k best chunks of each query (query_id, text): chunks hold bank, stem, chunk_id, text, embedding."""
    asked = queries.select("query_id", embed(F.col("text")).alias("query"))
    known = chunks.withColumn("vec_id", F.struct("bank", "stem", "chunk_id"))
    return W.top_k(asked, known, k, "vec_id", 9).drop("vec_id")


def extract(banks: list[str] | DataFrame, chunks: DataFrame, year: int, model=None, embed=W.hashed_embedding, first_k: int = 200, most_k: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(nested records, flat metric rows) of the banks, a list or a table (target) without repeats: pooled retrieval, patterns, model for what they leave, computed ratios."""
    spark = chunks.sparkSession
    parameters = R.wants(spark)
    targets = banks.select("target") if isinstance(banks, DataFrame) else spark.createDataFrame([(b,) for b in banks], "target string")
    queries = R.metric_queries(spark, targets, year)
    pool_queries = queries.where("place = 0")
    asked = pool_queries.join(F.broadcast(parameters.select("metric", "pool")), "metric").select("query_id", "target", "metric", "pool", embed(F.col("text")).alias("query"))
    known = chunks.withColumn("vec_id", F.struct("bank", "stem", "chunk_id"))
    # which banks a target's name goes with is found on the names alone
    named = R.entity_pairs(known.select("bank").distinct(), targets.distinct(), "bank", "target").join(asked.select("query_id", "target"), "target").select("bank", "query_id")
    own = W.adaptive_top_k(asked, known, named, F.col("pool"), first_k, most_k, "vec_id", 9).drop("vec_id", "pool")
    arrival = F.array_position(F.array(*[F.lit(m) for m in X.V.METRICS]), F.col("metric")).cast("int")
    pool = R.pooled(own.withColumn("arrival", arrival), chunks, year)
    contexts = R.context(pool, ["target"])
    found = X.extracted(contexts, "target", year).withColumn("error", F.lit(None).cast("string"))
    if model is not None:
        hits = ranked_hits(queries, chunks, 60, embed).join(queries.select("query_id", "target", "metric", "place"), "query_id")
        shown = R.evidence(R.per_metric(hits, chunks, parameters), parameters)
        prefilled = found.where("origin = 'regex'").select("target", F.col("metric_name").alias("metric"))
        open_ = R.context(shown.where("metric <> 'NII'"), ["target", "metric"]).join(prefilled, ["target", "metric"], "left_anti")
        found = found.unionByName(X.asked_of_model(open_, model, year))
    merged = X.merged(targets, found, "target", year)
    records = M.as_records(merged, "target", M.evidence_count(pool).withColumnRenamed("n_evidence", "topk"))
    return records, M.flat(records)


def answer_context(question: str, chunks: DataFrame, embed=W.hashed_embedding, k: int = 50, most: int = 20) -> DataFrame:
    """The context for one question: its best chunks, of the best one's bank."""
    asked = chunks.sparkSession.createDataFrame([("q", question)], "query_id string, text string")
    hits = R.bank_of_best(ranked_hits(asked, chunks, k, embed), "query_id", most)
    return R.context(hits, ["query_id"])


def report(records: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    """(diagnostics, counters) of records."""
    rows = M.diagnosed(records, year)
    return rows, M.counters(rows)
