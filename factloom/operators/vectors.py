"""Vectors: exact inner product, top-k, adaptive depth, a stand-in embedding, index tables."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch
from . import products

#: Queries that may be broadcast; more are processed in blocks of this size.
BROADCAST_QUERIES = 1000
#: Pairs of a query and an entity that a block may hand to tasks; with more, the entities' rows are joined.
ENTITIES = 100_000


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """The vector over its length; a zero vector as it is. Bound once, so that neither vector nor length is worked out per element."""
    bound = F.transform(F.array(vector), lambda v: F.struct(v.alias("v"), F.sqrt(dot(v, v)).alias("n")))
    return F.transform(bound, lambda b: F.transform(b["v"], lambda x: F.when(b["n"] > 0, x.cast("double") / b["n"]).otherwise(x).cast("float")))[0]


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """A deterministic stand-in for a model: signed counts of hashed lower-case words, normalised. A model's client has the same form."""
    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        def one(t: str | None):
            h = np.array([zlib.crc32(w.encode()) for w in re.findall(r"\w+", (t or "").lower())], np.int64)
            v = np.bincount(h % dims, np.where(h >> 16 & 1, 1.0, -1.0), dims) if len(h) else np.zeros(dims)
            return (v / (np.linalg.norm(v) or 1)).astype(np.float32)

        return pd.Series([one(t) for t in texts], dtype=object)

    return embed(text)


def blocks(rows: DataFrame, key: str = "query_id", most: int | None = None) -> list[DataFrame]:
    """The rows in parts that may be broadcast: one where they are counted and few, else by the hash of a key."""
    n = -(-rows.count() // (most or BROADCAST_QUERIES))
    return [rows] if n <= 1 else [rows.where(F.pmod(F.xxhash64(key), F.lit(2 * n)) == b) for b in range(2 * n)]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 50, tie: str = "vec_id", digits: int | None = None) -> DataFrame:
    """The k best vectors of each query with their rank; equal scores by id. Scores are matrix products over Arrow batches, and each task sends k rows a query to the one shuffle.

    Vectors of other length than the queries, and null ones, are no hits.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), tie)
    out = None
    for part in blocks(queries, most=max(1, min(BROADCAST_QUERIES, products.KEPT // max(1, k)))):
        top = products.partial_top_k(part, vectors, k, tie, digits)
        out = top if out is None else out.unionByName(top)
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def adaptive_top_k(queries: DataFrame, vectors: DataFrame, entity: Column | DataFrame, want: Column | int, first_k: int = 200, most_k: int = 20_000, tie: str = "vec_id", digits: int | None = None) -> DataFrame:
    """`adaptive_k` without ranking what it doesn't need: the entity's `want` best rows come from its own rows alone, and one pass over all vectors counts what is ahead of each.

    queries: query_id, query and columns that entity and want name. entity: a table of which query_id goes with which values of
    some of the vectors' columns, or a condition, which is worked out pair by pair, so that it is for few rows.
    `want` is at most products.KEPT over the queries of a block.
    """
    if isinstance(entity, DataFrame):
        entity = scratch.written(entity.select("query_id", *(F.col(c).cast(vectors.schema[c].dataType).alias(c) for c in entity.columns if c != "query_id")).distinct(), "entities")
    # each block is written, or one task would hold the sorts and tables of all blocks at once
    parts = [scratch.written(_adaptive_top_k(part, vectors, entity, want, first_k, most_k, tie, digits), "adaptive-ranked") for part in blocks(queries)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _adaptive_top_k(queries: DataFrame, vectors: DataFrame, entity: Column | DataFrame, want: Column | int, first_k: int, most_k: int, tie: str, digits: int | None) -> DataFrame:
    named = entity.join(F.broadcast(queries.select("query_id")), "query_id", "left_semi") if isinstance(entity, DataFrame) else None
    if named is not None and named.count() <= ENTITIES:
        # each task keeps the best of its own rows, so no row stands for a pair and no task gets an entity
        meet, keys = named.toArrow(), [c for c in named.columns if c != "query_id"]
        listed = vectors.sparkSession.createDataFrame(meet.select(keys).group_by(keys).aggregate([]))
        rows = vectors.join(F.broadcast(listed), keys, "left_semi").select(*vectors.columns)
        most = queries.agg(F.max(want if isinstance(want, Column) else F.lit(want))).first()[0]
        pairs = products.partial_top_k(queries, rows, max(1, most or 1), tie, digits, meet).join(F.broadcast(queries.drop("query")), "query_id")
    else:
        if named is not None:
            pairs = vectors.join(named, [c for c in named.columns if c != "query_id"]).join(F.broadcast(queries), "query_id").select(*vectors.columns, *queries.columns)
        else:
            pairs = vectors.join(F.broadcast(queries), entity)
        pairs = pairs.withColumn("score", products.inner(F.col("embedding"), F.col("query"))).drop("embedding", "query")
        pairs = (pairs.withColumn("score", F.round("score", digits)) if digits is not None else pairs).where("score IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), tie))
    own = scratch.written(pairs.withColumn("place", place).where(F.col("place") <= want), "adaptive")
    hits = own.select("query_id", "place", "score", tie)
    if hits.count() > products.KEPT:
        raise ValueError(f"more than {products.KEPT} hits for a block of queries; ask for fewer")
    ahead = products.ahead(queries, hits.toArrow(), vectors, tie, digits).groupBy("query_id", "place").agg(F.sum("ahead").alias("ahead"))
    ranked = own.join(F.broadcast(ahead), ["query_id", "place"]).withColumn("rank", (F.col("ahead") + 1).cast("int")).drop("ahead", "place")
    return adaptive_k(ranked, F.lit(True), want, first_k, most_k)


def adaptive_k(ranked: DataFrame, entity: Column, want: Column | int, first_k: int = 200, most_k: int = 20_000) -> DataFrame:
    """Of all ranked rows (query_id, rank) the first `want` rows of the entity within K, where K doubles from first_k until it holds one.

    In closed form: with r the entity's best rank, K is the least first_k * 2**j that is not under r; K stops at the first value not under most_k.
    """
    own = ranked.where(entity)
    by_query = Window.partitionBy("query_id")
    r = F.min("rank").over(by_query)
    steps = F.greatest(F.lit(0), F.ceil(F.log2(r / first_k)))
    last = first_k
    while last < most_k:
        last *= 2
    depth = F.lit(first_k) * F.pow(F.lit(2), steps)
    out = own.withColumn("_k", depth).where((F.col("rank") <= F.col("_k")) & (F.col("_k") <= last))
    n = F.row_number().over(by_query.orderBy("rank"))
    return out.withColumn("_n", n).where(F.col("_n") <= want).withColumn("k_used", F.col("_k").cast("int")).drop("_k", "_n")


def write_index(chunks: DataFrame, path: str, dims: int) -> None:
    """Chunks with their vectors as one Parquet table; a vector of other length stops it."""
    bad = chunks.where((F.size("embedding") != dims) | F.col("embedding").isNull()).limit(1).count()
    if bad:
        raise ValueError(f"vectors of other length than {dims}")
    chunks.write.mode("overwrite").parquet(path)


def index_shards(vectors: DataFrame, path: str) -> DataFrame:
    """Writes the shards (bank_folder, stem) whose vectors all have the first shard's length, and returns every shard's log: num_vec, status. A bad shard is left out; the others go on."""
    log = shard_dims(vectors)
    good = log.where("status = 'ok'").select("bank_folder", "stem")
    vectors.join(good, ["bank_folder", "stem"], "left_semi").write.mode("overwrite").parquet(path)
    return log.select("bank_folder", "stem", "num_vec", "status")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_smoke(spark: SparkSession, path: str) -> bool:
    return spark.read.parquet(path).limit(1).count() == 1


def shard_dims(vectors: DataFrame) -> DataFrame:
    """Per shard its vectors, their lengths, and whether they are all that of the first shard."""
    own = vectors.groupBy("bank_folder", "stem").agg(F.count("*").alias("num_vec"), F.min(F.size("embedding")).alias("min_dim"), F.max(F.size("embedding")).alias("max_dim"))
    expected = vectors.agg(F.min_by(F.size("embedding"), F.struct("bank_folder", "stem")).alias("dim"))
    return own.crossJoin(F.broadcast(expected)).withColumn("status", F.when((F.col("min_dim") == F.col("dim")) & (F.col("max_dim") == F.col("dim")), "ok").otherwise("dim_mismatch"))
