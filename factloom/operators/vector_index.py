"""A persisted index of vectors with exact search.

Vectors lie in Parquet folders by batch and cluster. A cell (batch, cluster) has its cluster's centre c and the radius r of
its own vectors around it. No vector v of a cell scores more than q.c + |q| r, so once a query has k hits, cells whose
bound is under the k-th are skipped, and with them their files. Nothing is approximated: with bad clusters more is read.

The centres are fitted once, on a bounded sample (SAMPLE vectors with the smallest hashes); every vector is indexed.
Appending assigns new vectors to the same centres and rebuilds nothing. A batch counts when its cells are written, which
is the last step, so a build that stops half way leaves no trace in results and may be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch
from . import products
from .vectors import blocks

#: Vectors that the centres are fitted on, rounds of the fit, and cells that a query looks into first.
SAMPLE, ROUNDS, FIRST = 20_000, 10, 4
CELL = ["batch", "cluster"]


def fitted(vectors: DataFrame, clusters: int) -> np.ndarray:
    """Centres of a bounded sample by Lloyd's rounds, beginning with vectors far from each other."""
    rows = vectors.where("embedding IS NOT NULL").select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).toArrow()
    _, own = products.matrix(rows.column("embedding")) if len(rows) else ([], np.zeros((0, 1)))
    if not len(own):
        return np.zeros((1, 1))
    centres = own[:1]
    nearest = ((own - centres[0]) ** 2).sum(axis=1)
    while len(centres) < clusters and nearest.max() > 0:
        centres = np.vstack([centres, own[nearest.argmax()]])
        nearest = np.minimum(nearest, ((own - centres[-1]) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        of = assigned(own, centres)
        count = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, own)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def assigned(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1) if len(vectors) else np.zeros(0, np.int64)


def build(vectors: DataFrame, path: str, clusters: int = 256) -> None:
    """A new index at the path over all columns of the vectors (embedding and others)."""
    centres = fitted(vectors, clusters)
    rows = [(i, c.tolist()) for i, c in enumerate(centres)]
    vectors.sparkSession.createDataFrame(rows, "cluster int, centre array<double>").write.mode("errorifexists").parquet(f"{path}/centres")
    append(vectors, path)


def append(vectors: DataFrame, path: str) -> str:
    """Adds a batch; vectors of another length than the centres stop it. Returns the batch's name."""
    spark = vectors.sparkSession
    centres = np.array([r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("cluster").collect()])
    dims = centres.shape[1]
    bad = vectors.where(F.col("embedding").isNull() | (F.size("embedding") != dims) | F.exists("embedding", lambda x: x.isNull()))
    if not bad.isEmpty():
        raise ValueError(f"vectors that are null or of other length than {dims}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, own = products.matrix(b.column("embedding"), dims)
            of = assigned(own, centres)
            far = np.sqrt(((own - centres[of]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of, pa.int32()), pa.array(far)], [*b.schema.names, "cluster", "far"])

    name = uuid.uuid4().hex
    placed = vectors.mapInArrow(run, f"{products.fields(vectors)}, cluster int, far double")
    # files of a fair size, and a hot cluster in several
    placed.hint("rebalance", "cluster").write.partitionBy("cluster").parquet(f"{path}/vectors/batch={name}")
    own = spark.read.option("basePath", f"{path}/vectors").parquet(f"{path}/vectors/batch={name}") if not vectors.isEmpty() else None
    if own is not None:
        cells = own.groupBy("cluster").agg(F.max("far").alias("radius"), F.count("*").alias("n")).join(spark.read.parquet(f"{path}/centres"), "cluster")
        cells.select(F.lit(name).alias("batch"), "cluster", "centre", "radius", "n").coalesce(1).write.mode("append").parquet(f"{path}/cells")
    return name


def cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch string, cluster int, centre array<double>, radius double, n long").parquet(f"{path}/cells")


def vectors_of(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The vectors of the cells wanted (batch, cluster). The cells are broadcast, and other cells' folders are not read."""
    return spark.read.parquet(f"{path}/vectors").join(F.broadcast(wanted.select(*CELL).distinct()), CELL, "left_semi").drop("far")


def search(queries: DataFrame, path: str, k: int = 50, tie: str = "vec_id", digits: int | None = None) -> DataFrame:
    """query_id, the vectors' columns, score, rank: the k best vectors of each query (query_id, query), equal scores by id. The same rows as a scan of all vectors gives."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), tie)
    out = None
    for part in blocks(queries, most=max(1, min(1000, products.KEPT // max(1, k)))):
        for hits in _searched(part, path, k, tie, digits):
            out = hits if out is None else out.unionByName(hits)
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _searched(queries: DataFrame, path: str, k: int, tie: str, digits: int | None) -> list[DataFrame]:
    """Candidates in two rounds: of the cells that promise most, then of all others whose bound reaches the k-th hit."""
    spark, block = queries.sparkSession, products.collected(queries)
    known = cells(spark, path)
    promise = scratch.written(_bounds(known, block, k, digits), "index-first")
    first = promise.where(F.col("bound") >= F.col("least"))
    found = scratch.written(_best_of(vectors_of(spark, path, first), first, block, k, tie, digits), "index-hits")
    order = Window.partitionBy("of").orderBy(F.desc("score"))
    kth = found.withColumn("place", F.row_number().over(order)).where(F.col("place") == k).select("of", "score").toArrow()
    least = np.full(len(block), -np.inf)
    least[kth.column("of").to_numpy()] = kth.column("score").to_numpy()
    more = scratch.written(_bounds(known, block, None, digits, least).join(first.select("of", *CELL), ["of", *CELL], "left_anti"), "index-more")
    rest = more.where(F.col("bound") >= F.col("least"))
    return [found.drop("of"), _best_of(vectors_of(spark, path, rest), rest, block, k, tie, digits, least).drop("of")]


def _bounds(known: DataFrame, block: products.Queries, k: int | None, digits: int | None, least: np.ndarray | None = None) -> DataFrame:
    """of (the query's place in the block), batch, cluster, bound, least: the cells whose bound reaches what a query has; with k only those that promise most, FIRST at least and k vectors together."""
    slack = 1e-9 + (0 if digits is None else 10.0**-digits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, centres = products.matrix(b.column("centre"), block.dims)
            if not len(centres):
                continue
            reach = b.column("radius").to_numpy()[:, None] * block.lengths
            bound = centres @ block.vectors.T + reach * (1 + 1e-9) + slack
            least_here = np.broadcast_to(np.full(len(block), -np.inf) if least is None else least, bound.shape)
            r, of = np.nonzero(bound >= least_here)
            taken = [b.column(c).take(pa.array(r)) for c in (*CELL, "n")]
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), *taken, pa.array(bound[r, of]), pa.array(least_here[r, of])], ["of", *CELL, "n", "bound", "least"])

    out = known.mapInArrow(run, "of long, batch string, cluster int, n long, bound double, least double")
    if k is None:
        return out.drop("n")
    promise = Window.partitionBy("of").orderBy(F.desc("bound"), *CELL)
    before = F.sum("n").over(promise.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("place", F.row_number().over(promise)).withColumn("before", F.coalesce(before, F.lit(0))).where((F.col("place") <= FIRST) | (F.col("before") < k)).drop("place", "before", "n")


def _best_of(vectors: DataFrame, pairs: DataFrame, block: products.Queries, k: int, tie: str, digits: int | None, least: np.ndarray | None = None) -> DataFrame:
    """query_id, the vectors' columns, score, of: the k best rows a query a task, each query only within its own cells."""
    asked = {}
    for batch, cluster, of in pairs.select(*CELL, "of").toArrow().to_pandas().itertuples(index=False):
        asked.setdefault((batch, cluster), []).append(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = products.Best(block, k, tie, digits)
        if least is not None:
            best.least = least.copy()
        for b in batches:
            allowed = np.zeros((len(b), len(block)), bool)
            own = list(zip(b.column("batch").to_pylist(), b.column("cluster").to_pylist(), strict=True))
            for cell in set(own):
                allowed[np.ix_([i for i, c in enumerate(own) if c == cell], asked[cell])] = True
            best.add(b, allowed)
        for out in best.result():
            at = {x: i for i, x in enumerate(block.ids.to_pylist())}
            yield out.append_column("of", pa.array([at[x] for x in out.column("query_id").to_pylist()], pa.int64()))

    kind = "string" if pa.types.is_string(block.ids.type) else "int" if pa.types.is_int32(block.ids.type) else "long"
    others = vectors.drop("embedding")
    return vectors.mapInArrow(run, f"query_id {kind}, {products.fields(others)}, score double, of long").drop(*CELL)
