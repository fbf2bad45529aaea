"""The index against a scan of all vectors, what it skips, batches, faults."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import products, vector_index, vectors


def made(n=4000, dims=8, seed=3):
    """Vectors around thirty centres, not all of length one, with copies and ties."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(30, dims))
    own = centres[r.integers(0, 30, n)] + 0.15 * r.normal(size=(n, dims))
    own[::2] /= np.linalg.norm(own[::2], axis=1)[:, None]
    own[n - 300 :] = own[5]
    return [((1 << 60) + i, i % 7, x.astype(np.float32).tolist()) for i, x in enumerate(own)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(made(), "vec_id long, label int, embedding array<float>").repartition(4).cache()


@pytest.fixture(scope="module")
def index(table, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("index") / "own")
    vector_index.build(table.where("vec_id % 2 = 0"), at, 30)
    vector_index.append(table.where("vec_id % 2 = 1"), at)
    return at


def rows(df):
    return sorted((x.query_id, x["rank"], x.vec_id, x.label, round(x.score, 9)) for x in df.collect())


@pytest.mark.parametrize("k,digits", [(1, 9), (5, 9), (400, 9), (20, 2)])
def test_equals_a_scan(table, index, k, digits):
    asked = table.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    got, want = vector_index.search(asked, index, k, "vec_id", digits), vectors.top_k(asked, table, k, "vec_id", digits)
    assert rows(got) == rows(want) and len(rows(got)) == 200 * k


def test_blocks_and_odd_queries(spark, table, index, monkeypatch):
    monkeypatch.setattr(products, "KEPT", 30)
    r = random.Random(2)
    queries = [(f"q{i}", [r.uniform(-2, 2) for _ in range(8)]) for i in range(25)] + [("null", None), ("short", [1.0]), ("zero", [0.0] * 8)]
    asked = spark.createDataFrame(queries, "query_id string, query array<double>")
    assert rows(vector_index.search(asked, index, 3, "vec_id", 9)) == rows(vectors.top_k(asked, table, 3, "vec_id", 9))
    assert vector_index.search(asked.where("false"), index, 3).collect() == []


def _files(spark, df):
    """(files read, folders pruned while running) of the scan of the vectors."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    leaves = plan.collectLeaves()
    text = plan.toString()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if name in ("AQEShuffleRead", "ShuffleQueryStage", "BroadcastQueryStage"):
            pass

    walk(plan)
    assert leaves.size() > 0
    return found, "dynamicpruning" in text.lower()


def test_files_are_skipped(spark, table, index):
    """Few cells are wanted, and only their files are opened."""
    one = table.where(f"vec_id = {1 << 60}").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    block = products.collected(one)
    known = vector_index.cells(spark, index)
    few = vector_index._bounds(known, block, 3, 9).where(F.col("bound") >= F.col("least"))
    assert 0 < few.count() < known.count() / 4
    read, pruned = _files(spark, vector_index.vectors_of(spark, index, few).select("vec_id"))
    every = spark.read.parquet(f"{index}/vectors").select(F.input_file_name()).distinct().count()
    assert pruned and sum(read) < every / 3


def test_appending_rebuilds_nothing(spark, table, index, tmp_path):
    at = str(tmp_path / "ix")
    vector_index.build(table.where("vec_id % 3 = 0"), at, 10)
    before = {r[0] for r in spark.read.parquet(f"{at}/vectors").select(F.input_file_name()).distinct().collect()}
    vector_index.append(table.where("vec_id % 3 = 1"), at)
    vector_index.append(table.where("false"), at)
    with pytest.raises(ValueError):
        vector_index.append(spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>"), at)
    # a batch that stopped before its cells were written is not seen
    table.where("vec_id % 3 = 2").withColumn("cluster", F.lit(0)).withColumn("far", F.lit(0.0)).write.partitionBy("cluster").parquet(f"{at}/vectors/batch=stopped")
    after = {r[0] for r in spark.read.parquet(f"{at}/vectors").where("batch <> 'stopped'").select(F.input_file_name()).distinct().collect()}
    assert before < after
    asked = table.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    assert rows(vector_index.search(asked, at, 5, "vec_id", 9)) == rows(vectors.top_k(asked, table.where("vec_id % 3 < 2"), 5, "vec_id", 9))
