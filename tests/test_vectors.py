"""Exact products in blocks against plain loops: ties, nulls, other lengths, repeated rows, long ids, blocks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import products, vectors

SCHEMA = "vec_id long, key struct<a:string,b:int>, label int, score string, embedding array<float>"


def made(n=300, dims=5, seed=1):
    r = random.Random(seed)
    pool = [[round(r.uniform(-1, 1), 1) for _ in range(dims)] for _ in range(40)]
    rows = [((1 << 60) + i, (r.choice(["a", "é", "Z", None]), i), i % 4, "clash", [float(np.float32(x)) for x in r.choice(pool)]) for i in range(n)]
    return [*rows, (7, ("a", -1), 1, "", None), (8, ("a", -2), 1, "", [1.0]), (9, None, 1, "", [1.0, None, 2.0, 3.0, 4.0]), (10, ("b", 1), 2, "", []), (11, None, 3, "", rows[0][4])]


def score(a, b, digits=9):
    s = 0.0
    for x, y in zip(a, b, strict=True):
        s += x * y
    return round(s, digits)


def asked(rows):
    return [(i, rows[i * 7][4], i % 4, 1 + i % 3) for i in range(30)] + [(30, None, 1, 1), (31, [0.0] * 5, 2, 2)]


def ranked(rows, queries):
    out = {}
    for q, v, *_ in queries:
        if v is not None:
            ok = [r for r in rows if r[4] is not None and len(r[4]) == len(v) and None not in r[4]]
            out[q] = sorted(((-score(r[4], v), r[0]) for r in ok), key=lambda x: x)
    return out


@pytest.mark.parametrize("block,cells", [(1000, 1 << 22), (7, 50)])
def test_top_k(spark, monkeypatch, block, cells):
    monkeypatch.setattr(vectors, "BROADCAST_QUERIES", block)
    monkeypatch.setattr(products, "CELLS", cells)
    rows = made()
    queries = asked(rows)
    v = spark.createDataFrame(rows, SCHEMA).drop("score").repartition(3)
    q = spark.createDataFrame(queries, "query_id long, query array<float>, asked int, want int")
    want = ranked(rows, queries)
    for k in (1, 4, 1000):
        got = {}
        for x in vectors.top_k(q.select("query_id", "query"), v, k, "vec_id", 9).collect():
            got.setdefault(x.query_id, []).append((x["rank"], -round(x.score, 9), x.vec_id))
        assert {a: sorted(b) for a, b in got.items()} == {a: [(i + 1, *x) for i, x in enumerate(b[:k])] for a, b in want.items()}
    assert vectors.top_k(q.where("false").select("query_id", "query"), v, 3).collect() == []
    assert vectors.top_k(q.select("query_id", "query"), v.where("false"), 3).collect() == []


def test_ties_by_a_struct(spark):
    """Equal scores come in the order of the fields, nulls first, as Spark sorts them."""
    rows = made()
    v = spark.createDataFrame(rows, SCHEMA).drop("score")
    q = spark.createDataFrame([(1, rows[3][4])], "query_id int, query array<float>")
    got = [x.vec_id for x in vectors.top_k(q, v, 100, "key", 9).orderBy("rank").collect()]
    plain = v.where("size(embedding) = 5").withColumn("s", F.round(vectors.dot(F.col("embedding"), F.array(*[F.lit(x) for x in rows[3][4]])), 9)).where("s IS NOT NULL")
    assert got == [x.vec_id for x in plain.orderBy(F.desc("s"), "key").limit(100).collect()]


@pytest.mark.parametrize("tie,block,cells", [("vec_id", 1000, 1 << 22), ("vec_id", 5, 64), ("key", 1000, 1 << 22)])
def test_adaptive(spark, monkeypatch, tie, block, cells):
    monkeypatch.setattr(vectors, "BROADCAST_QUERIES", block)
    monkeypatch.setattr(products, "CELLS", cells)
    rows = [r for r in made() if r[1] is not None or r[0] == 9]
    queries = asked(rows)
    v = spark.createDataFrame(rows, SCHEMA).drop("score").repartition(4)
    q = spark.createDataFrame(queries, "query_id long, query array<float>, asked int, want int")
    every = vectors.top_k(q.select("query_id", "query"), v, 1000, tie, 9).join(q.drop("query"), "query_id")
    want = vectors.adaptive_k(every, F.col("label") == F.col("asked"), F.col("want"), 2, 100)
    got = vectors.adaptive_top_k(q, v, F.col("label") == F.col("asked"), F.col("want"), 2, 100, tie, 9)
    rows_of = lambda df: sorted(tuple(x) for x in df.select("query_id", "vec_id", "rank", "k_used", "label").collect())
    assert rows_of(got) == rows_of(want) and len(rows_of(got)) > 20


@pytest.mark.parametrize("tie,cells,entities", [("key", 1 << 22, 100_000), ("vec_id", 64, 100_000), ("vec_id", 1 << 22, 5)])
def test_a_table_of_entities(spark, monkeypatch, tie, cells, entities):
    """What a condition gives, also in small parts, and where a block has more entities than a task is handed."""
    rows = [r for r in made() if r[1] is not None or r[0] == 9]
    v = spark.createDataFrame(rows, SCHEMA).drop("score").repartition(3)
    q = spark.createDataFrame(asked(rows), "query_id long, query array<float>, asked int, want int").where("want < 3")
    rows_of = lambda df: sorted(tuple(x) for x in df.select("query_id", "vec_id", "rank", "k_used", "label").collect())
    want = rows_of(vectors.adaptive_top_k(q, v, F.col("label") == F.col("asked"), F.col("want"), 2, 100, tie, 9))
    monkeypatch.setattr(products, "CELLS", cells)
    monkeypatch.setattr(products, "AT_ONCE", 3)
    monkeypatch.setattr(vectors, "ENTITIES", entities)
    table = q.select("query_id", F.col("asked").cast("long").alias("label"))
    assert rows_of(vectors.adaptive_top_k(q, v, table, F.col("want"), 2, 100, tie, 9)) == want and len(want) > 10


def test_entities_make_no_pairs(spark, monkeypatch):
    """Neither a row a pair nor an exchange of the vectors by entity; each task sends what it may keep."""
    seen = []
    monkeypatch.setattr(vectors.scratch, "written", lambda df, name, own=vectors.scratch.written: (seen.append(df._jdf.queryExecution().executedPlan().toString()) if name == "adaptive" else None, own(df, name))[1])
    v = spark.createDataFrame(made(2000), SCHEMA).drop("score").repartition(4)
    q = spark.createDataFrame(asked(made()), "query_id long, query array<float>, asked int, want int")
    assert vectors.adaptive_top_k(q, v, q.select("query_id", F.col("asked").alias("label")), F.col("want"), 2, 100).count() > 20
    assert seen and all("NestedLoop" not in p and "ArrowEvalPython" not in p and "MapInArrow" in p and "hashpartitioning(label" not in p for p in seen)


def test_plans(spark):
    """k rows a query a task go to the one shuffle, and no row stands for a pair."""
    rows = made(2000)
    v = spark.createDataFrame(rows, SCHEMA).drop("score").repartition(4)
    q = spark.createDataFrame(asked(rows), "query_id long, query array<float>, asked int, want int").select("query_id", "query")
    assert products.partial_top_k(q, v, 3, "vec_id", 9).count() <= 3 * 31 * 4
    plan = vectors.top_k(q, v, 3, "vec_id", 9)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Exchange hashpartitioning(query_id") == 1 and "MapInArrow" in plan


def test_inner(spark):
    rows = [([1.0, 2.0], [3.0, 4.0]), ([1.0], [1.0, 2.0]), (None, [1.0]), ([1.0, None], [1.0, 2.0]), ([2.0], [0.5]), ([], [])]
    got = spark.createDataFrame(rows, "a array<float>, b array<double>").select(products.inner(F.col("a"), F.col("b")).alias("x")).collect()
    assert [x.x for x in got] == [11.0, None, None, None, 1.0, None]
