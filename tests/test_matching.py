"""Entities and keywords found without pairing everything, against everything paired."""

import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from factloom.operators import keywords, pages, retrieval


def names(n, seed):
    r = random.Random(seed)
    parts = ["first", "national", "bank", "of", "union", "é", "trust", "co", "savings", "st", "city", "west", "a", "ab", "holdings"]
    return list(dict.fromkeys(r.choice(["", " ", "_"]) + " ".join(r.choices(parts, k=r.randrange(1, 6))).title() + r.choice(["", "", str(r.randrange(3000)), "_" + str(r.randrange(99999)), " "]) for _ in range(n)))


def test_entities_of_long_lists(spark):
    x, y = names(24_000, 1), names(24_000, 2)
    assert min(len(x), len(y)) > 15_000
    left, right = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, a string"), spark.createDataFrame([(i, v) for i, v in enumerate(y)], "j int, b string")
    found = retrieval.entity_pairs(left, right, "a", "b")
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()
    l, r = (pd.DataFrame({"i": range(len(v)), "k": [t.strip(" ").lower() for t in v]}) for v in (x, y))  # noqa: F841
    sql = "SELECT count(*), sum((l.i * 1000003 + r.i) % 999983) FROM l JOIN r ON l.k <> '' AND r.k <> '' AND (starts_with(l.k, r.k) OR starts_with(r.k, l.k) OR (contains(l.k, r.k) AND length(r.k) >= 8) OR (contains(r.k, l.k) AND length(l.k) >= 8))"
    want = duckdb.sql(sql).fetchall()[0]
    got = found.agg(F.count("*"), F.sum((F.col("i").cast("long") * 1000003 + F.col("j")) % 999983)).collect()[0]
    assert tuple(got) == tuple(map(int, want)) and want[0] > 10_000


def test_entities_with_nulls_ties_and_bare_names(spark):
    x, y = [None, "", "  ", "_Acme", "acme", "Acme Bank N.A.", "ab", "ACME"], ["acme", "__ACME bank n.a.", None, "", "abc", "the acme bank n.a. group", "acme"]
    left, right = spark.createDataFrame([(v,) for v in x], "a string"), spark.createDataFrame([(v,) for v in y], "b string")
    for bare in (False, True):
        got = sorted(tuple(r) for r in retrieval.entity_pairs(left, right, "a", "b", bare).collect())
        assert got == sorted(tuple(r) for r in left.crossJoin(right).where(retrieval.same_entity(F.col("a"), F.col("b"), bare)).collect()) and got
    assert retrieval.entity_pairs(left.where("false"), right, "a", "b").collect() == []


def test_automaton():
    r = random.Random(3)
    for _ in range(60):
        words = ["".join(r.choice("abé") for _ in range(r.randrange(0, 5))).encode() for _ in range(r.randrange(1, 40))]
        texts = ["".join(r.choice("abé") for _ in range(r.randrange(0, 30))).encode() for _ in range(20)]
        of, word = keywords.Automaton(words).found(texts)
        assert list(zip(of.tolist(), word.tolist(), strict=True)) == [(i, j) for i, t in enumerate(texts) for j, w in enumerate(words) if w in t]


def test_many_rules(spark, monkeypatch):
    """A hundred thousand rules over whole pages, in one block and in several."""
    r = random.Random(5)
    made = ["".join(r.choice("etaoinshr") for _ in range(r.randrange(3, 9))) for _ in range(100_000)] + ["", "The", None, "é", "the"]
    rules = [(i, "NEG" if i % 5 == 0 else f"t{i % 3}", k, i % 11 - 3) for i, k in enumerate(made)]
    table = spark.createDataFrame(rules, "place int, tag string, keyword string, points int")
    source = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").union(spark.createDataFrame([(1 << 60, None, None), (-5, "HTTP://THE.É/", "<title>é THE</title>")], "page_id long, url string, html string"))
    got = {x.page_id: x for x in pages.score_by_rules(source, table).collect()}
    rows = source.select("page_id", F.lower("url").alias("u"), F.lower(pages.M.page_title(F.col("html"))).alias("t")).collect()
    assert set(got) == {x.page_id for x in rows if x.u is not None}
    for x in r.sample([x for x in rows if x.u is not None], 25) + [x for x in rows if x.page_id == -5]:
        hit = [(i, tag, k, p) for i, tag, k, p in rules if k is not None and (k.lower() in x.u or k.lower() in x.t)]
        mine = got[x.page_id]
        assert (mine.score, mine.n_hits) == (sum(h[3] for h in hit), len(hit))
        assert mine.reasons == ";".join(f"{h[1]}::{h[2]}" for h in hit) and mine.tags == ";".join(sorted({h[1] for h in hit} - {"NEG"}))
    monkeypatch.setattr(keywords, "RULES_AT_ONCE", 30_000)
    some = source.where("page_id % 50 = 0 OR page_id < 0")
    assert {x.page_id: tuple(x) for x in pages.score_by_rules(some, table).collect()} == {x.page_id: tuple(got[x.page_id]) for x in some.collect() if x.page_id in got}


def test_no_rules(spark):
    none = spark.createDataFrame([], "place int, tag string, keyword string, points int")
    assert pages.score_by_rules(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), none).collect() == []
