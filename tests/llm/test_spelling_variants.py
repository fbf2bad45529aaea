"""Spelling variants against all pairs of words, and the query against SQL of another method."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from factloom.llm import spelling_variants
from factloom.llm.queries import QUERIES, SQL

UPPER = str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER)


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            n[run if h % 31 else run[:k] + run[k + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def plain(rows):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in rows)


def texts():
    r = random.Random(2)
    base = ["".join(r.choice("abÀéz") for _ in range(r.randrange(6, 11))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abababab", "straße" * 2, "÷×÷×÷×÷"]

    def typo(w):
        i = r.randrange(len(w))
        return r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abÀé") + w[i:], w[:i] + r.choice("abÀé") + w[i + 1 :], w.upper(), w])

    out = []
    for i in range(120):
        out.append((i, " ".join(r.choice([w, w, w, typo(w), typo(typo(w) + "b")]) + r.choice([" ", "1", ", ", "\n"]) for w in r.choices(base[:10] + base, k=60))))
    return [*out, (None, out[0][1]), (None, None), (1 << 60, None), (7, ""), out[3], out[3], (500, " ".join(["Wörterbuch"] * 400 + ["Worterbuch"] * 30 + ["Worterbuh"] * 2)), (501, ("x" * 900 + " ") * 3 + ("x" * 899 + " ") * 2)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*x, 3, "clash") for x in texts()], "doc_id long, text string, n int, word string").repartition(4)


@pytest.fixture(scope="module")
def wanted():
    return brute(texts())


@pytest.mark.parametrize("most,bucket", [(50_000, 100_000), (3, 50), (1, 1000)])
def test_against_all_pairs(docs, wanted, most, bucket):
    """Also with groups that are dealt anew down to single positions."""
    got = plain(spelling_variants.group_variants(docs, most, bucket).collect())
    assert [g for g in got if len(g[0]) < 100] == [w for w in wanted if len(w[0]) < 100]
    assert got == wanted and any(g[2] != g[0] and g[2] != g[1] for g in got)


def test_very_long_words(spark):
    rows = [(1, ("x" * 30_000 + " ") * 3 + ("x" * 29_999 + " ") * 2 + ("x" * 15_000 + "y" + "x" * 14_999 + " ") * 40)]
    got = spelling_variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert plain(got) == brute(rows) and len(got) == 3


def test_empty(docs):
    assert spelling_variants.group_variants(docs.where("false")).collect() == []


def test_slices_of_points(monkeypatch):
    """The pairs of one bucket don't depend on how many points are held."""
    r = random.Random(1)
    words = sorted({"".join(r.choice("ab") for _ in range(r.choice([7, 8]))) for _ in range(300)})
    rows = [(w, kind, m, longer) for w in words for kind, m, longer in ((0, len(w), False), (1, len(w), False), (1, len(w) - 1, True))]
    kind, m, longer = (np.array([x[i] for x in rows]) for i in (1, 2, 3))
    group = kind * 100 + m
    found = []
    for points in (1, 50, 1 << 20):
        pairs = [p for here, there in spelling_variants.near([x[0] for x in rows], group, kind, m, np.zeros_like(m), m + kind, longer.astype(bool), points) for p in zip(here.tolist(), there.tolist(), strict=True)]
        found.append(sorted((rows[i][0], rows[j][0]) for i, j in pairs))
    assert found[0] == found[1] == found[2] == sorted((x, y) for x in words for y in words if one_edit(x, y))


def test_wavelet_tree():
    r = np.random.default_rng(4)
    for n in (1, 2, 3, 100, 257):
        values = r.permutation(n)
        x, y = r.integers(0, n + 1, (2, 200)), r.integers(0, n + 1, (2, 200))
        of, found = spelling_variants.WaveletTree(values).report(x[0], x[1], y[0], y[1])
        want = [(q, v) for q in range(200) for v in values[x[0][q] : x[1][q]].tolist() if y[0][q] <= v < y[1][q]]
        assert sorted(zip(of.tolist(), found.tolist(), strict=True)) == sorted(want)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    theirs = duck.sql(f"select word, form, root, n, n_near, form_n from ({SQL['op12_spelling_variants']})").fetchall()
    assert plain(QUERIES["op12_spelling_variants"](spark, sf).collect()) == sorted((w, f or "", r, n, k, -1 if c is None else c) for w, f, r, n, k, c in theirs)
