"""The crawl against a queue in plain Python; hubs, plans, nulls."""

import random
from collections import deque

import pytest

from factloom.operators import crawl


def graph(seed, n=60):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        links = [f'<a href="../annual/{r.randrange(n + 10)}">{r.choice(["annual", "x", "report"])}</a>' for _ in range(r.randrange(9))]
        links += ['<a href="/annual/0/./">hub</a>', '<a href="http://other.org/annual/1">out</a>', '<a href="a.pdf">annual</a>'][: r.randrange(4)]
        rows.append((i, f"https://b.example.com/annual/{i if i else '0/'}", "<html>" + "".join(links)))
    return [*rows, (None, None, None), (n + 1, "https://b.example.com/annual/1", None), (n + 2, "https://b.example.com/annual/99", "")]


def queue(start, pages, max_depth, max_pages):
    """Visited pages of one start as the queue of a crawler takes them."""
    from urllib.parse import urljoin

    from factloom.functions.markup import read

    at, out, todo = {}, [], deque([(start, 0, None, None)])
    for _, url, html in pages:
        if url is not None:
            at.setdefault(url, []).append(html)
    seen = set()
    while todo and len(out) < max_pages:
        url, depth, parent, anchor = todo.popleft()
        if url in seen or depth > max_depth:
            continue
        seen.add(url)
        if url not in at:
            continue
        out.append((url, depth, parent, anchor, len(out) + 1))
        if depth < max_depth:
            for html in at[url]:
                for href, parts in read(html or "").links:
                    to, text = urljoin(url, href), " ".join(parts)
                    words = ("annual", "report")  # what the graph's links have of the words that are followed at either depth
                    if to.split("/")[2].endswith("example.com") and not to.endswith(".pdf") and any(w in to or w in text for w in words):
                        todo.append((to, depth + 1, url, text))
    return out


@pytest.mark.parametrize("max_depth,max_pages,hub", [(2, 40, 10_000), (2, 6, 10_000), (3, 15, 2), (0, 5, 10_000), (1, 1, 1)])
def test_equals_a_queue(spark, max_depth, max_pages, hub):
    rows = graph(max_depth * 10 + max_pages)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    starts = [(f"b{i}", f"https://b.example.com/annual/{i if i else '0/'}", "example.com", "example.com") for i in range(0, 60, 4)] + [("gone", "https://b.example.com/annual/500", "example.com", None), ("far", "http://other.org/x", "example.com", None)]
    got = crawl.crawl(spark.createDataFrame(starts, "bank string, start_url string, base_root string, entry_root string"), pages, max_depth, max_pages, hub=hub).collect()
    own = {}
    for x in got:
        own.setdefault(x.bank, []).append((x.url, x.depth, x.parent_url, x.anchor_text, x.place))
    assert {b: sorted(v, key=lambda x: x[4]) for b, v in own.items()} == {b: w for b, s, *_ in starts for w in [queue(s, rows, max_depth, max_pages)] if w and b != "far"}


def test_plans(spark):
    """What the last depth reads are written tables: neither pages nor earlier depths are in its plan, and every window has a partition."""
    pages = spark.createDataFrame(graph(1), "page_id long, url string, html string")
    starts = pages.where("page_id < 5").selectExpr("page_id AS bank", "url AS start_url", "'example.com' AS base_root", "'example.com' AS entry_root")
    seen = []
    held, crawl.written = crawl.written, lambda df, name: seen.append((name, df._jdf.queryExecution().executedPlan().toString())) or held(df, name)
    try:
        out = crawl.crawl(starts, pages)
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        crawl.written = held
    plans = dict(seen)
    last = plans["crawl-2"]
    assert "crawl-seen-2" in last and "crawl-links" in last and "crawl-0" not in last and "LocalTableScan" not in last and "ArrowEvalPython" not in last
    assert "SinglePartition" not in "".join(plans.values()) and "Exchange" not in final and final.count("crawl-") >= 3
