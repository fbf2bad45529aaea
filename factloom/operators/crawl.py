"""A bounded breadth-first crawl over a table of pages and their links.

The pages are read once: their links to pages that are there, with what decides whether they are followed, are a table.
Each depth is one join of the frontier with the links, written to the shared folder before the next begins, so that the
plan of a depth reads tables and holds no earlier depth, and a lost executor costs no more than the depth at hand. The
pages that a bank has visited are a list of max_pages at most in the bank's row, and what is new is found by an equality
join on the bank, which the ranking of the new pages shares. A page that many banks look at has its links dealt to salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import urls as U
from ..sources.scratch import discard, written
from . import pages as P

#: Banks at one page beyond which its links are dealt to several tasks.
HUB = 10_000


def start_urls(banks: DataFrame) -> DataFrame:
    """Banks marked YES with start_url, base_root, entry_root: the report link, or a listed override; a missing link is not replaced by the base url."""
    listed = F.create_map(*[F.lit(x) for kv in V.START_URLS.items() for x in kv])
    entry = F.coalesce(listed[F.col("username")], F.col("financial report link"))
    kept = banks.where(F.col("financial report") == "YES").withColumn("entry_url", entry).where("entry_url is not null")
    return kept.withColumn("start_url", U.with_scheme(F.col("entry_url"))).withColumn("base_root", U.root_host(F.col("url"))).withColumn("entry_root", U.root_host(F.col("entry_url")))


def same_site(starts: DataFrame, pages: DataFrame, max_depth: int = V.MAX_DEPTH, max_pages: int = 20) -> DataFrame:
    """The simpler crawl: links of the start's own site whose url has one of a few words."""
    follows = lambda url, text, depth: U.contains_any(F.lower(url), V.EXPAND_URL_SIMPLE)
    return crawl(starts, pages, max_depth, max_pages, follows, lambda c: U.is_same_site(F.col("base_root"), F.col(c)))


def edges(pages: DataFrame, follows=U.expands) -> DataFrame:
    """page_url, position, to, text, is_first, is_deeper: the links between pages that are there, and whether they are followed from an entry page and from one below."""
    found = P.links(pages).where(~U.is_static_asset(F.col("url"))).select("page_url", "position", F.col("url").alias("to"), "text")
    followed = [F.coalesce(follows(F.col("to"), F.col("text"), F.lit(depth)), F.lit(False)).alias(name) for depth, name in ((0, "is_first"), (1, "is_deeper"))]
    known = pages.select(F.col("url").alias("to")).distinct()
    return found.select("*", *followed).where("is_first OR is_deeper").join(known, "to", "left_semi")


def crawl(starts: DataFrame, pages: DataFrame, max_depth: int = V.MAX_DEPTH, max_pages: int = V.MAX_PAGES, follows=U.expands, allowed=None, hub: int = HUB) -> DataFrame:
    """bank, url, depth, parent_url, anchor_text, place of the visited pages in the order of a queue, max_pages for each bank at most.

    Pages beyond the number are never visited, so their links are not followed: each depth is cut to the places that are left.

    starts: bank, start_url, base_root, entry_root. pages: page_id, url, html; pages that aren't there are failed fetches and cost nothing.
    """
    allowed = allowed or (lambda c: U.is_allowed(F.col(c), F.col("base_root"), F.col("entry_root")))
    roots, none = ["bank", "base_root", "entry_root"], F.lit(None).cast("string")
    links = written(edges(pages, follows), "crawl-links")
    known = pages.select(F.col("url").alias("start_url")).distinct()
    start = F.col("start_url").alias("url")
    entry = starts.where(allowed("start_url")).join(known, "start_url", "left_semi").select(*roots, start, F.array().cast("array<int>").alias("path"), none.alias("parent_url"), none.alias("anchor_text"))
    now = written(_ranked(entry, None, max_pages, 0), "crawl-0")
    depths, seen = [now], None
    for depth in range(1, max_depth + 1):
        seen = _visited(now, seen, depth)
        step = _followed(now, links.where("is_first" if depth == 1 else "is_deeper"), hub)
        step = step.where(allowed("to")).select(*roots, F.col("to").alias("url"), F.concat("path", F.array("position")).alias("path"), F.col("page_url").alias("parent_url"), F.col("text").alias("anchor_text"))
        now = written(_ranked(step, seen, max_pages, depth), f"crawl-{depth}")
        depths.append(now)
    discard(links)
    out = depths[0]
    for d in depths[1:]:
        out = out.unionByName(d)
    return out.select("bank", "url", "depth", "parent_url", "anchor_text", "place")


def _ranked(step: DataFrame, seen: DataFrame | None, max_pages: int, depth: int) -> DataFrame:
    """The pages of a step that a bank has not visited, each by the way that is first in the queue, with their places as far as there are any left."""
    # the exchange by bank serves the smallest of several ways, the join with what is visited, and the ranking
    step = step.repartition("bank")
    once = step.groupBy("bank", "url").agg(F.min(F.struct("path", "base_root", "entry_root", "parent_url", "anchor_text")).alias("s")).select("bank", "url", "s.*")
    if seen is not None:
        once = once.join(seen, "bank").where(~F.array_contains("visited", F.col("url")))
    before = F.lit(0) if seen is None else F.size("visited")
    place = (before + F.row_number().over(Window.partitionBy("bank").orderBy("path", "url"))).cast("int")
    out = once.withColumn("place", place).where(F.col("place") <= max_pages).withColumn("depth", F.lit(depth))
    return out.select("bank", "base_root", "entry_root", "url", "path", "depth", "parent_url", "anchor_text", "place")


def _visited(now: DataFrame, seen: DataFrame | None, depth: int) -> DataFrame:
    """bank, visited: the urls that a bank has visited so far, no more than its number of pages."""
    own = now.select("bank", F.array("url").alias("visited"))
    every = own if seen is None else own.unionByName(seen)
    return written(every.groupBy("bank").agg(F.flatten(F.collect_list("visited")).alias("visited")), f"crawl-seen-{depth}")


def _followed(now: DataFrame, links: DataFrame, hub: int) -> DataFrame:
    """The frontier with its pages' links. Pages that many banks are at have their links once for each salt."""
    salts = F.ceil(F.col("banks") / hub).cast("int")
    hubs = now.groupBy(F.col("url").alias("hub")).agg(F.count("*").alias("banks")).where(F.col("banks") > hub).select("hub", salts.alias("salts"))
    at = now.join(hubs, now.url == F.col("hub"), "left").withColumn("salt", F.pmod(F.xxhash64("bank"), F.coalesce("salts", F.lit(1)))).drop("hub", "salts")
    dealt = links.join(hubs, links.page_url == F.col("hub"), "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1))).drop("hub", "salts")
    return at.withColumnRenamed("url", "page_url").join(dealt, ["page_url", "salt"])
