"""Pages: links, rule scores, levels, PDF analysis, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import markup as M
from ..functions import urls as U
from . import keywords as K

def links(pages: DataFrame, key: str = "page_id", with_base: bool = False) -> DataFrame:
    """key, page_url, position, url (resolved), text of every link of a page, in page order.

    A tokenizer reads the markup in Arrow batches, the rest is built in. Links are resolved against the page's url; with_base
    against its base element where it has one.
    """
    if with_base:
        read = pages.select(key, F.col("url").alias("page_url"), M.page_links(F.col("html"), True).alias("read"))
        read = read.select(key, "page_url", "read.links", U.joined(F.col("page_url"), F.coalesce("read.base", F.lit(""))).alias("_from"))
        read = read.select(key, "page_url", "_from", F.posexplode("links").alias("position", "link"))
    else:
        read = pages.select(key, F.col("url").alias("page_url"), F.posexplode(M.page_links(F.col("html"))).alias("position", "link")).withColumn("_from", F.col("page_url"))
    return read.select(key, "page_url", "position", U.joined(F.col("_from"), F.col("link.href")).alias("url"), F.col("link.text").alias("text"))


def keyword_points(spark: SparkSession, rules=None, negatives=None, penalty: int = V.NEGATIVE_PENALTY) -> DataFrame:
    """The rules as rows: place, tag (NEG for negative ones), keyword, points. A parameter table of bounded size."""
    rows = [(tag, kw, weight) for tag, weight, words in (rules or V.RULES) for kw in words]
    rows += [("NEG", kw, -penalty) for kw in (negatives or V.NEGATIVE_KEYWORDS)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "place int, tag string, keyword string, points int")


def matched_rules(url: Column, words: Column, rules=None, negatives=None, penalty: int = V.NEGATIVE_PENALTY) -> Column:
    """Array of (tag, keyword, points) of the keywords in the url or the words, in rule order. No join and no shuffle: the rules are literals."""
    rows = [(tag, kw, weight) for tag, weight, kws in (rules or V.RULES) for kw in kws] + [("NEG", kw, -penalty) for kw in (negatives or V.NEGATIVE_KEYWORDS)]
    every = F.array(*(F.struct(F.lit(tag).alias("tag"), F.lit(kw).alias("keyword"), F.lit(p).alias("points")) for tag, kw, p in rows))
    # url and words are bound once; the rules are one literal, so the generated code doesn't grow with them
    bound = F.transform(F.array(F.struct(F.lower(url).alias("u"), F.lower(words).alias("w"))), lambda b: F.filter(every, lambda r: F.contains(b["u"], F.lower(r["keyword"])) | F.contains(b["w"], F.lower(r["keyword"]))))
    return bound[0]


def level(score: Column) -> Column:
    out = None
    for name, least in V.LEVELS:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out


def score_pages(pages: DataFrame, anchor: str | None = None) -> DataFrame:
    """pages with page_title, score, level, tags (sorted, `;`), reasons (rule order, `;`)."""
    title = M.page_title(F.col("html"))
    words = F.concat_ws(" ", F.coalesce(F.col(anchor), F.lit("")) if anchor else F.lit(""), F.coalesce(title, F.lit("")))
    hit = pages.withColumn("page_title", title).withColumn("_hits", matched_rules(F.col("url"), words))
    score = F.aggregate("_hits", F.lit(0), lambda a, h: a + h["points"])
    positive = F.filter("_hits", lambda h: h["tag"] != "NEG")
    return (
        hit.withColumn("score", score).withColumn("level", level(F.col("score")))
        .withColumn("tags", F.array_join(F.array_sort(F.array_distinct(F.transform(positive, lambda h: h["tag"]))), ";"))
        .withColumn("reasons", F.array_join(F.transform("_hits", lambda h: F.concat_ws("::", h["tag"], h["keyword"])), ";"))
        .drop("_hits")
    )


def score_by_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, score, n_hits, tags (sorted, `;`), reasons (rule order, `;`) of the pages that any rule (place, tag, keyword, points) fits, for rules that come as data, however many."""
    hit = K.matched_rules(pages, rules, "page_id", F.col("url"), M.page_title(F.col("html")))
    one = hit.select("page_id", F.explode("hits").alias("h")).select("page_id", "h.*")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat_ws("::", "tag", "keyword").alias("reason")))), lambda r: r["reason"])
    tags = F.array_sort(F.collect_set(F.when(F.col("tag") != "NEG", F.col("tag"))))
    return one.groupBy("page_id").agg(F.sum("points").alias("score"), F.count("*").alias("n_hits"), F.array_join(tags, ";").alias("tags"), F.array_join(ordered, ";").alias("reasons"))


def pdf_links(found: DataFrame) -> DataFrame:
    """The report PDFs among links, with years, is_10k and score."""
    url, text = F.col("url"), F.col("text")
    return found.where(U.is_report_pdf(url, text)).withColumn("years", F.array_join(U.link_years(url, text), ", ")).withColumn("is_10k", U.is_10k(url, text)).withColumn("score", U.pdf_score(url, text))


def best_pdfs(found: DataFrame, key: str = "page_id") -> DataFrame:
    """Per page the number of report PDFs and the best one; of equal scores the first."""
    best = F.max_by(F.struct("url", "score", "years", "is_10k", "text"), F.struct(F.col("score"), -F.col("position")))
    out = pdf_links(found).groupBy(key).agg(F.count("*").alias("pdf_count_on_page"), best.alias("b"))
    return out.select(key, "pdf_count_on_page", F.col("b.url").alias("best_pdf_url"), F.col("b.score").alias("best_pdf_score"), F.col("b.years").alias("best_pdf_years"), F.when(F.col("b.is_10k"), "YES").otherwise("NO").alias("best_pdf_is_10k"), F.col("b.text").alias("best_pdf_anchor"))


def candidates(pages: DataFrame) -> DataFrame:
    """Pages with a report PDF, a positive score or a tag: what is kept for download."""
    scored, best = score_pages(pages), best_pdfs(links(pages))
    out = scored.drop("html").join(best, "page_id", "left").fillna({"pdf_count_on_page": 0, "best_pdf_score": 0, "best_pdf_url": "", "best_pdf_years": "", "best_pdf_is_10k": "", "best_pdf_anchor": ""})
    return out.where((F.col("pdf_count_on_page") > 0) | (F.col("score") > 0) | (F.col("tags") != "")).withColumn("level", F.coalesce("level", F.lit("")))


def best_of_duplicates(found: DataFrame, key: str = "url", score: str = "score", order: str = "position") -> DataFrame:
    """One row per key: the best score, of equal ones the first. A partial aggregation, no sort."""
    best = F.max_by(F.struct(*found.columns), F.struct(F.col(score), -F.col(order)))
    return found.groupBy(F.col(key).alias("_key")).agg(best.alias("b")).select("b.*")
