"""Retrieval: entity matching, year preference, pooling, thresholds, neighbours, context.

Hits are rows with bank, stem, chunk_id, text, score and, where several queries meet, query_id and rank.
Rank windows come before entity filters on purpose: the filters apply to global ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import text as T

KEY = ["bank", "stem", "chunk_id"]


def entity_key(name: Column, bare: bool = False) -> Column:
    out = F.lower(F.trim(name))
    return F.regexp_replace(out, "^_+", "") if bare else out


def same_entity(a: Column, b: Column, bare: bool = False, least: int = 8) -> Column:
    """Equal, one the start of the other, or one within the other if that has `least` characters."""

    def same(k: Column) -> Column:
        x, y = k["x"], k["y"]
        return (x != "") & (y != "") & (F.startswith(x, y) | F.startswith(y, x) | (F.contains(x, y) & (F.length(y) >= least)) | (F.contains(y, x) & (F.length(x) >= least)))

    # the keys are bound once, or the generated code would hold each of them many times
    return F.transform(F.array(F.struct(entity_key(a, bare).alias("x"), entity_key(b, bare).alias("y"))), same)[0]


def entity_pairs(left: DataFrame, right: DataFrame, a: str, b: str, bare: bool = False, least: int = 8) -> DataFrame:
    """All rows of two lists whose names are the same entity by `same_entity`, found by equality joins alone: names are compared only if they share what they must share."""
    x = left.select(entity_key(F.col(a), bare).alias("x")).where("x <> ''").distinct()
    y = right.select(entity_key(F.col(b), bare).alias("y")).where("y <> ''").distinct()
    same = contained(x, y, "x", "y", least).union(contained(y, x, "y", "x", least).select("x", "y")).distinct()
    own = left.withColumn("_x", entity_key(F.col(a), bare)).join(same, F.col("_x") == F.col("x")).drop("_x", "x")
    return own.join(right.withColumn("_y", entity_key(F.col(b), bare)), F.col("y") == F.col("_y")).drop("_y", "y")


def grams(text: Column, q: int) -> Column:
    """The distinct stretches of q characters."""
    return F.when(F.length(text) >= q, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - q + 1), lambda i: F.substring(text, i, F.lit(q))))).otherwise(F.array().cast("array<string>"))


def contained(needles: DataFrame, hays: DataFrame, n: str, h: str, least: int = 8) -> DataFrame:
    """(n, h): a needle starts a hay, or stands in it if it has `least` characters. Both are distinct.

    A short needle equals one of the hay's first stretches. A longer one must share each of its stretches of `least`
    characters; an index of all hays' stretches is asked for the one that fewest hays have, and only those are compared.
    """
    short, long = needles.where(F.length(n) < least), needles.where(F.length(n) >= least)
    starts = F.transform(F.sequence(F.lit(1), F.least(F.length(h), F.lit(least - 1))), lambda i: F.left(F.col(h), i))
    found = short.join(hays.select(h, F.explode(starts).alias("_start")), F.col(n) == F.col("_start")).select(n, h)
    index = hays.select(h, F.explode(grams(F.col(h), least)).alias("_gram"))
    often = index.groupBy("_gram").agg(F.count("*").alias("_hays"))
    own = long.select(n, F.explode(grams(F.col(n), least)).alias("_gram")).join(often, "_gram", "left")
    # a needle with a stretch that no hay has is in none
    rare = own.groupBy(n).agg(F.min_by("_gram", F.struct("_hays", "_gram")).alias("_gram"), F.count_if(F.col("_hays").isNull()).alias("_none")).where("_none = 0").drop("_none")
    return found.union(rare.join(index, "_gram").where(F.contains(F.col(h), F.col(n))).select(n, h))


def canonical(asked: DataFrame, known: DataFrame) -> DataFrame:
    """asked (name) with the first known (name, place) that equals it but for case and outer blanks; itself without one."""
    first = known.groupBy(entity_key(F.col("name")).alias("k")).agg(F.min_by("name", "place").alias("canonical"))
    return asked.join(first, entity_key(asked.name) == first.k, "left").select(asked.name, F.coalesce("canonical", asked.name).alias("canonical"))


def prefer_year(hits: DataFrame, year: int, by: list[str]) -> DataFrame:
    """Within each group the hits whose stem names the year; all of them where none does."""
    stem = F.coalesce(F.col("stem").cast("string"), F.lit(""))
    named = F.contains(stem, F.lit(str(year))) | F.contains(stem, F.lit(f"FY{str(year)[-2:]}")) | F.contains(stem, F.lit("12-31-24"))
    any_named = F.max("_named").over(Window.partitionBy(*by))
    return hits.withColumn("_named", named).withColumn("_any", any_named).where(F.col("_named") | ~F.col("_any")).drop("_named", "_any")


def first_of_key(hits: DataFrame, order: list, by: list[str] | None = None) -> DataFrame:
    """One hit for each chunk (and group): the first to arrive."""
    w = Window.partitionBy(*(by or []), *KEY).orderBy(*order)
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def floored(hits: DataFrame, least: float, enough: int, by: list[str]) -> DataFrame:
    """Only scores of `least` or more, if `enough` hits have that; else all."""
    strong = F.count_if(F.col("score") >= least).over(Window.partitionBy(*by))
    return hits.withColumn("_strong", strong).where((F.col("_strong") < enough) | (F.col("score") >= least)).drop("_strong")


def laddered(hits: DataFrame, least: Column, by: list[str], step: float = 0.05) -> DataFrame:
    """Scores of `least` or more; without any, those within a step below; without any, all."""
    best = F.max("score").over(Window.partitionBy(*by))
    tier = F.when(F.col("_best") >= least, least).when(F.col("_best") >= least - step, least - step).otherwise(F.lit(float("-inf")))
    return hits.withColumn("_best", best).where(F.col("score") >= tier).drop("_best")


def top_n(hits: DataFrame, n: Column | int, by: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def bank_of_best(hits: DataFrame, by: str = "query_id", most: int = 20) -> DataFrame:
    """Only hits of the best hit's bank, `most` at the most."""
    bank = F.first("bank").over(Window.partitionBy(by).orderBy("rank"))
    return top_n(hits.withColumn("_bank", bank).where(F.col("bank") == F.col("_bank")).drop("_bank"), most, [by], ["rank"])


def with_neighbours(hits: DataFrame, chunks: DataFrame, window: int, by: list[str]) -> DataFrame:
    """Hits, then the chunks up to `window` away in the same document, a little below their hit's score; each chunk once, originals first.

    Offsets are exploded and joined by equality, which needs no range join. `place` is the order within a group.
    """
    offsets = F.array(*[F.lit(d) for d in range(-window, window + 1) if d])
    own = hits.select(*by, *KEY, "text", "score", F.col("place").alias("_hit"), F.lit(0).alias("_far"))
    near = hits.select(*by, "bank", "stem", F.col("chunk_id").alias("_of"), "score", F.col("place").alias("_hit"), F.explode(offsets).alias("_far"))
    near = near.withColumn("chunk_id", F.col("_of") + F.col("_far")).join(chunks.select(*KEY, "text"), KEY)
    near = near.select(*by, *KEY, "text", (F.col("score") - 1e-6).alias("score"), "_hit", "_far")
    both = own.withColumn("_kind", F.lit(0)).unionByName(near.withColumn("_kind", F.lit(1)))
    once = first_of_key(both, ["_kind", "_hit", "_far"], by)
    order = Window.partitionBy(*by).orderBy("_kind", "_hit", "_far")
    return once.withColumn("place", F.row_number().over(order)).drop("_kind", "_hit", "_far")


def context(hits: DataFrame, by: list[str]) -> DataFrame:
    """One text for each group: a header with the citation, rank and score, and the text of each hit, in order. Hits are capped before, so a group is small."""
    head = F.concat(T.citation(F.col("bank"), F.col("stem"), F.col("chunk_id")), F.lit("\n"), F.format_string("(rank=%d score=%.4f)", F.col("place"), F.col("score").cast("double")), F.lit("\n"))
    block = F.concat(head, T.evidence_text(F.coalesce("text", F.lit(""))))
    parts = F.array_sort(F.collect_list(F.struct(F.col("place"), block.alias("block"))))
    return hits.groupBy(*by).agg(F.array_join(F.transform(parts, lambda p: p["block"]), V.BLOCK_BREAK).alias("context"), F.count("*").alias("n_blocks"))


def wants(spark: SparkSession) -> DataFrame:
    """Per metric its parameters: hits wanted in the pool, hits asked of a query, hits kept, blocks shown, threshold."""
    ratio = {"ROA", "ROE"}
    rows = [(m, 12 if m == "NIM" else 10, 60 if m in ratio else 40, 40 if m in ratio else 8, 12 if m in ratio else 8, 0.47 if m in ratio else 0.5) for m in V.METRICS]
    return spark.createDataFrame(rows, "metric string, pool int, asked int, kept int, shown int, least double")


def metric_queries(spark: SparkSession, banks: list[str] | DataFrame, year: int) -> DataFrame:
    """target, metric, query_id, place, text of the query bank for each bank of a list or a table (target)."""
    targets = banks if isinstance(banks, DataFrame) else spark.createDataFrame([(b,) for b in banks], "target string")
    rows = [(m, i, q.format(bank="{bank}", year=year)) for m, qs in V.QUERY_BANK.items() for i, q in enumerate(qs)]
    asked = targets.select("target").crossJoin(F.broadcast(spark.createDataFrame(rows, "metric string, place int, text string")))
    return asked.select("target", "metric", F.concat_ws("|", "target", "metric", F.col("place").cast("string")).alias("query_id"), "place", F.replace("text", F.lit("{bank}"), F.col("target")).alias("text"))


def pooled(ranked: DataFrame, chunks: DataFrame, year: int, least: float = 0.5, most: int = 20) -> DataFrame:
    """Hits of one query per metric (target, metric, arrival, rank, hits' columns) in one pool for each target, with direct neighbours."""
    own = prefer_year(ranked, year, ["target", "metric"])
    own = first_of_key(own, ["arrival", "rank"], ["target"])
    own = floored(own, least, 3, ["target"])
    own = top_n(own, most, ["target"], [F.desc("score"), "arrival", "rank"])
    return with_neighbours(own, chunks, 1, ["target"])


def one_query_each(ranked: DataFrame, year: int, want: int = 8, least: float = 0.5) -> DataFrame:
    """The older retrieval: for each target and metric the hits of its one query, of the year where any is, with `least` or more where any has that."""
    by = ["target", "metric"]
    own = top_n(ranked, want, by, ["rank"])
    return laddered(prefer_year(own, year, by), F.lit(least), by, step=0.0).drop("place")


def per_metric(ranked: DataFrame, chunks: DataFrame, parameters: DataFrame, by_chunk_alone: bool = False) -> DataFrame:
    """Hits of several queries per metric (target, metric, place of the query, rank) with the metric's threshold, cap and neighbours two chunks around.

    Chunks are told apart by their whole key; with by_chunk_alone by their number only, and chunk 0 is lost, as older results have it.
    """
    by = ["target", "metric"]
    own = ranked.join(F.broadcast(parameters), "metric").where(F.col("rank") <= F.col("asked"))
    own = laddered(own.where(same_entity(F.col("bank"), F.col("target"), bare=True)), F.col("least"), by)
    own, order = own.withColumnRenamed("place", "query_place"), [F.desc("score"), "query_place", "rank"]
    own = top_n(own.where("chunk_id <> 0"), 1, [*by, "chunk_id"], order).drop("place") if by_chunk_alone else first_of_key(own, order, by)
    own = top_n(own, F.col("kept"), by, [F.desc("score"), "query_place", "rank"])
    return with_neighbours(own, chunks, 2, by)


def evidence(hits: DataFrame, parameters: DataFrame) -> DataFrame:
    """What a model is shown: the first blocks of each metric, up to its number."""
    return hits.join(F.broadcast(parameters.select("metric", "shown")), "metric").where(F.col("place") <= F.col("shown")).drop("shown")
