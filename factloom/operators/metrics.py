"""Metric records: flat rows, audit, diagnostics and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import text as T
from .chunks import numbered


def as_records(merged: DataFrame, key: str, topk: DataFrame | None = None) -> DataFrame:
    """Nested records: bank, year, topk, error, results in the order of the metrics, with sentinels for what is missing."""
    row = F.struct("metric_place", "metric_name", T.shown(F.col("value")).alias("value"), T.shown(F.col("unit")).alias("unit"), F.col("year").alias("fiscal_year"), T.shown(F.col("source_chunk_id")).alias("source_chunk_id"))
    out = merged.groupBy(F.col(key).alias("bank"), "year").agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r.dropFields("metric_place")).alias("results"))
    if topk is not None:
        out = out.join(topk.withColumnRenamed(key, "bank"), "bank", "left").withColumn("topk", F.coalesce("topk", F.lit(0)))
    else:
        out = out.withColumn("topk", F.lit(0))
    return out.withColumn("error", F.when(F.col("topk") == 0, "NO_HITS").otherwise(""))


def flat(records: DataFrame) -> DataFrame:
    """bank, year, metric_name, val, unit, source_chunk_id: one row for each result."""
    rows = records.select("bank", "year", F.explode("results").alias("r"))
    val, unit = T.value_and_unit(F.col("r.value"), F.col("r.unit"))
    return rows.select("bank", "year", F.coalesce("r.metric_name", F.lit("UNKNOWN")).alias("metric_name"), val.alias("val"), unit.alias("unit"), F.col("r.source_chunk_id").alias("source_chunk_id"))


def audit(rows: DataFrame) -> DataFrame:
    return rows.where(~T.is_missing(F.col("val"))).select("bank", "year", F.col("metric_name").alias("metric"), "val", "unit", F.col("source_chunk_id").alias("chunk"))


def diagnosed(records: DataFrame, year: int) -> DataFrame:
    """One row for each record: status, distinct metrics found, bad citations, metrics whose document is of another year."""
    results = F.coalesce("results", F.array().cast(records.schema["results"].dataType))
    name = lambda r: r["metric_name"]
    found = F.array_sort(F.array_distinct(F.transform(F.filter(results, lambda r: name(r).isin(V.METRICS) & ~T.is_missing(r["value"])), name)))
    bad = F.size(F.filter(results, lambda r: ~T.is_missing(r["source_chunk_id"]) & ~T.is_valid_citation(r["source_chunk_id"])))
    other = lambda stem: (stem != "") & ~F.contains(stem, F.lit(str(year))) & stem.rlike(r"\b(2020|2021|2022|2023)\b")
    mismatch = F.array_sort(F.array_distinct(F.transform(F.filter(results, lambda r: other(T.stem_of(r["source_chunk_id"]))), name)))
    missing = F.col("results").isNull()
    status = F.when(missing, "RESULTS_NOT_LIST").when(F.coalesce("error", F.lit("")) == "", "OK").otherwise("OK_WITH_ERROR")
    return records.select("bank", F.lit(year).alias("year"), "topk", status.alias("status"), F.coalesce("error", F.lit("")).alias("error"), F.size(found).alias("n_found"), F.array_join(found, ",").alias("found_metrics"), bad.alias("n_bad_cite"), F.array_join(mismatch, ",").alias("year_mismatch_metrics"), F.size(results).alias("n_results"))


def counters(diagnostics: DataFrame) -> DataFrame:
    """category, n: the categories that occur."""
    ok = F.col("status") != "RESULTS_NOT_LIST"
    tests = {
        "NO_HITS": F.col("error") == "NO_HITS", "HAS_ERROR": ~F.col("error").isin("", "NO_HITS"), "RESULTS_NOT_LIST": ~ok, "RESULTS_EMPTY": ok & (F.col("n_results") == 0),
        "FOUND_0": ok & (F.col("n_found") == 0), "FOUND_GT0": ok & (F.col("n_found") > 0), "BAD_CITE": F.col("n_bad_cite") > 0, "YEAR_MISMATCH": F.col("year_mismatch_metrics") != "",
    }
    one = diagnostics.agg(*(F.count_if(t).alias(k) for k, t in tests.items()))
    return one.unpivot([], list(tests), "category", "n").where("n > 0")


def spread(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Least, exact median and largest number for each group."""
    v = F.col(value).try_cast("double")
    return rows.where(v.isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.min(v).alias("min_value"), F.median(v).alias("median_value"), F.max(v).alias("max_value"))


def histogram(rows: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """bin, low, high, n over equal widths from least to largest; the largest is in the last bin, empty bins are left out."""
    v = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    edges = v.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    at = F.when(F.col("high") == F.col("low"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("low")) / width)))
    return v.crossJoin(F.broadcast(edges)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("largest"))


def result_lengths(records: DataFrame) -> DataFrame:
    return records.groupBy(F.coalesce(F.size("results").cast("string"), F.lit("NOT_LIST")).alias("length")).agg(F.count("*").alias("n"))


def evidence_count(hits: DataFrame, by: str = "target") -> DataFrame:
    return hits.groupBy(by).agg(F.count("*").alias("n_evidence"))


def numbered_categories(rows: DataFrame, column: str) -> DataFrame:
    """column, n, place by falling count. Categories are dealt by ranges of counts, so their number is not bounded by a task."""
    n = rows.groupBy(column).agg(F.count("*").alias("n")).withColumn("_less", -F.col("n"))
    return numbered(n, ["_less", column]).select(column, "n", (F.col("global_id") + 1).cast("int").alias("place"))
