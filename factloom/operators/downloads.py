"""The download plan of candidate PDFs: checks, types, targets, resume, and the transfer behind an interface."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from .checks import require_columns
from .external import Fetcher, fetch_all


def prepare(rows: DataFrame) -> DataFrame:
    """Required columns checked, empty status columns added, rows without a url dropped, url set."""
    require_columns(rows, ["idrssd", "username", "best_pdf_url"])
    for c in ("status", "reason", "local_path"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(""))
    return rows.withColumn("best_pdf_url", F.trim(F.coalesce("best_pdf_url", F.lit("")))).where("best_pdf_url <> ''").withColumn("url", F.col("best_pdf_url"))


def plan(rows: DataFrame, current_year: int, least_score: float = 0.0, root: str = "reports") -> DataFrame:
    """rows (url, username, idrssd, score) with pdf_type, year, status, reason, local_path: skipped, or `pending` with the target path.

    A row goes by its score only if it has one, that is under the bound, and its url has no strong hint.
    """
    url, low = F.col("url"), F.lower("url")
    given = F.col("pdf_type") if "pdf_type" in rows.columns else None
    stated = F.nullif(F.trim(F.col("year").cast("string")), F.lit("")) if "year" in rows.columns else F.lit(None).cast("string")
    year = F.coalesce(stated, T.latest_year(url, current_year).cast("string"), F.lit("unknown"))
    strong = low.rlike("annual|10-k")
    score = F.col("score").cast("double")
    weak = score.isNotNull() & ~F.isnan(score) & (score < least_score) & ~strong
    status = F.when(~F.startswith(low, F.lit("http")), "skip_invalid_url").when(weak, "skip_low_score").otherwise("pending")
    reason = F.when(F.col("status") == "skip_invalid_url", "not_http_url").when(F.col("status") == "skip_low_score", f"score<{least_score}").otherwise("")
    name = lambda c: T.slug(F.col(c).cast("string"))
    path = F.concat_ws("/", F.lit(root), T.slug(F.col("pdf_type")), F.col("year"), F.concat_ws("_", name("username"), name("idrssd")), U.file_name(url))
    out = rows.withColumn("pdf_type", U.pdf_type(url, F.col("username"), given)).withColumn("year", year).withColumn("status", status).withColumn("reason", reason)
    return out.withColumn("local_path", F.when(F.col("status") == "pending", path).otherwise(""))


def resume(planned: DataFrame, done: DataFrame) -> DataFrame:
    """Pending rows whose target exists (done: local_path, size) and isn't empty are a success already."""
    there = done.where("size > 0").select("local_path").distinct().withColumn("_there", F.lit(True))
    out = planned.join(there, "local_path", "left")
    exists = F.col("_there") & (F.col("status") == "pending")
    return out.withColumn("reason", F.when(exists, "exists").otherwise(F.col("reason"))).withColumn("status", F.when(exists, "success").otherwise(F.col("status"))).drop("_there")


def download(planned: DataFrame, fetcher: Fetcher, wait=time.sleep) -> DataFrame:
    """url, ok, reason, content of the pending rows, through a client."""
    return fetch_all(planned.where("status = 'pending'").select("url"), fetcher, wait=wait)


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "status")
