"""Incremental ingest: text files that arrive become chunks once. The batch pipeline's resume markers are the stream's checkpoint here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunks import chunked


def text_stream(spark: SparkSession, root: str, files_at_once: int = 1000) -> DataFrame:
    raw = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", files_at_once).text(f"{root}/*/*.txt")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return raw.select(F.element_at(parts, -2).alias("bank_folder"), F.regexp_replace(F.element_at(parts, -1), r"\.txt$", "").alias("source_txt"), F.col("value").alias("text"))


def chunk_stream(texts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Chunks of all files that are there now, appended as Parquet, each file exactly once over all runs."""
    made = chunked(texts, ["bank_folder", "source_txt"])
    return made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, time: str = "ts", by: str = "event_type", late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events per window and type; rows later than the watermark are dropped when events is a stream."""
    out = events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), by, "n")
