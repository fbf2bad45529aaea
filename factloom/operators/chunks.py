"""Chunking of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import clean_text
from ..sources.files import scratch
from ..sources.scratch import bounded


def starts(length: Column, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP, most: int = V.MAX_CHUNKS) -> Column:
    """Start of each chunk: every step under the length, so that the last chunk may lie within the one before."""
    step = size - overlap
    return F.when(length > 0, F.slice(F.sequence(F.lit(0), length - 1, F.lit(step)), 1, most)).otherwise(F.array().cast("array<int>"))


def count_chunks(length: Column, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP, most: int = V.MAX_CHUNKS) -> Column:
    return F.least(F.ceil(length / (size - overlap)), F.lit(most)).cast("int")


def _cut(texts: DataFrame, keys: list[str], size: int) -> DataFrame:
    """keys, chunk_id, char_start, char_end, text for texts with an array `at` of starts. One pass over each text: taking a part by Spark's expressions walks from the text's beginning each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made, held = [], [], 0
            for k, (text, at) in enumerate(zip(batch.column("text"), batch.column("at"), strict=True)):
                text = text.as_py()
                for i, a in enumerate(at.as_py()):
                    part = text[a : a + size]
                    rows.append(k)
                    made.append((i, a, a + len(part), part))
                    held += len(part)
                    if held > 8 << 20:
                        yield pack(batch, rows, made)
                        rows, made, held = [], [], 0
            yield pack(batch, rows, made)

    def pack(batch: pa.RecordBatch, rows: list[int], made: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string())
        fields = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows, pa.int64())) for c in keys), *fields], [*keys, "chunk_id", "char_start", "char_end", "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keys).schema.fields)
    return bounded(texts.select(*keys, "text", "at")).mapInArrow(run, f"{fields}, chunk_id int, char_start int, char_end int, text string")


def chunked(texts: DataFrame, keys: list[str], size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP, least: int = V.MIN_CHARS, most: int = V.MAX_CHUNKS) -> DataFrame:
    """keys, chunk_id, char_start, char_end, text for each chunk of the cleaned texts of `least` characters or more."""
    # bound once, so that a text is cleaned once
    clean = texts.select(*keys, F.explode(F.array(clean_text(F.col("text")))).alias("text")).where(F.length("text") >= least)
    return _cut(clean.withColumn("at", starts(F.length("text"), size, overlap, most)), keys, size)


def log(texts: DataFrame, keys: list[str], least: int = V.MIN_CHARS) -> DataFrame:
    """keys, num_chars, num_chunks, status, error: too short texts fail here and nowhere else."""
    n = F.length(F.coalesce(clean_text(F.col("text")), F.lit("")))
    short = n < least
    return texts.select(*keys, n.alias("num_chars"), F.when(short, 0).otherwise(count_chunks(n)).alias("num_chunks"), F.when(short, "fail").otherwise("success").alias("status"), F.when(short, "text_too_short").otherwise("").alias("error"))


def window_starts(length: Column, window: int = 300_000, most: int | None = 6) -> Column:
    """Starts of windows that cover a long text: head, middle, tail and evenly between them. Without `most` as many as leave no gap."""
    last = F.greatest(length - window, F.lit(0))
    steps = F.lit(most - 1) if most is not None else F.greatest(F.ceil(length / window).cast("int") - 1, F.lit(1))
    even = F.transform(F.sequence(F.lit(0), steps), lambda i: F.floor(last.cast("long") * i / steps).cast("int"))
    many = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), F.floor(last / 2).cast("int"), last), even)))
    return F.when(length <= window, F.array(F.lit(0))).otherwise(many if most is None else F.slice(many, 1, 2 * most))


def covered(texts: DataFrame, keys: list[str], window: int = 300_000, windows: int | None = 6, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP, most: int | None = 3000) -> DataFrame:
    """Chunks of the windows of long texts, each start once, at most `most` for each text (the mode's limit).

    With the mode's own numbers what lies between six windows of a text of over 1.8 million characters, and what comes after
    3000 chunks, is left out; without numbers (None for windows and most) every character is in a chunk.
    """
    n = F.length("text")
    inner = F.transform(window_starts(n, window, windows), lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.least(F.lit(window), n - w) - 1, F.lit(0)), F.lit(size - overlap)), lambda s: (w + s).cast("int")))
    at = F.array_sort(F.array_distinct(F.flatten(inner)))
    at = at if most is None else F.slice(at, 1, most)
    return _cut(texts.where(n > 0).select(*keys, "text", at.alias("at")), keys, size)


def numbered(chunks: DataFrame, order: list[str]) -> DataFrame:
    """global_id by the columns of order: rows are dealt by range, numbered in their range, and the ranges' counts give the offsets. No task gets all rows of a key."""
    spark = chunks.sparkSession
    at = scratch(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = chunks.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_line", F.monotonically_increasing_id())
    ranged.write.parquet(at)  # the ranges are drawn from a sample, so they must not be worked out twice
    rows = spark.read.parquet(at).withColumn("_range", F.shiftrightunsigned("_line", 33))
    counts = {r._range: r.n for r in rows.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    offsets, before = [F.lit(0), F.lit(0)], 0
    for r in sorted(counts):
        offsets += [F.lit(r), F.lit(before)]
        before += counts[r]
    return rows.withColumn("global_id", F.create_map(*offsets[2:] or offsets)[F.col("_range")].cast("long") + F.col("_line").bitwiseAND(F.lit((1 << 33) - 1))).drop("_line", "_range")
