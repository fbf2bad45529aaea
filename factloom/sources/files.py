"""Readers and writers, all through Spark, so that any file system it knows will do."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import stores
from .scratch import bounded

BANKS = "idrssd string, username string, url string, `financial report` string, `financial report link` string"
CHUNKS = "year string, bank_folder string, source_txt string, chunk_id int, char_start int, char_end int, text string"
METRICS = "bank string, year string, metric_name string, val string, unit string, source_chunk_id string"
RULES = "positive_rules array<struct<tag:string,keywords:array<string>,weight:int>>, negative_keywords array<string>, negative_penalty int, score_thresholds struct<HIGH:int,MEDIUM:int,LOW:int>, crawl struct<max_depth:int,max_pages_per_bank:int>"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header line, quoted fields over several lines, with or without a byte-order mark."""
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"', enforceSchema=True)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """place, tag, keyword, points of a rules file."""
    raw = spark.read.schema(RULES).json(path, multiLine=True)
    positive = raw.select(F.posexplode("positive_rules").alias("rule", "r")).select("rule", "r.*").select("rule", F.posexplode("keywords").alias("i", "keyword"), "tag", F.col("weight").alias("points"))
    negative = raw.select(F.lit(1 << 20).alias("rule"), F.posexplode("negative_keywords").alias("i", "keyword"), F.lit("NEG").alias("tag"), (-F.coalesce("negative_penalty", F.lit(3))).alias("points"))
    return positive.unionByName(negative).select((F.col("rule") * 1000 + F.col("i")).alias("place"), "tag", "keyword", "points")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The fields of the schema and global_id, the row's place in file order: by path, then by line.

    Lines are numbered within a split; counts of the splits, a row each, give the offsets.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    lines = raw.where(F.trim("value") != "")
    counts = lines.groupBy("_path", "_block").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_path", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_path", "_block").orderBy("_line"))
    return lines.withColumn("_own", own).join(offsets, ["_path", "_block"]).select(F.from_json("value", schema).alias("r"), (F.col("_before") + F.col("_own") - 1).alias("global_id")).select("r.*", "global_id")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: lines without white space at their ends, those that are blank left out."""
    return spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("value")).where("value <> ''")


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """bank_folder, source_txt, text of root/<folder>/*.txt; loose files in root are left out."""
    raw = spark.read.text(f"{root}/*/*.txt", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    parts = F.split("path", "/")
    return raw.select(F.element_at(parts, -2).alias("bank_folder"), F.regexp_replace(F.element_at(parts, -1), r"\.txt$", "").alias("source_txt"), F.col("value").alias("text"))


def read_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """path, bank_folder, length, content of root/<folder>/*.pdf. Content is read only where a plan uses it.

    The driver lists the folders, tasks list the files in them; on a file system that only Spark knows the driver lists all.
    """
    try:
        system, base = stores.at(root)
    except pa.ArrowInvalid:
        raw = spark.read.format("binaryFile").load(f"{root}/*/*.pdf")
        return raw.select("path", F.element_at(F.split("path", "/"), -2).alias("bank_folder"), "length", "content")
    shown = lambda name: name[:1] not in ("_", ".")
    folders = [f.base_name for f in system.get_file_info(fs.FileSelector(base)) if f.type == fs.FileType.Directory and shown(f.base_name)]

    def listed(batches):
        system, base = stores.at(root)
        for b in batches:
            for folder in b.column("folder").to_pylist():
                found = system.get_file_info(fs.FileSelector(f"{base}/{folder}"))
                own = [f for f in found if f.type == fs.FileType.File and f.base_name.endswith(".pdf") and shown(f.base_name)]
                for a in range(0, len(own), 10_000):
                    part = own[a : a + 10_000]
                    columns = [pa.array([f.path for f in part], pa.string()), pa.array([folder] * len(part), pa.string()), pa.array([f.size for f in part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "bank_folder", "length"])

    @F.arrow_udf("binary")
    def content(paths: pa.Array) -> pa.Array:
        system, _ = stores.at(root)
        out = []
        for path in paths.to_pylist():
            with system.open_input_stream(path) as f:
                out.append(f.read())
        return pa.array(out, pa.binary())

    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(max(1, min(len(folders), n)), "folder")
    rows = rows.mapInArrow(listed, "path string, bank_folder string, length long").repartition(n)
    return bounded(rows, 16).withColumn("content", content("path"))


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header line; with bom its first field begins with a byte-order mark, as spreadsheets like it."""
    out = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0]) if bom else df
    out.write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_texts(df: DataFrame, path: str, key: str = "bank", text: str = "context") -> None:
    """A folder of text files for each key: contexts and answers for inspection."""
    df.select(F.col(key).cast("string").alias("_key"), text).write.mode("overwrite").partitionBy("_key").option("lineSep", "\n\n").text(path)


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Writes rows of path (below root) and content, and returns path and size. Any file system that Arrow knows; a task that runs again writes the same files."""
    import pandas as pd

    def run(batches):
        system, base = stores.at(root)
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                system.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{path}") as out:
                    out.write(bytes(content))
            yield pd.DataFrame({"path": pdf["path"], "size": [len(c) for c in pdf["content"]]})

    return files.where("content is not null").select("path", "content").mapInPandas(run, "path string, size long")


def matrix_files(vectors: DataFrame, key: str, order: str) -> DataFrame:
    """path and content of a .npy file of 32-bit floats for each key, its rows in order."""
    import io

    import numpy as np
    import pandas as pd

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        np.save(out, np.array(pdf.sort_values(order)["embedding"].tolist(), np.float32))
        return pd.DataFrame({"path": [f"{pdf[key].iloc[0]}.npy"], "content": [out.getvalue()]})

    return vectors.select(key, order, "embedding").groupBy(key).applyInPandas(one, "path string, content binary")


def scratch(spark: SparkSession) -> str:
    """A folder for written tables: spark.checkpoint.dir, or in local mode a temporary one."""
    import tempfile
    import uuid

    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        at = tempfile.gettempdir()
    return f"{at}/factloom-{uuid.uuid4().hex}"


def resolved(root: str, path: str) -> str:
    """path as it is where it is absolute or has a scheme, else below root."""
    return path if path.startswith("/") or "://" in path or path.startswith("file:") else f"{root.rstrip('/')}/{path}"


def resolved_path(root: str, path: Column) -> Column:
    """`resolved` for a column of paths."""
    return F.when(path.rlike("^/|://|^file:"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def limited(rows: DataFrame, most: int | None, order: list[str]) -> DataFrame:
    """The first `most` rows in order; all without a number. For inputs of which a run shall take a part, as asked."""
    return rows if most is None else rows.orderBy(*order).limit(most)
