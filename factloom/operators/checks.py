"""Checks of tables and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n not in df.columns]


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def complete_shards(vectors: DataFrame, metadata: DataFrame, markers: DataFrame, key=("bank_folder", "stem")) -> DataFrame:
    """Shards of vectors that have metadata and a done marker."""
    key = list(key)
    return vectors.select(*key).distinct().join(metadata.select(*key), key, "left_semi").join(markers.select(*key), key, "left_semi")


def shard_counts(vectors: DataFrame, metadata: DataFrame, key=("bank_folder", "stem")) -> DataFrame:
    """Rows of vectors and of metadata for each shard on either side, and whether they agree."""
    key = list(key)
    left = vectors.groupBy(*key).agg(F.count("*").alias("num_vec"))
    right = metadata.groupBy(*key).agg(F.count("*").alias("num_meta"))
    out = left.join(right, key, "full_outer").fillna(0, ["num_vec", "num_meta"])
    return out.withColumn("status", F.when(F.col("num_vec") == F.col("num_meta"), "ok").otherwise("mismatch"))


def shard_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("items"), F.count_if(F.col("status") != "ok").alias("bad"))


def sizes(index: DataFrame, metadata: DataFrame, by: list[str]) -> DataFrame:
    """n_vectors and n_metadata of each group on either side, and whether they agree."""
    a, b = index.groupBy(*by).agg(F.count("*").alias("n_vectors")), metadata.groupBy(*by).agg(F.count("*").alias("n_metadata"))
    out = a.join(b, by, "full_outer").fillna(0, ["n_vectors", "n_metadata"])
    return out.withColumn("agrees", F.col("n_vectors") == F.col("n_metadata"))


def same_size(index: DataFrame, metadata: DataFrame) -> None:
    """An error where an index and its metadata have other numbers of rows."""
    one = [F.lit(0).alias("all")]
    bad = sizes(index.select(*one), metadata.select(*one), ["all"]).where("NOT agrees").first()
    if bad:
        raise ValueError(f"index has {bad.n_vectors} rows, metadata {bad.n_metadata}")


def stages_of(year: int) -> dict[str, list[str]]:
    """Name patterns of each stage's artifacts, the preferred one first."""
    return {
        "entry_pages": [r"(^|/)entry_pages\.csv$", r"(^|/)[^/]*entry[^/]*pages[^/]*\.csv$", r"(^|/)[^/]*links[^/]*\.csv$"],
        "reports": [r"\.pdf$"], "texts": [r"\.txt$"], "vectors": [r"\.(npy|npz|pt)$"],
        "index": [r"(^|/)meta\.jsonl$", r"\.(faiss|index|bin)$"],
        "extractions": [rf"(^|/)extractions_{year}\.jsonl$", rf"(^|/)[^/]*extract[^/]*{year}[^/]*\.jsonl$"],
        "metrics": [rf"(^|/)metrics_{year}\.csv$", rf"(^|/)[^/]*(metrics|kpi|results)[^/]*{year}[^/]*\.csv$"],
    }


def validated(files: DataFrame, year: int) -> DataFrame:
    """stage, n_files, path, status of each stage: its file of the first pattern that has one, the shortest path, then by name; `empty` for one of no bytes. files: path, size.

    One pass: each stage is an aggregate.
    """
    out = []
    for stage, patterns in stages_of(year).items():
        rank = F.coalesce(*(F.when(F.col("path").rlike(p), F.lit(i)) for i, p in enumerate(patterns)))
        best = F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.length("path").alias("n"), "path", "size")))
        out.append(F.struct(F.lit(stage).alias("stage"), F.count(rank).alias("n_files"), best.alias("best")))
    rows = files.agg(F.array(*out).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    status = F.when(F.col("best").isNull(), "missing").when(F.col("best.size") == 0, "empty").otherwise("ok")
    return rows.select("stage", "n_files", F.col("best.path").alias("path"), status.alias("status"))


def artifacts(files: DataFrame, stages: dict[str, str], most: int | None = 200_000) -> DataFrame:
    """stage, n_files (capped for display; None: not), first_path (shortest, then by name), present. files: path; stages: name -> pattern."""
    out = None
    for stage, pattern in stages.items():
        found = files.where(F.col("path").rlike(pattern)).agg((F.count("*") if most is None else F.least(F.count("*"), F.lit(most))).alias("n_files"), F.min(F.struct(F.length("path").alias("n"), "path")).alias("p"))
        row = found.select(F.lit(stage).alias("stage"), "n_files", F.col("p.path").alias("first_path"), (F.col("n_files") > 0).alias("present"))
        out = row if out is None else out.unionByName(row)
    return out


def pending(items: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Items without a done row."""
    return items.join(done, key, "left_anti")


def with_status(items: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """All items, `skip` where done and `todo` elsewhere."""
    marked = done.select(*key).distinct().withColumn("_done", F.lit(True))
    return items.join(marked, key, "left").withColumn("status", F.when(F.col("_done"), "skip").otherwise("todo")).drop("_done")
