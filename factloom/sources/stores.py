"""Files below a path on any file system that Arrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource


def at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path on it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path on its file system, size) of a file, or of all files below a folder that end in the suffix, in order."""
    system, base = at(path)
    info = system.get_file_info(base)
    if info.type == fs.FileType.File:
        return [(base, info.size)]
    found = system.get_file_info(fs.FileSelector(base, recursive=True))
    hidden = lambda p: any(part[:1] in "._" for part in p[len(base) :].split("/") if part)
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix) and not hidden(f.path))


def register(spark: SparkSession, source: type[DataSource]) -> str:
    """Makes a source known to the session, and returns the name to use: its own, or another where the session's maker has taken that."""
    try:
        spark.dataSource.register(source)
        return source.name()
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    name = f"{source.name()}_{uuid.uuid4().hex}"
    spark.dataSource.register(type(source.__name__, (source,), {"name": classmethod(lambda cls: name)}))
    return name
