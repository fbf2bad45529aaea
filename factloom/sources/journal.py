"""Files that are written once and whole: a sink with staging, commit and a journal.

Rows (path, content) become files below a root. Each task attempt writes to a folder of its own under `_staging`; when all
tasks are done the driver moves what the successful attempts report to its place and writes one journal file, last. What
failed or repeated attempts left goes with the job's staging folder (a task that outlives its job's end may leave some
there, which nothing reads). A path that is there already is replaced by the move, never
written over in parts, and a run that stops before the journal is repeated from the start without harm.

`committed` reads the journals, so a rerun asks only for what is not in them (`pending`).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import stores

#: Moves at a time.
MOVERS = 16


@dataclass
class Written(WriterCommitMessage):
    """What an attempt has written: (path below the root, where it is staged, bytes)."""

    files: list[tuple[str, str, int]]


def below(path: str) -> str:
    """A path below the root; an error for one that leads out of it."""
    if path.startswith("/") or ".." in path.split("/") or path.startswith("_") or not path.strip("/"):
        raise ValueError(f"not a path below the root: {path}")
    return path


class JournalWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.job = root, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, base = stores.at(self.root)
        context = TaskContext.get()
        folder = f"{base}/_staging/{self.job}/{context.partitionId()}-{context.taskAttemptId()}"
        system.create_dir(folder, recursive=True)
        out = []
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                if content.is_valid:
                    staged, body = f"{folder}/{len(out)}", content.as_buffer()
                    with system.open_output_stream(staged) as f:
                        f.write(body)
                    out.append((below(path.as_py()), staged, body.size))
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        system, base = stores.at(self.root)
        # of several rows of one path the last one counts
        files = {path: (staged, size) for m in messages if m for path, staged, size in m.files}
        for folder in {f"{base}/{p}".rpartition("/")[0] for p in files}:
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda x: system.move(x[1][0], f"{base}/{x[0]}"), files.items()))
        system.create_dir(f"{base}/_journal", recursive=True)
        rows = [json.dumps({"path": p, "size": size, "job": self.job, "at": int(time.time())}) + "\n" for p, (_, size) in sorted(files.items())]
        draft = f"{base}/_staging/{self.job}/journal"
        with system.open_output_stream(draft) as f:
            f.write("".join(rows).encode())
        system.move(draft, f"{base}/_journal/{self.job}.json")
        self._clear(system, base)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*stores.at(self.root))

    def _clear(self, system: fs.FileSystem, base: str) -> None:
        if system.get_file_info(f"{base}/_staging/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/_staging/{self.job}")


class JournalSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "journaled_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> JournalWriter:
        return JournalWriter(self.options["path"])


def write_once(files: DataFrame, root: str) -> None:
    """Writes rows (path below the root, content) as files; rows without content are left out."""
    name = stores.register(files.sparkSession, JournalSink)
    files.select("path", F.col("content").cast("binary").alias("content")).write.format(name).mode("append").save(root)


def committed(spark: SparkSession, root: str) -> DataFrame:
    """path, size of the files that are committed below a root, the latest of each path; none before the first commit."""
    system, base = stores.at(root)
    schema = "path string, size long, job string, at long"
    if system.get_file_info(f"{base}/_journal").type != fs.FileType.Directory:
        return spark.createDataFrame([], "path string, size long")
    rows = spark.read.schema(schema).json(f"{root}/_journal")
    return rows.groupBy("path").agg(F.max_by("size", F.struct("at", "job")).alias("size"))


def pending(wanted: DataFrame, root: str, path: str = "path") -> DataFrame:
    """The rows whose file is not committed, or is empty."""
    done = committed(wanted.sparkSession, root).where("size > 0").select(F.col("path").alias(path))
    return wanted.join(done, path, "left_anti")
