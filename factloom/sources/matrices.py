"""Matrices in .npy files as a data source: spark.read.format("npy").load(folder) gives path, row, embedding.

The driver reads the files' headers alone and plans ranges of rows of about BYTES each, so that one large file is read by
many tasks; a task reads its range in blocks and never a whole file. The options `first` and `last` (rows, both included)
narrow the ranges before anything is read. (Spark 4.1 can push conditions into Python sources, but keeps what it pushed
for the next query on the same DataFrame, so that is not used.)
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import stores

#: Bytes of a range of rows, and of a block that a task reads at a time.
BYTES, BLOCK = 64 << 20, 4 << 20
SCHEMA = "path string, row long, embedding array<float>"


@dataclass
class Rows(InputPartition):
    """A range of rows of a file."""

    path: str
    kind: str
    begin: int
    columns: int
    first: int
    end: int


def header(path: str, size: int) -> tuple[int, np.dtype, int, int]:
    """(where the data begins, type, rows, columns) of a .npy file; an error if it isn't a whole matrix of floats in row order."""
    system, own = stores.at(path)
    with system.open_input_file(own) as f:
        start = io.BytesIO(f.read(min(size, 1 << 16)))
    version = np.lib.format.read_magic(start)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, by_column, kind = read(start)
    if by_column or len(shape) != 2 or kind.kind != "f":
        raise ValueError(f"{path}: not a matrix of floats in row order")
    if size < start.tell() + shape[0] * shape[1] * kind.itemsize:
        raise ValueError(f"{path}: shorter than its header says")
    return start.tell(), kind, shape[0], shape[1]


class MatrixReader(DataSourceReader):
    def __init__(self, path: str, size: int, first: int, last: int | None):
        self.path, self.size, self.first, self.last = path, size, first, last

    def partitions(self) -> list[Rows]:
        out = []
        for path, size in stores.listed(self.path, ".npy"):
            own = path if "://" not in self.path else f"{self.path.split('://')[0]}://{path}"
            begin, kind, rows, columns = header(own, size)
            end = rows if self.last is None else min(rows, self.last + 1)
            step = max(1, self.size // max(1, columns * kind.itemsize))
            out += [Rows(own, kind.str, begin, columns, a, min(a + step, end)) for a in range(max(0, self.first), end, step)]
        return out

    def read(self, part: Rows | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # there are no rows to plan
            return
        system, own = stores.at(part.path)
        kind = np.dtype(part.kind)
        width = part.columns * kind.itemsize
        step = max(1, BLOCK // max(1, width))
        with system.open_input_file(own) as f:
            for a in range(part.first, part.end, step):
                b = min(a + step, part.end)
                f.seek(part.begin + a * width)
                values = np.frombuffer(f.read((b - a) * width), kind).astype(np.float32)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * part.columns), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array([own] * (b - a)), pa.array(np.arange(a, b)), vectors], ["path", "row", "embedding"])


class MatrixSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MatrixReader:
        o = self.options
        return MatrixReader(o["path"], int(o.get("bytes", BYTES)), int(o.get("first", 0)), int(o["last"]) if "last" in o else None)


def read_matrices(spark: SparkSession, path: str, first: int = 0, last: int | None = None, size: int = BYTES) -> DataFrame:
    """path, row, embedding of the .npy files at or below a path, many tasks to a file; with first and last only these rows of each, and no others are read."""
    reader = spark.read.format(stores.register(spark, MatrixSource)).option("bytes", size).option("first", first)
    return (reader if last is None else reader.option("last", last)).load(path)
