"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: White space of the word pattern `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_own_checkpoints: dict[str, str] = {}
_powers: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset, in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_checkpoints:
        _own_checkpoints[app] = tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(_own_checkpoints[app])
    return _own_checkpoints[app]


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    out = spark.read.parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` made. What was made of them must be written, too."""
    for t in tables:
        jvm, path = t.sparkSession._jvm, t.written_at
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """The first n powers of the base modulo 2**64; the longest run so far is kept for the next call."""
    if len(_powers.get(base, ())) < n:
        out = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out, dtype=np.uint64)
    return _powers[base][:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of an Arrow string column; a null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    if data is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the buffer, and n + 1 offsets of each text's words. No word crosses texts."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, the same wherever the word stands."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=total[1:])
    return mix((total[end] - total[start]) * inverse_powers(len(data))[start] + (end - start).astype(np.uint64))


_digests: dict[bytes, bytes] = {}


def word_digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for each word, its 128-bit BLAKE2b digest, so that different words differ whatever their bytes are.

    A polynomial hash groups the words; each is compared byte by byte with its group's first, which alone is digested.
    """
    if not len(start):
        return np.zeros((0, 2), np.uint64)
    _, first, of = np.unique(word_hashes(data, start, end), return_index=True, return_inverse=True)
    like, size = first[of], end - start
    others = np.flatnonzero((like != np.arange(len(start))) & (size == size[like]))
    n = size[others]
    to = np.cumsum(n) - n
    at = np.repeat(start[others] - to, n) + np.arange(int(n.sum()))
    wrong = np.flatnonzero(data[at] != data[at + np.repeat(start[like[others]] - start[others], n)])
    odd = np.union1d(others[np.unique(np.searchsorted(to, wrong, side="right") - 1)], np.flatnonzero(size != size[like]))
    if len(_digests) > 200_000:
        _digests.clear()

    def digest(i: int) -> bytes:
        word = data[start[i] : end[i]].tobytes()
        got = _digests.get(word)
        if got is None:
            got = hashlib.blake2b(word, digest_size=16).digest()
            if len(word) <= 64:
                _digests[word] = got
        return got

    out = np.frombuffer(b"".join(map(digest, first.tolist())), np.uint64).reshape(-1, 2)[of]
    for i in odd.tolist():
        out[i] = np.frombuffer(digest(i), np.uint64)
    return out


def secret_factors(secret: bytes, k: int) -> np.ndarray:
    """2 * k odd 64-bit factors for `keyed_shingles`."""
    raw = b"".join(hashlib.blake2b(secret, digest_size=16, salt=i.to_bytes(8, "little")).digest() for i in range(k))
    return np.frombuffer(raw, np.uint64).reshape(k, 2) | np.uint64(1)


def keyed_shingles(digests: np.ndarray, at: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The shingles of `shingle_hashes` as sums of their words' digests times factors drawn for one job: nobody can choose words whose shingles agree in it."""
    k, n = len(factors), np.diff(at)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    to = np.concatenate(([0], np.cumsum(size)))
    origin = np.repeat(at[:-1] - to[:-1], size) + np.arange(to[-1])
    length = np.repeat(np.minimum(n, k), size)
    out, short = length.astype(np.uint64), bool((length < k).any())
    for i in range(k):
        place = np.minimum(origin + i, len(digests) - 1) if short else origin + i
        grown = out + digests[place, 0] * factors[i, 0] + digests[place, 1] * factors[i, 1]
        out = np.where(i < length, grown, out) if short else grown
    return mix(out)


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and their n + 1 offsets; a text of 1 to k - 1 words has one shingle, the whole sequence."""
    n = np.diff(at)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    to = np.concatenate(([0], np.cumsum(size)))
    origin = np.repeat(at[:-1] - to[:-1], size) + np.arange(to[-1])
    length = np.repeat(np.minimum(n, k), size)
    out = length.astype(np.uint64)
    short = bool((length < k).any())
    for i in range(k):
        here = words[np.minimum(origin + i, len(words) - 1)] if short else words[origin + i]
        grown = out * np.uint64(0xD6E8FEB86659FD93) + here
        out = np.where(i < length, grown, out) if short else grown
    return mix(out), to


def batches(column, most: int = 4 << 20):
    """Row ranges (a, b) of an Arrow string column with at most about `most` bytes each, one row at least."""
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a, held = 0, 0
    for i, s in enumerate(size):
        if i > a and held + s > most:
            yield a, i
            a, held = i, 0
        held += int(s)
    if a < len(size):
        yield a, len(size)


def release() -> None:
    """Gives memory that this worker holds free back to the system: a worker lives on after its task, and several share an executor."""
    import pyarrow as pa

    _digests.clear()
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


#: Rows of an Arrow batch for texts: what a worker, and the JVM beside it, hold of them at a time. Spark bounds a batch's bytes besides.
BATCH_ROWS = 1000


def bounded(docs: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """docs in a session of its own, with the settings of its session now but smaller Arrow batches. The caller's session stays as it is."""
    spark = docs.sparkSession
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    view = f"factloom_{uuid.uuid4().hex}"
    docs.createGlobalTempView(view)
    out = own.table(f"global_temp.{view}")
    spark.catalog.dropGlobalTempView(view)
    return out
