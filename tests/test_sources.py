"""The matrix source (ranges, pushed conditions, faults) and the journaled sink (commit, abort, retries, reruns)."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.sources import journal, matrices, stores


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("matrices")
    r = np.random.default_rng(1)
    (at / "bank").mkdir()
    made = {"a.npy": r.normal(size=(1000, 6)).astype(np.float32), "bank/b.npy": r.normal(size=(37, 3)), "bank/half.npy": r.normal(size=(5, 2)).astype(np.float16), "empty.npy": np.zeros((0, 4), np.float32)}
    for name, m in made.items():
        np.save(at / name, m)
    np.save(at / "_hidden.npy", np.zeros((3, 3)))
    (at / "note.txt").write_text("no matrix")
    return at, {str(at / n): m.astype(np.float32) for n, m in made.items()}


def rows(df):
    return {(r.path, r.row): tuple(r.embedding) for r in df.collect()}


def expected(made, keep=lambda i: True):
    return {(p, i): tuple(m[i].tolist()) for p, m in made.items() for i in range(len(m)) if keep(i)}


@pytest.mark.parametrize("size", [64 << 20, 500, 1])
def test_matrices(spark, folder, size):
    at, made = folder
    df = matrices.read_matrices(spark, str(at), size=size)
    assert rows(df) == expected(made)
    assert df.rdd.getNumPartitions() == sum(-(-len(m) // max(1, size // (m.shape[1] * m.itemsize * (2 if "b.npy" in p else 1) // (2 if "half" in p else 1)))) for p, m in made.items())
    assert rows(matrices.read_matrices(spark, f"file://{at}/a.npy", 3, 7, size)) == {(p, i): v for (p, i), v in expected(made).items() if p.endswith("a.npy") and 3 <= i <= 7}


def test_ranges_and_sessions(spark, folder):
    at, made = folder
    some = matrices.read_matrices(spark.newSession(), str(at), 10, 13, 240)
    assert rows(some) == expected(made, lambda i: 10 <= i < 14) and some.rdd.getNumPartitions() == 2
    assert rows(some.where("row = 11 OR size(embedding) = 3 AND row = 13")) == {k: v for k, v in expected(made).items() if k[1] == 11 or (k[1] == 13 and len(v) == 3)}
    assert matrices.read_matrices(spark, str(at), 6, 5).collect() == []


def test_a_file_of_four_gigabytes(spark, tmp_path):
    """It is planned as many ranges, and its last rows are read without the rest."""
    rows, columns = 1 << 23, 128
    at = tmp_path / "large.npy"
    with open(at, "wb") as f:
        np.lib.format.write_array_header_1_0(f, {"descr": "<f4", "fortran_order": False, "shape": (rows, columns)})
        begin = f.tell()
        f.truncate(begin + rows * columns * 4)
        f.seek(begin + (rows - 1) * columns * 4)
        f.write(np.arange(columns, dtype=np.float32).tobytes())
    assert os.path.getsize(at) > 4 << 30
    every = matrices.MatrixReader(str(at), matrices.BYTES, 0, None).partitions()
    assert len(every) == 64 and [(p.first, p.end) for p in every[:2]] == [(0, 1 << 17), (1 << 17, 1 << 18)] and every[-1].end == rows
    last = matrices.read_matrices(spark, str(at), rows - 2).collect()
    assert [(r.row, sum(r.embedding)) for r in last] == [(rows - 2, 0.0), (rows - 1, float(sum(range(columns))))]


def test_faulty_matrices(spark, tmp_path):
    np.save(tmp_path / "x.npy", np.zeros((10, 3), np.float32))
    whole = (tmp_path / "x.npy").read_bytes()
    (tmp_path / "x.npy").write_bytes(whole[:-1])
    with pytest.raises(Exception, match="shorter than its header"):
        matrices.read_matrices(spark, str(tmp_path)).collect()
    np.save(tmp_path / "x.npy", np.asfortranarray(np.zeros((10, 3))))
    with pytest.raises(Exception, match="not a matrix"):
        matrices.read_matrices(spark, str(tmp_path)).collect()


def tree(at):
    return {os.path.relpath(p, at): open(p, "rb").read() for d, _, names in os.walk(at) for n in names for p in [os.path.join(d, n)] if not os.path.relpath(p, at).startswith(("_journal", "_staging", "."))}


def files(spark, n, parts=4):
    return spark.range(n).repartition(parts).select(F.concat(F.lit("bank"), (F.col("id") % 3).cast("string"), F.lit("/f"), F.col("id").cast("string"), F.lit(".pdf")).alias("path"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("body "), F.col("id").cast("string"))).cast("binary").alias("content"))


def test_files_are_committed_once(spark, tmp_path):
    root = str(tmp_path / "out")
    assert journal.committed(spark, root).collect() == [] and journal.pending(files(spark, 20), root).count() == 20
    journal.write_once(files(spark, 20), root)
    want = {f"bank{i % 3}/f{i}.pdf": f"body {i}".encode() for i in range(20) if i % 7}
    assert tree(root) == want
    assert {r.path: r.size for r in journal.committed(spark, root).collect()} == {k: len(v) for k, v in want.items()}
    more = files(spark, 30)
    assert {r.path for r in journal.pending(more, root).collect()} == {f"bank{i % 3}/f{i}.pdf" for i in range(30) if i % 7 == 0 or i >= 20}
    journal.write_once(journal.pending(more, root), root)
    assert tree(root) == {f"bank{i % 3}/f{i}.pdf": f"body {i}".encode() for i in range(30) if i % 7}
    journal.write_once(more.where("false"), root)
    assert len(os.listdir(tmp_path / "out" / "_journal")) == 3


def test_a_task_that_dies_half_way(spark, tmp_path):
    """The job ends without a trace; a rerun gives each file once and whole."""
    root, mark = str(tmp_path / "out"), str(tmp_path / "died")

    def fail(batches):
        for b in batches:
            yield b.slice(0, b.num_rows // 2)
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("half way")
            yield b.slice(b.num_rows // 2)

    job = files(spark, 40, 3).mapInArrow(fail, "path string, content binary")
    with pytest.raises(Exception, match="half way"):
        journal.write_once(job, root)
    assert tree(root) == {} and journal.committed(spark, root).collect() == []
    journal.write_once(job, root)
    assert tree(root) == {f"bank{i % 3}/f{i}.pdf": f"body {i}".encode() for i in range(40) if i % 7}


def test_attempts_are_apart(tmp_path):
    """Two attempts of one task stage their files apart, and only the one that is reported is moved."""
    import pyarrow as pa
    from pyspark import TaskContext

    root = str(tmp_path / "out")
    writer = journal.JournalWriter(root)
    batch = pa.RecordBatch.from_arrays([pa.array(["a/x", "y"]), pa.array([b"1", b"22"])], ["path", "content"])

    class Context:
        def __init__(self, attempt):
            self.attempt = attempt

        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return self.attempt

    held = TaskContext.get
    try:
        TaskContext.get = staticmethod(lambda: Context(1))
        writer.write(iter([batch.slice(0, 1)]))  # its executor is lost
        TaskContext.get = staticmethod(lambda: Context(2))
        second = writer.write(iter([batch]))
    finally:
        TaskContext.get = held
    writer.commit([second, None])
    assert tree(root) == {"a/x": b"1", "y": b"22"}
    (own,) = os.listdir(f"{root}/_journal")
    assert [json.loads(x)["path"] for x in open(f"{root}/_journal/{own}")] == ["a/x", "y"]


@pytest.mark.parametrize("path", ["/etc/x", "a/../../x", "_journal/x", ""])
def test_paths_stay_below_the_root(path):
    with pytest.raises(ValueError):
        journal.below(path)


def test_listing(tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.npy").write_bytes(b"12")
    assert stores.listed(str(tmp_path), ".npy") == [(str(tmp_path / "a" / "x.npy"), 2)]
