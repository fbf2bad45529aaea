"""Shards tracked over runs of a stream against one batch over all events; timers, late parts, parts sent again."""

import random
from datetime import datetime, timedelta

import pytest

from factloom.streaming import completeness as C

START = datetime(2024, 1, 1)


def write(spark, folder, events):
    spark.createDataFrame([(k, b, s, n, START + timedelta(seconds=t)) for k, b, s, n, t in events], C.EVENTS).coalesce(1).write.mode("append").json(folder)


def rows(df):
    return sorted(tuple(r) for r in df.select("bank_folder", "stem", "num_vec", "num_meta", "is_done", "status").collect())


@pytest.fixture(scope="module")
def own(spark):
    return C.session(spark)


def test_runs_equal_a_batch(spark, own, tmp_path):
    r = random.Random(4)
    every, at = [], [str(tmp_path / x) for x in ("in", "out", "state")]
    for run in range(3):  # each run is a restart from the checkpoint
        events = [(r.choice(["vectors", "metadata", "done"]), f"b{r.randrange(3)}", f"s{r.randrange(8)}", r.randrange(3), run * 100 + r.randrange(50)) for _ in range(40)]
        events += [("vectors", None, "s0", 1, run * 100), ("other", "b0", "s1", 9, run * 100)]
        every += events
        write(spark, at[0], events)
        C.track(C.events_stream(own, at[0]), at[1], at[2], 10**6).awaitTermination()
        got = rows(C.latest(own.read.parquet(at[1])))
        assert got == rows(C.shard_status(own.read.schema(C.EVENTS).json(at[0])))
    assert len({x[5] for x in got}) == 3
    C.track(C.events_stream(own, at[0]), at[1], at[2], 10**6).awaitTermination()  # nothing new
    assert rows(C.latest(own.read.parquet(at[1]))) == got


def test_late_metadata(spark, own, tmp_path):
    """A shard that waits too long expires by its timer; late metadata after a restart makes it whole."""
    at = [str(tmp_path / x) for x in ("in", "out", "state")]
    run = lambda: C.track(C.events_stream(own, at[0]), at[1], at[2], 60).awaitTermination()
    write(spark, at[0], [("vectors", "b", "late", 5, 0), ("done", "b", "late", None, 1), ("vectors", "b", "fine", 2, 0), ("metadata", "b", "fine", 2, 0), ("done", "b", "fine", None, 2)])
    run()
    assert rows(C.latest(own.read.parquet(at[1]))) == [("b", "fine", 2, 2, True, "ok"), ("b", "late", 5, None, True, "waiting")]
    write(spark, at[0], [("vectors", "b", "other", 1, 500)])  # time goes on
    run()
    run()
    assert ("b", "late", 5, None, True, "expired") in rows(C.latest(own.read.parquet(at[1])))
    write(spark, at[0], [("metadata", "b", "late", 5, 501), ("metadata", "b", "fine", 3, 502), ("metadata", "b", "late", 5, 503)])
    run()
    got = rows(C.latest(own.read.parquet(at[1])))
    assert got[:2] == [("b", "fine", 2, 3, True, "mismatch"), ("b", "late", 5, 5, True, "ok")]
    log = [(x.version, x.status) for x in own.read.parquet(at[1]).where("stem = 'late'").orderBy("version").collect()]
    assert [v for v, _ in log] == list(range(1, len(log) + 1)) and [s for _, s in log] == ["waiting", "expired", "ok"]
