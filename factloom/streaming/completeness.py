"""Completeness of shards kept while their parts arrive, in any order and over restarts.

Events say that a part of a shard (bank_folder, stem) is there: `vectors` or `metadata` with its number of rows, or the
`done` marker. State holds for each shard the last number of each kind, so a part that is sent again replaces itself. A
shard is `ok` when all three are there and the numbers agree, `mismatch` when they don't, else `waiting`; one that waits
longer than the patience allows is `expired` by a timer, and comes back when its missing part arrives late.

What comes out is a log of changes with a version for each shard; `latest` of it is what `shard_status` gives for all
events in one batch (but for `expired`, which is `waiting` there). The state store must be RocksDB: `session` gives a
session of its own for that.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

EVENTS = "kind string, bank_folder string, stem string, n long, ts timestamp"
STATUS = "bank_folder string, stem string, num_vec long, num_meta long, is_done boolean, status string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session(spark: SparkSession) -> SparkSession:
    """A session like the caller's, with the state store that these queries need."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set(PROVIDER, ROCKSDB)
    return own


def status_of(num_vec: int | None, num_meta: int | None, is_done: bool) -> str:
    if num_vec is None or num_meta is None or not is_done:
        return "waiting"
    return "ok" if num_vec == num_meta else "mismatch"


class Shard(StatefulProcessor):
    """One shard's parts, its status and the timer that it waits for."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("shard", "num_vec long, vec_ms long, num_meta long, meta_ms long, is_done boolean, status string, version long, due long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.state.get() if self.state.exists() else (None, None, None, None, False, "new", 0, None)
        num_vec, vec_ms, num_meta, meta_ms, is_done, status, version, due = held
        before, last = (num_vec, num_meta, is_done, status), 0
        for r in rows:
            ms = int(r.ts.timestamp() * 1000)
            last = max(last, ms)
            # of two numbers of one time the larger counts, whatever order they come in
            if r.kind == "vectors" and (vec_ms is None or (ms, r.n) >= (vec_ms, num_vec)):
                num_vec, vec_ms = r.n, ms
            elif r.kind == "metadata" and (meta_ms is None or (ms, r.n) >= (meta_ms, num_meta)):
                num_meta, meta_ms = r.n, ms
            elif r.kind == "done":
                is_done = True
        status = status_of(num_vec, num_meta, is_done)
        if due is not None:
            self.handle.deleteTimer(due)
            due = None
        if status == "waiting":
            due = max(last, timerValues.getCurrentWatermarkInMs()) + self.patience_ms
            self.handle.registerTimer(due)
        changed = (num_vec, num_meta, is_done, status) != before
        version += changed
        self.state.update((num_vec, vec_ms, num_meta, meta_ms, is_done, status, version, due))
        if changed:
            yield Row(bank_folder=key[0], stem=key[1], num_vec=num_vec, num_meta=num_meta, is_done=is_done, status=status, version=version)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        num_vec, vec_ms, num_meta, meta_ms, is_done, _, version, _ = self.state.get()
        self.state.update((num_vec, vec_ms, num_meta, meta_ms, is_done, "expired", version + 1, None))
        yield Row(bank_folder=key[0], stem=key[1], num_vec=num_vec, num_meta=num_meta, is_done=is_done, status="expired", version=version + 1)

    def close(self) -> None:
        pass


def events_stream(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """Events from JSON lines that arrive in a folder. ts is when the part came, so late parts have late times."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_at_once).json(folder)


def changes(events: DataFrame, patience_seconds: int = 3600) -> DataFrame:
    """STATUS and version for each change of a shard, from a stream of EVENTS."""
    dated = events.where("ts IS NOT NULL AND bank_folder IS NOT NULL AND stem IS NOT NULL").withWatermark("ts", "0 seconds")
    return dated.groupBy("bank_folder", "stem").transformWithState(Shard(1000 * patience_seconds), f"{STATUS}, version long", "Append", "EventTime")


def track(events: DataFrame, out: str, checkpoint: str, patience_seconds: int = 3600) -> StreamingQuery:
    """Writes the changes of all events that are there now; the next call goes on from the checkpoint."""
    return changes(events, patience_seconds).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(log: DataFrame) -> DataFrame:
    """STATUS of each shard by its last change."""
    last = F.max_by(F.struct("num_vec", "num_meta", "is_done", "status"), "version")
    return log.groupBy("bank_folder", "stem").agg(last.alias("s")).select("bank_folder", "stem", "s.*")


def shard_status(events: DataFrame) -> DataFrame:
    """STATUS of each shard by all events at once."""
    dated = events.where("ts IS NOT NULL AND bank_folder IS NOT NULL AND stem IS NOT NULL")
    number = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct("ts", "n")))["n"]
    own = dated.groupBy("bank_folder", "stem").agg(number("vectors").alias("num_vec"), number("metadata").alias("num_meta"), (F.count_if(F.col("kind") == "done") > 0).alias("is_done"))
    waits = F.col("num_vec").isNull() | F.col("num_meta").isNull() | ~F.col("is_done")
    return own.withColumn("status", F.when(waits, "waiting").when(F.col("num_vec") == F.col("num_meta"), "ok").otherwise("mismatch"))
