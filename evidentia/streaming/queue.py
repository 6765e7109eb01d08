"""A queue of tasks as a stream with state: attempts, backoff by timers, quarantine and halts."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import Row

STATE = "attempts int, last_at long, last string, done boolean"
OUTPUT = "task long, attempts int, last string, last_at long, done boolean, next_retry_at long, status string"
VERSION = 2
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def next_retry(attempts: int, last_at: int) -> int:
    """When to try again: a minute after the last attempt, doubled with every attempt."""
    return last_at + 60 * 2 ** min(attempts, 40)


class TaskQueue(StatefulProcessor):
    """Keeps each task's attempts and wakes it by an event-time timer when its backoff is over.

    State doesn't depend on the order of a task's events: attempts are counted, the last is that of the latest time (ties:
    the greatest outcome), and a task done once stays done. status: done; halted while the last outcome is fatal;
    quarantined after `limit` attempts; else waiting, and ready when its timer fires. A further attempt replaces the timer.
    """

    def __init__(self, limit: int = 3):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("task", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803  Spark's names
        first = initialState
        self._keep(first["attempts"], first["last_at"], first["last"], first["done"])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        attempts, last_at, last, done = self.state.get() if self.state.exists() else (0, None, None, False)
        for r in rows:
            attempts += 1
            if last_at is None or (r["at"], r["outcome"]) > (last_at, last):
                last_at, last = r["at"], r["outcome"]
            done = done or r["outcome"] == "done"
        status = self._keep(attempts, last_at, last, done)
        yield self._row(key, attempts, last_at, last, done, status)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        attempts, last_at, last, done = self.state.get()
        yield self._row(key, attempts, last_at, last, done, "ready")

    def close(self) -> None:
        pass

    def _keep(self, attempts, last_at, last, done) -> str:
        """Store a task's state, set its only timer, and return its status."""
        self.state.update((attempts, last_at, last, done))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if done or last == "fatal" or attempts >= self.limit:
            return "done" if done else "halted" if last == "fatal" else "quarantined"
        self.handle.registerTimer(1000 * next_retry(attempts, last_at))
        return "waiting"

    def _row(self, key, attempts, last_at, last, done, status) -> Row:
        retry = None if done else next_retry(attempts, last_at)
        return Row(task=key[0], attempts=attempts, last=last, last_at=last_at, done=done, next_retry_at=retry, status=status)


def migrated(state: DataFrame, tasks: DataFrame, version: int = VERSION) -> DataFrame:
    """The rows of a saved state (task, version, attempts, last_at, last, done) that a run may begin with, one a task.

    A state of version 1 had no `done`; it follows from the last outcome. Rows of other versions, and of tasks that no
    longer exist, are dropped; of several rows of a task the one with most attempts counts.
    """
    rows = state.where((F.col("version") == version) | (F.col("version") == 1)).withColumn("done", F.coalesce(F.when(F.col("version") == version, F.col("done")), F.col("last") == "done"))
    best = rows.groupBy("task").agg(F.max(F.struct("attempts", "last_at", "last", "done")).alias("s"))
    return best.join(tasks.select("task").distinct(), "task", "left_semi").select("task", "s.*")


@contextlib.contextmanager
def rocks(spark: SparkSession):
    """State with timers needs the RocksDB store; the session's own choice comes back afterwards."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def queue_stream(attempts: DataFrame, *, limit: int = 3, late: str = "1 hour", initial: DataFrame | None = None) -> DataFrame:
    """Changes (OUTPUT) of tasks by a stream of attempts (task long, ts timestamp, outcome); later ones than `late` are dropped."""
    timed = attempts.select("task", "ts", F.unix_timestamp(F.date_trunc("second", "ts")).alias("at"), "outcome").withWatermark("ts", late)
    started = None if initial is None else initial.groupBy("task")
    return timed.groupBy("task").transformWithState(TaskQueue(limit), OUTPUT, "Update", "EventTime", started)


def run_queue(attempts: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Run the queue over what is available; changes go to path, a folder for each batch, so a batch run again repeats none."""

    def step(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    with rocks(attempts.sparkSession):
        query = queue_stream(attempts, **options).writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def latest(spark: SparkSession, path: str) -> DataFrame:
    """Each task's last change; a timer of an epoch counts after that epoch's input."""
    rows = spark.read.schema(f"{OUTPUT}, epoch int").parquet(path)
    best = rows.groupBy("task").agg(F.max(F.struct("epoch", "attempts", F.col("status") == "ready", "status", "last", "last_at", "done", "next_retry_at")).alias("s"))
    return best.select("task", "s.attempts", "s.last", "s.last_at", "s.done", "s.next_retry_at", "s.status")
