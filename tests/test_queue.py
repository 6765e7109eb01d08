"""The queue as a stream against its batch form, its timers, its resumption and its first state."""

import datetime

from pyspark.sql import functions as F

from evidentia.operators import ledger
from evidentia.streaming import queue as Q

START = datetime.datetime(2024, 1, 1)
SCHEMA = "task long, ts timestamp, outcome string"


def feed(spark, folder, name, rows):
    """Add attempts (task, seconds, outcome) to the source, as one file."""
    frame = spark.createDataFrame([(t, START + datetime.timedelta(seconds=s), o) for t, s, o in rows], SCHEMA)
    frame.coalesce(1).write.parquet(f"{folder}/{name}")


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def statuses(spark, path):
    return {r.task: (r.attempts, r.status) for r in Q.latest(spark, path).collect()}


def test_timers_and_resumption(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    feed(spark, folder, "a", [(1, 0, "failed"), (2, 0, "failed"), (2, 10, "failed"), (2, 20, "failed"), (3, 0, "done"), (3, 5, "failed"), (4, 0, "fatal"), (5, 3, "failed"), (5, 3, "done")])
    Q.run_queue(source(spark, folder), out, check, late="0 seconds")
    assert statuses(spark, out) == {1: (1, "waiting"), 2: (3, "quarantined"), 3: (2, "done"), 4: (1, "halted"), 5: (2, "done")}
    feed(spark, folder, "b", [(9, 119, "failed")])
    Q.run_queue(source(spark, folder), out, check, late="0 seconds")
    assert statuses(spark, out)[1] == (1, "waiting")  # two minutes aren't over
    feed(spark, folder, "c", [(9, 121, "failed")])
    Q.run_queue(source(spark, folder), out, check, late="0 seconds")
    feed(spark, folder, "d", [(8, 122, "done")])
    Q.run_queue(source(spark, folder), out, check, late="0 seconds")
    assert statuses(spark, out)[1] == (1, "ready")
    feed(spark, folder, "e", [(1, 130, "failed"), (4, 131, "failed")])
    Q.run_queue(source(spark, folder), out, check, late="0 seconds")
    now = statuses(spark, out)
    assert now[1] == (2, "waiting") and now[4] == (2, "waiting") and now[2] == (3, "quarantined")
    want = ledger.task_state(spark.read.schema(SCHEMA).parquet(f"{folder}/*").select("task", F.unix_timestamp("ts").alias("at"), "outcome"), 0)
    columns = ["task", "attempts", "last", "last_at", "done", "next_retry_at"]
    assert sorted(map(tuple, Q.latest(spark, out).select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_first_state(spark, tmp_path):
    """A run begins with the states of tasks that still exist, whatever supported version wrote them."""
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    at = int(START.replace(tzinfo=datetime.UTC).timestamp())
    old = spark.createDataFrame([(1, 2, 2, at, "failed", False), (1, 2, 1, at - 9, "failed", False), (2, 1, 1, at, "done", None), (3, 0, 1, at, "failed", None), (4, 2, 1, at, "failed", False)], "task long, version int, attempts int, last_at long, last string, done boolean")
    first = Q.migrated(old, spark.createDataFrame([(1,), (2,), (3,), (3,)], "task long"))
    assert sorted(map(tuple, first.collect())) == [(1, 2, at, "failed", False), (2, 1, at, "done", True)]
    feed(spark, folder, "a", [(1, 50, "failed"), (2, 50, "failed"), (3, 50, "failed"), (4, 50, "failed")])
    Q.run_queue(source(spark, folder), out, check, initial=first)
    assert statuses(spark, out) == {1: (3, "quarantined"), 2: (2, "done"), 3: (1, "waiting"), 4: (1, "waiting")}
