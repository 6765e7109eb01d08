"""Incremental processing: what changed by signature, task batches through a judge, and streams over events."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.tables import exact_ids

Judge = Callable[[pd.DataFrame], pd.DataFrame]


def pending(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Candidates (key, signature) whose present signature the state does not hold; a changed signature is pending again."""
    return candidates.join(state.select("key", "signature"), ["key", "signature"], "left_anti")


def signature(df: DataFrame, *columns: str, name: str = "signature") -> DataFrame:
    """df with a digest of the columns; review and other changing metadata are left out by not naming them."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return df.withColumn(name, F.sha2(F.concat_ws("\x1f", *parts), 256))


def judged(tasks: DataFrame, judge: Judge, schema: str, *, batch: int, by: str) -> DataFrame:
    """Answers of a judge to tasks, in batches of `batch` rows of the same `by`; each batch is one call.

    Batches are numbered within `by` and dealt out by number, so a large `by` is spread over tasks.
    """
    numbered = tasks.withColumn("__batch", F.floor((F.row_number().over(Window.partitionBy(by).orderBy("key")) - 1) / batch))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return judge(frame.drop(columns="__batch"))

    return numbered.groupBy(by, "__batch").applyInPandas(run, schema)


def validated(tasks: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Answers of tasks that were answered exactly once, and the violations of all others."""
    found = exact_ids(tasks, answers, "key")
    bad = found.select(F.col("entity_id").alias("__bad"))
    return answers.join(bad, F.col("key").cast("string") == F.col("__bad"), "left_anti"), found


def splitting(judge: Judge, sound: Callable[[pd.DataFrame, pd.DataFrame], bool]) -> Judge:
    """A judge that halves a batch whose answers are not sound, or that fails, and asks again; single rows may stay unanswered."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        try:
            answers = judge(frame)
            if sound(frame, answers):
                return answers
        except (ValueError, KeyError):
            answers = None
        if len(frame) <= 1:
            return answers.iloc[:0] if answers is not None else pd.DataFrame({"key": frame["key"].iloc[:0]})
        half = len(frame) // 2
        parts = [p for p in (run(frame.iloc[:half]), run(frame.iloc[half:])) if len(p)]
        return pd.concat(parts) if parts else run(frame.iloc[:1]).iloc[:0]

    return run


def answers_all(frame: pd.DataFrame, answers: pd.DataFrame) -> bool:
    """Whether each key of a batch is answered exactly once and nothing else is."""
    return sorted(frame["key"]) == sorted(answers["key"])


def overlap_judge(left: str, right: str, least: float = 0.2) -> Judge:
    """A deterministic judge that needs no service: supported if enough words of one text are in the other."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        def share(a, b):
            a, b = set(str(a).lower().split()), set(str(b).lower().split())
            return len(a & b) / max(1, len(a))

        score = [share(a, b) for a, b in zip(frame[left], frame[right])]
        return pd.DataFrame({"key": frame["key"], "supported": [s >= least for s in score], "confidence": score})

    return run


def cached_or(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests (request_sha) with a valid cached answer, and those without; invalid answers are misses."""
    good = cache.where("valid").select("request_sha", "answer")
    return requests.join(good, "request_sha"), requests.join(good, "request_sha", "left_anti")


def run_available(source: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], name: str = "slice") -> StreamingQuery:
    """Run a stream over what is available and stop; the checkpoint makes a resumed run free of repeats."""
    query = source.writeStream.queryName(name).foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_signatures(spark: SparkSession, source: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """Append the (key, signature) rows of a stream that the state table at state_path lacks.

    A batch that is retried writes its own folder again, so a crash between write and commit repeats no row.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        fresh = batch.select("key", "signature").dropDuplicates(["key", "signature"])
        known = [f"{state_path}/epoch={n}" for n in range(epoch)]
        if epoch:
            fresh = fresh.join(batch.sparkSession.read.schema("key string, signature string").parquet(*known), ["key", "signature"], "left_anti")
        fresh.write.mode("overwrite").parquet(f"{state_path}/epoch={epoch}")

    return run_available(source, checkpoint, step, "signatures")


def event_windows(events: DataFrame, *, window: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts and sums of event types by window of event time; rows later than `late` are dropped by the watermark in a stream."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def verified_as_of(inventory_until: Column, requested: Column) -> Column:
    """The day up to which a state is verified: never beyond the inventory, however new the latest entries are."""
    return F.least(inventory_until, requested)


def run_slice(steps: list[tuple[str, Callable[[], int]]], *, seconds: float, clock: Callable[[], float] = time.monotonic, report: Callable[[str, int, float], None] = lambda *_: None) -> dict[str, int]:
    """Run the steps in turn, again and again, until none has work or the time is up; returns what each did.

    A step handles one bounded batch and returns its size; state is in its tables, so a later slice goes on from there.
    """
    began, done = clock(), dict.fromkeys((name for name, _ in steps), 0)
    while clock() - began < seconds:
        idle = True
        for name, step in steps:
            n = step()
            done[name] += n
            idle &= n == 0
            report(name, n, clock() - began)
            if clock() - began >= seconds:
                return done
        if idle:
            return done
    return done
