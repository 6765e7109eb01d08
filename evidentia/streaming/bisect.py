"""Asking a judge in batches that are halved when they fail, in one pass over sorted batches."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_or_shuffled, stored
from .state import Judge

TASK_ROWS = 16_384  # tasks of a judge in one Spark task


class Asked(NamedTuple):
    answers: DataFrame  # the judge's rows
    unanswered: DataFrame  # (key): tasks that fail alone
    calls: DataFrame  # (round, calls, failed): how often the judge was asked, and how often in vain
    members: DataFrame  # (key, call_id): the first call of each task


def in_batches(tasks: DataFrame, size: int, *by: str) -> DataFrame:
    """tasks with batch (a text) and nth (from 0): runs of `size` rows of one `by` by key.

    A `by` of many rows is cut by hash into sections of some 64 batches first, so that none is ordered in one task. Rows
    come out in that order: those of one batch are neighbours in one partition. Partitions are as many as the rows ask for:
    a judge takes long over few bytes, so their number must not follow from the bytes.
    """
    counts = stored(tasks.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.count("*").alias("__rows")), "batch-rows")
    sections = F.ceil(F.col("__rows") / (64 * size)).cast("int").alias("__sections")
    large = stored(counts.select(*[f"__{c}" for c in by], sections).where("__sections > 1"), "sections")
    rows = counts.agg(F.sum("__rows")).first()[0] or 0
    parts = max(1, -(-rows // TASK_ROWS), min(tasks.sparkSession.sparkContext.defaultParallelism, rows // (4 * size)))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by] or F.lit(True)
    cut = tasks.join(small_or_shuffled(large), same, "left").select(*tasks.columns, F.coalesce("__sections", F.lit(1)).alias("__sections"))
    hashed = F.conv(F.substring(F.md5(F.col("key").cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    cut = cut.withColumn("__section", F.when(F.col("__sections") > 1, F.pmod(hashed, "__sections")).otherwise(0).cast("int"))
    cut = cut.repartition(parts, *by, "__section")
    n = F.row_number().over(Window.partitionBy(*by, "__section").orderBy("key")) - 1
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by], "__section", F.floor(n / size))
    return cut.select(*tasks.columns, name.alias("batch"), (n % size).cast("int").alias("nth"))


def bisected(tasks: DataFrame, judge: Judge, schema: str, *, size: int, by: tuple[str, ...] = (), name: tuple[str, ...] = (), seen: Callable[[DataFrame], DataFrame] | None = None) -> Asked:
    """Answers of a judge to tasks (key, ...); every batch is one call.

    A call is sound if it raises nothing but ValueError or KeyError and answers each key of its batch exactly once. A batch
    without a sound call is cut in half for the next round, the first half having the smaller number of rows; a single
    task without one stays unanswered. So a bad row costs some log2(size) rounds of two calls, and no more than itself.
    All rounds of a batch are asked where it lies, so nothing is shuffled or written between them, and a task works off
    many batches of one Arrow batch. call_id is a digest of `name` and the keys of a first batch, so equal calls have equal
    ids. Tasks need distinct keys. schema is that of the judge's answers, with key. Empty tables give no rows.

    seen: adds to batches what the judge sees besides, so that it is neither shuffled nor written with the tasks. It must
    leave rows in their places: expressions, and joins with what is marked for broadcast.
    """
    spark = tasks.sparkSession
    batches = in_batches(tasks, size, *by).select(*tasks.columns, "batch")
    batches = batches if seen is None else seen(batches)
    columns, fields = [c for c in batches.columns if c != "batch"], spark.createDataFrame([], schema).columns
    kind = dict(tasks.dtypes)["key"]
    extra = {"__kind": "string", "__key": kind, "__call": "string", "__round": "int", "__calls": "long", "__failed": "long"}

    def ask(frames):
        import hashlib

        import numpy as np
        import pandas as pd

        def rows(kind, **given):
            n = len(next(iter(given.values())))
            return pd.DataFrame({c: given[c] if c in given else pd.Series([None] * n, dtype=object) for c in [*fields, *extra] if c != "__kind"}).assign(__kind=kind)[[*fields, *extra]]

        def turns(frame, starts):
            found, ids, lost, lost_ids, counts = [], [], [], [], {}
            tasks, keys = frame[columns], frame["key"].tolist()
            for a, b in zip(starts[:-1], starts[1:]):
                call_id = hashlib.sha256("\x1f".join([*name, *sorted(map(str, keys[a:b]))]).encode()).hexdigest()
                todo = [(a, b, 0)]
                while todo:
                    low, high, turn = todo.pop()
                    count = counts.setdefault(turn, [0, 0])
                    count[0] += 1
                    task = tasks.iloc[low:high]
                    task.index = range(high - low)
                    try:
                        answers = judge(task)
                        sound = sorted(answers["key"].tolist()) == sorted(keys[low:high])
                    except (ValueError, KeyError):
                        sound = False
                    if sound:
                        found.append(answers[fields])
                        ids += [call_id] * len(answers)
                        continue
                    count[1] += 1
                    if high - low == 1:
                        lost.append(keys[low])
                        lost_ids.append(call_id)
                    else:
                        half = low + (high - low) // 2
                        todo += [(half, high, turn + 1), (low, half, turn + 1)]
            if found:
                whole = pd.concat(found, ignore_index=True)
                yield rows("answer", **{c: whole[c] for c in fields}, __key=whole["key"], __call=ids)
            if lost:
                yield rows("unanswered", __key=lost, __call=lost_ids)
            yield rows("calls", __round=[*counts], __calls=[c for c, _ in counts.values()], __failed=[f for _, f in counts.values()])

        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            batch = frame["batch"].to_numpy()
            cuts = np.flatnonzero(batch[1:] != batch[:-1]) + 1  # the last batch may go on in the next frame
            if len(cuts):
                yield from turns(frame, [0, *cuts])
            rest = frame.iloc[cuts[-1] if len(cuts) else 0 :]
        if rest is not None:
            yield from turns(rest.reset_index(drop=True), [0, len(rest)])

    whole = schema + "".join(f", {c} {t}" for c, t in extra.items())
    asked = stored(batches.mapInPandas(ask, whole), "asked")
    calls = asked.where("__kind = 'calls'").groupBy(F.col("__round").alias("round")).agg(F.sum("__calls").alias("calls"), F.sum("__failed").alias("failed"))
    members = asked.where("__key is not null").select(F.col("__key").alias("key"), F.col("__call").alias("call_id"))
    return Asked(asked.where("__kind = 'answer'").select(*fields), asked.where("__kind = 'unanswered'").select(F.col("__key").alias("key")), calls, members)
