"""Budgets, retries and run status as folds over append-only events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"


def cost_ledger(events: DataFrame, *by: str) -> DataFrame:
    """Per group: reported and unknown cost, open reservations and exposure, of events (request_id, kind, amount).

    kind is reserve, settle or unknown. A reservation that nothing follows is open, as after a crash, and counts in full;
    an unknown outcome counts as reserved; a settlement replaces its reservation. Repeated events of a request count once.
    """
    one = events.groupBy(*by, "request_id").agg(*[F.max(F.when(F.col("kind") == k, F.col("amount").cast(MONEY))).alias(k) for k in ("reserve", "settle", "unknown")])
    zero = F.lit(0).cast(MONEY)
    lost = F.when(F.col("settle").isNull() & F.col("unknown").isNotNull(), F.coalesce("reserve", "unknown")).otherwise(zero)
    waiting = F.when(F.col("settle").isNull() & F.col("unknown").isNull(), F.coalesce("reserve", zero)).otherwise(zero)
    each = one.select(*by, F.coalesce("settle", zero).alias("reported"), lost.alias("unknown"), waiting.alias("pending"))
    out = each.groupBy(*by).agg(F.count("*").alias("requests"), *[F.sum(c).cast(MONEY).alias(c) for c in ("reported", "unknown", "pending")])
    return out.withColumn("exposure", (F.col("reported") + F.col("unknown") + F.col("pending")).cast(MONEY)).withColumn("complete", (F.col("unknown") == 0) & (F.col("pending") == 0))


def task_state(attempts: DataFrame, now, *, limit: int = 3) -> DataFrame:
    """Per task: attempts, last outcome, when to try again (60 s, doubled with each failure), and whether it is available.

    attempts (task, at, outcome): done, failed or fatal; now is epoch seconds.
    """
    last = F.max_by("outcome", F.struct("at", "outcome"))
    out = attempts.groupBy("task").agg(F.count("*").alias("attempts"), last.alias("last"), F.max("at").alias("last_at"), F.bool_or(F.col("outcome") == "done").alias("done"))
    retry = F.col("last_at") + 60 * F.pow(F.lit(2), F.least("attempts", F.lit(40))).cast("long")
    out = out.withColumn("next_retry_at", F.when(~F.col("done"), retry))
    return out.withColumn("available", ~F.col("done") & (F.col("last") != "fatal") & (F.col("attempts") < limit) & (F.col("next_retry_at") <= now))


def progress(tasks: DataFrame, *by: str) -> DataFrame:
    """Per group: tasks, completed, failed for good, open; and the run's status."""
    out = tasks.groupBy(*by).agg(F.count("*").alias("tasks"), F.count_if("done").alias("completed"), F.count_if(F.col("last") == "fatal").alias("fatal"), F.count_if("available").alias("ready"))
    status = F.when(F.col("fatal") > 0, "blocked").when(F.col("completed") == F.col("tasks"), "completed").when(F.col("ready") > 0, "continuing").otherwise("needs_attention")
    return out.withColumn("status", status)


def granted_limits(grants: DataFrame, default: int) -> DataFrame:
    """Per task: the attempt limit after its grants (grant_id, task, attempts); a grant counts once however often it comes."""
    first = grants.withColumn("nth", F.row_number().over(Window.partitionBy("grant_id").orderBy("task", "attempts"))).where("nth = 1")
    return first.groupBy("task").agg((F.sum("attempts") + default).alias("limit"))
