"""Outcomes, metrics, effects and timelines of accepted evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.domain import accepted, in_window, law_direction
from ..functions.text import percentage
from ..session import dealt

STATUSES = ["fulfilled", "partial", "contradicted", "mixed", "unassessed"]


def accepted_impacts(impacts: DataFrame) -> DataFrame:
    return impacts.where(accepted(F.col("review"), F.col("evaluation")))


def half_up(c: Column, digits: int = 0) -> Column:
    """Rounding with halves towards plus infinity."""
    return F.floor(c * 10**digits + 0.5) / 10**digits


def outcomes(criteria: DataFrame, programs: DataFrame, impacts: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row per criterion that is not rejected, of a programme that is not: status, automatic, reviewed, covered, score.

    automatic: an agent's assessment with at least one piece of evidence, all of it accepted and the criterion's own.
    """
    good = accepted_impacts(impacts)
    own = evidence.join(good.select("impact_id", F.col("criterion_id").alias("of")), "impact_id", "left")
    proof = own.groupBy("criterion_id").agg(F.bool_and(F.coalesce(F.col("of") == F.col("criterion_id"), F.lit(False))).alias("proven"))
    strong = good.groupBy("criterion_id").agg(F.bool_or(F.col("evaluation") == "accepted").alias("evaluated"), F.lit(True).alias("touched"))
    active = programs.where("review <> 'rejected'").select("program_id", F.col("review").alias("program_review"))
    c = criteria.where("review <> 'rejected'").join(F.broadcast(active), "program_id").join(proof, "criterion_id", "left").join(strong, "criterion_id", "left")
    reviewed = (F.col("review") == "reviewed") & (F.col("program_review") == "reviewed")
    automatic = (F.col("method") == "agent") & F.coalesce("proven", F.lit(False))
    covered = F.coalesce("evaluated", F.lit(False)) | (F.coalesce("touched", F.lit(False)) & (F.col("review") == "reviewed"))
    return c.select("criterion_id", "program_id", F.when(automatic | reviewed, F.col("status")).otherwise("unassessed").alias("status"), automatic.alias("automatic"), reviewed.alias("reviewed"), covered.alias("covered"), F.when(automatic, F.col("assessed_score")).alias("score"))


def metrics(rows: DataFrame, *by: str) -> DataFrame:
    """Counts and rates of outcomes; rates are null on an empty denominator."""
    n = lambda c: F.count_if(c)
    counts = rows.groupBy(*by).agg(
        F.count("*").alias("total"), n(F.col("reviewed")).alias("reviewed"), *[n(F.col("status") == s).alias(s) for s in STATUSES[:4]],
        n(F.col("covered")).alias("covered"), n(F.col("automatic")).alias("automated"), F.count("score").alias("scored"), F.avg("score").alias("mean"),
    )
    known = F.col("fulfilled") + F.col("partial") + F.col("contradicted") + F.col("mixed")
    return counts.select(
        *by, "total", "reviewed", *STATUSES[:4], (F.col("total") - known).alias("unknown"), "covered", "automated", "scored", half_up(F.col("mean"), 2).alias("alignment"),
        half_up(percentage(F.col("covered"), F.col("total"))).cast("int").alias("coverage"), half_up(percentage(F.col("fulfilled"), F.col("total"))).cast("int").alias("fulfilment"),
        F.round(percentage(F.col("fulfilled") + F.col("partial"), F.col("total")), 6).alias("implemented"),
    )


def topic_progress(rows: DataFrame, tags: DataFrame, *by: str) -> DataFrame:
    """Per tag: total, covered and a count of each status; a criterion counts once for each of its tags; with its rank."""
    each = tags.select("criterion_id", "tag").distinct().join(rows, "criterion_id")
    known = F.when(F.col("status").isin(STATUSES), F.col("status")).otherwise("unassessed")
    out = each.groupBy(*by, "tag").agg(F.count("*").alias("total"), F.count_if("covered").alias("covered"), *[F.count_if(known == s).alias(s) for s in STATUSES])
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("covered"), F.desc("total"), "tag")))


def insight_impacts(impacts: DataFrame, criteria: DataFrame, laws: DataFrame, programs: DataFrame, tasks: int | None = None) -> DataFrame:
    """Accepted impacts of active criteria by laws in their programme's window, published after it; one row per id.

    With `tasks`, impacts are dealt to as many by their criterion, and what is grouped by criteria next stays so dealt. Laws
    are joined first, as impacts that come dealt by their law are not shuffled for it.
    """
    p = programs.where("review <> 'rejected'").select("program_id", "published_at", "period_start", "period_end", F.col("review").alias("p_review")).withColumnRenamed("published_at", "p_published")
    c = criteria.where("review <> 'rejected'").select("criterion_id", "program_id", "party_id", F.col("review").alias("c_review")).join(F.broadcast(p), "program_id")
    v = laws.where("review <> 'rejected'").select("law_id", F.col("published_at").alias("day"))
    rows = dealt(accepted_impacts(impacts).join(v, "law_id"), tasks, "criterion_id").join(c, "criterion_id").where(in_window(F.col("day"), F.col("period_start"), F.col("period_end"), F.col("p_published")))
    sure = (F.col("evaluation") == "accepted") | ((F.col("c_review") == "reviewed") & (F.col("p_review") == "reviewed"))
    return rows.where(sure).select("impact_id", "party_id", "program_id", "criterion_id", "law_id", "day", "score", "period_start")


def law_effects(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per party and law: criteria affected by sign, direction, and those it is first to cover, alone or the same day.

    With `tasks`, the effects are dealt to as many by their law.
    """
    each = rows.groupBy("party_id", "criterion_id", "law_id", "day").agg(*[F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in (("plus", F.col("score") > 0), ("minus", F.col("score") < 0), ("zero", F.col("score") == 0))])
    same = Window.partitionBy("party_id", "criterion_id")
    first = F.col("day") == F.min("day").over(same)
    # One row a criterion, law and day: a criterion's rows of its first day are as many as its first laws.
    each = each.withColumn("first", F.coalesce(first, F.lit(False)).cast("int")).withColumn("laws", F.sum("first").over(same))
    effects = dealt(each, tasks, "law_id").groupBy("party_id", "law_id", "day").agg(
        F.count("*").alias("affected"), F.sum("plus").alias("supporting"), F.sum("minus").alias("opposing"), F.sum("zero").alias("neutral"),
        F.sum(F.when(F.col("laws") == 1, F.col("first")).otherwise(0)).alias("newly_covered"), F.sum(F.when(F.col("laws") > 1, F.col("first")).otherwise(0)).alias("shared"),
    )
    return effects.withColumn("direction", law_direction(F.col("supporting"), F.col("opposing"), F.col("neutral")))


def timeline(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per party: a baseline the day before its earliest period, then a row per day with evidence, all counts cumulative.

    Laws and then days are summed up first, so the running sums order days and not impacts. With `tasks`, rows are dealt to
    as many by their law for it.
    """
    first = rows.groupBy("party_id", "criterion_id").agg(F.min("day").alias("day")).groupBy("party_id", "day").agg(F.count("*").alias("new_covered"))
    against = rows.where("score < 0").groupBy("party_id", "criterion_id").agg(F.min("day").alias("day")).groupBy("party_id", "day").agg(F.count("*").alias("new_opposed"))
    by_law = dealt(rows, tasks, "law_id").groupBy("party_id", "law_id", "day").agg(F.count("*").alias("new_impacts"), *[F.count_if(F.col("score") == s).alias(f"s{s + 2}") for s in range(-2, 3)])
    days = by_law.groupBy("party_id", "day").agg(*[F.sum(c).alias(c) for c in ("new_impacts", *[f"s{s}" for s in range(5)])], F.count("law_id").alias("laws"))
    days = days.join(first, ["party_id", "day"], "left").join(against, ["party_id", "day"], "left").na.fill(0).withColumn("baseline", F.lit(False))
    base = rows.groupBy("party_id").agg(F.date_sub(F.min("period_start"), 1).alias("day"))
    zero = [c for c in days.columns if c not in ("party_id", "day", "baseline")]
    days = days.unionByName(base.select("party_id", "day", *[F.lit(0).cast("long").alias(c) for c in zero], F.lit(True).alias("baseline")))
    upto = Window.partitionBy("party_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    totals = {"covered": "new_covered", "opposed": "new_opposed", "impacts": "new_impacts"} | {f"score_{n}": f"s{i}" for i, n in enumerate(("m2", "m1", "0", "p1", "p2"))}
    return days.select("party_id", "day", "baseline", "laws", "new_covered", "new_opposed", *[F.sum(c).over(upto).alias(n) for n, c in totals.items()])


def timeline_jumps(rows: DataFrame, k: int = 3, tasks: int | None = None) -> DataFrame:
    """The k laws with the most evidence of each party; ties by day, then id. With `tasks`, rows are dealt to as many by law."""
    counts = dealt(rows, tasks, "law_id").groupBy("party_id", "law_id", "day").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("party_id").orderBy(F.desc("n"), "day", "law_id"))).where(F.col("rank") <= k)


def evidence_signature(impacts: DataFrame, laws: DataFrame) -> DataFrame:
    """Per criterion: a digest of its accepted effects in order of day, law and id; it changes if any of them does."""
    rows = accepted_impacts(impacts).join(laws.select("law_id", "published_at"), "law_id")
    part = F.struct(F.date_format("published_at", "yyyy-MM-dd").alias("day"), "law_id", "impact_id", "score")
    listed = F.transform(F.array_sort(F.collect_list(part)), lambda x: F.concat_ws(":", x["day"], x["law_id"], x["impact_id"], x["score"]))
    return rows.groupBy("criterion_id").agg(F.count("*").alias("n"), F.sha2(F.array_join(listed, "|"), 256).alias("signature"))


def extraction_coverage(leaves: DataFrame, audited: DataFrame, bearing: DataFrame, *by: str) -> DataFrame:
    """Per group: leaves, and those that were audited or bear a criterion; ids that are no leaf are left out."""
    done = audited.select("leaf_id").union(bearing.select("leaf_id")).distinct().withColumn("done", F.lit(1))
    return leaves.join(done, "leaf_id", "left").groupBy(*by).agg(F.count("*").alias("leaves"), F.count("done").alias("processed"))
