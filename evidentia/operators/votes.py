"""Vote totals, comparable votes, comparisons with effects, and matches between vote sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domain as D
from ..session import dealt, small_or_shuffled, stored
from .evidence import accepted_impacts

POSITIONS = ["yes", "no", "abstain", "mixed", "unknown"]
OUTCOMES = ["consistent", "tension", "mixed", "contextual", "neutral", "unknown"]


def totals(groups: DataFrame, *by: str, tasks: int | None = None) -> DataFrame:
    """Sums of the counts; all null if any group's count is unknown. With `tasks`, groups are dealt to as many before they are summed."""
    counts = ["yes", "no", "abstain", "absent"]
    unknown = F.bool_or(F.expr(" or ".join(f"{c} is null" for c in counts)))
    out = dealt(groups, tasks, *by).groupBy(*by).agg(unknown.alias("unknown"), *[F.sum(c).alias(c) for c in counts])
    shown = out.select(*by, *[F.when(~F.col("unknown"), F.col(c)).alias(c) for c in counts])
    return shown.withColumn("cast_votes", F.col("yes") + F.col("no") + F.col("abstain")).withColumn("total", F.col("cast_votes") + F.col("absent"))


def comparable_votes(votes: DataFrame, coverage: DataFrame, laws: DataFrame) -> DataFrame:
    """The single public final vote on a whole law that preceded its publication; laws with several have none."""
    v = votes.where("is_public and is_final and whole_law and checked").join(coverage.select("law_id", "status"), "law_id", "left")
    v = v.where(~F.coalesce("status", F.lit("")).isin("source_error", "source_changed", "ambiguous"))
    v = v.join(laws.where("review <> 'rejected'").select("law_id", "published_at"), "law_id").where("vote_date <= published_at")
    return v.withColumn("n", F.count("*").over(Window.partitionBy("law_id"))).where("n = 1").select("vote_id", "law_id", "vote_date", "published_at")


def comparisons(comparable: DataFrame, impacts: DataFrame, criteria: DataFrame, programs: DataFrame, groups: DataFrame) -> DataFrame:
    """A row for each comparable vote, accepted effect of its law and criterion's party that voted: position and outcome.

    Both the vote and the publication must fall after the programme's publication and into its window.
    """
    p = programs.where("review <> 'rejected'").select("program_id", F.col("party_id").alias("owner"), F.col("published_at").alias("p_published"), "period_start", "period_end")
    c = criteria.where("review <> 'rejected'").select("criterion_id", "program_id", "party_id").join(F.broadcast(p), "program_id").where("owner = party_id")
    rows = comparable.join(accepted_impacts(impacts).select("impact_id", "law_id", "criterion_id", "score"), "law_id").join(c, "criterion_id")
    for day in ("vote_date", "published_at"):
        rows = rows.where(D.in_window(F.col(day), F.col("period_start"), F.col("period_end"), F.col("p_published")))
    rows = rows.join(groups, ["vote_id", "party_id"])
    position = D.group_position(F.col("yes"), F.col("no"), F.col("abstain"), F.col("position"))
    counted = F.col("yes").isNotNull() & F.col("no").isNotNull() & F.col("abstain").isNotNull()
    rows = rows.withColumn("side", position)
    outcome = D.comparison_outcome(F.col("side"), F.col("score"), counted)
    with_sign, against_sign = F.when(F.col("score") > 0, F.col("yes")).when(F.col("score") < 0, F.col("no")), F.when(F.col("score") > 0, F.col("no")).when(F.col("score") < 0, F.col("yes"))
    return rows.select("vote_id", "law_id", "vote_date", "impact_id", "criterion_id", "party_id", "score", F.col("side").alias("position"), outcome.alias("outcome"), with_sign.alias("consistent_ballots"), against_sign.alias("tension_ballots"))


def highlights(rows: DataFrame, k: int) -> DataFrame:
    """k comparisons, tension first, newest first, at most one per law."""
    order = [F.when(F.col("outcome") == "tension", 0).otherwise(1), F.desc("vote_date"), F.asc("vote_id"), F.asc("impact_id"), F.asc("party_id")]
    first = rows.withColumn("of_law", F.row_number().over(Window.partitionBy("law_id").orderBy(*order))).where("of_law = 1").drop("of_law")
    return first.orderBy(*order).limit(k)


def patterns(parties: DataFrame, comparable: DataFrame, groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Per party, those without any vote included: counts of positions and of outcomes, and laws compared."""
    position = D.group_position(F.col("yes"), F.col("no"), F.col("abstain"), F.col("position"))
    cast = groups.join(comparable.select("vote_id"), "vote_id", "left_semi").withColumn("side", position)
    a = cast.groupBy("party_id").agg(*[F.count_if(F.col("side") == p).alias(f"position_{p}") for p in POSITIONS])
    b = rows.groupBy("party_id").agg(*[F.count_if(F.col("outcome") == o).alias(f"outcome_{o}") for o in OUTCOMES], F.count_distinct("law_id").alias("compared_laws"))
    out = parties.select("party_id").join(a, "party_id", "left").join(b, "party_id", "left")
    return out.select("party_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in [*a.columns[1:], *b.columns[1:]]])


def finals_else_all(votes: DataFrame) -> DataFrame:
    """Each law's final votes, or all its votes if none is final."""
    return votes.withColumn("any_final", F.bool_or("is_final").over(Window.partitionBy("law_id"))).where("is_final or not any_final").drop("any_final")


def compare_members(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
    """Per poll: members compared and agreeing on (group_key, name_key); both null if a key repeats, none meet, or counts differ."""
    keys = [*by, "group_key", "name_key"]
    side = lambda d, n: d.groupBy(*by).agg(F.count("*").alias(f"{n}_rows"), F.count_distinct("group_key", "name_key").alias(f"{n}_keys"))
    met = left.select(*keys, "vote").join(right.select(*keys, F.col("vote").alias("other")), keys)
    agree = met.groupBy(*by).agg(F.count("*").alias("compared"), F.count_if(F.col("vote") == F.col("other")).alias("matched"))
    out = side(left, "l").join(side(right, "r"), list(by), "full").join(agree, list(by), "left")
    sound = (F.col("l_rows") == F.col("l_keys")) & (F.col("r_rows") == F.col("r_keys")) & (F.col("l_rows") == F.col("r_rows"))
    out = out.select(*by, F.coalesce("l_rows", F.lit(0)).alias("total"), *[F.when(sound & (F.col("compared") > 0), F.col(c)).alias(c) for c in ("compared", "matched")])
    return out.withColumn("status", D.crosscheck_status(F.col("compared"), F.col("matched"), F.col("total")))


def unique_matches(left: DataFrame, right: DataFrame, on: list[str], id_col: str) -> DataFrame:
    """(left id, right id, status): the right row equal in all of `on`; ambiguous if there are several, missing if none."""
    # Right rows are counted before the join: rows that share a key on both sides would meet as pairs.
    tallies = stored(right.groupBy(*on).agg(F.count(id_col).alias("__met"), F.min(id_col).alias("other_id")), "tallies")
    met = left.join(small_or_shuffled(tallies), on, "left").select(id_col, F.coalesce("__met", F.lit(0)).alias("n"), "other_id")
    found = met.groupBy(id_col).agg(F.sum("n").alias("n"), F.min("other_id").alias("other_id"))
    return found.select(id_col, F.when(F.col("n") == 1, F.col("other_id")).alias("other_id"), F.when(F.col("n") == 1, "matched").when(F.col("n") == 0, "missing").otherwise("ambiguous").alias("status"))


def resolve(items: DataFrame, by_reference: DataFrame, by_title: DataFrame, id_col: str) -> DataFrame:
    """(id, target, how): by reference if that names any target, else by title; several targets are ambiguous."""
    first = items.join(by_reference, "reference").groupBy(id_col).agg(F.count("*").alias("n"), F.min("target").alias("target")).withColumn("how", F.lit("reference"))
    rest = items.join(first, id_col, "left_anti")
    second = rest.join(by_title, "title").groupBy(id_col).agg(F.count("*").alias("n"), F.min("target").alias("target")).withColumn("how", F.lit("title"))
    found = items.select(id_col).join(first.unionByName(second), id_col, "left")
    return found.select(id_col, F.when(F.col("n") == 1, F.col("target")).alias("target"), F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").otherwise(F.col("how")).alias("how"))


def ballots(rows: DataFrame, flags: list[str], *by: str) -> DataFrame:
    """Counts by choice of one-hot ballot rows; a row without exactly one mark counts as invalid_row."""
    marks = F.array(*[F.coalesce(F.col(f), F.lit(0)).cast("int") for f in flags])
    choice = F.when(F.aggregate(marks, F.lit(0), lambda a, x: a + x) == 1, F.element_at(F.array(*[F.lit(f) for f in flags]), F.array_position(marks, 1).cast("int"))).otherwise("invalid_row")
    return rows.withColumn("choice", choice).groupBy(*by).agg(*[F.count_if(F.col("choice") == f).alias(f"n_{f}") for f in [*flags, "invalid_row"]])


def coverage_counts(laws: DataFrame, votes: DataFrame, coverage: DataFrame, comparable: DataFrame) -> DataFrame:
    """One row: laws, laws with a public vote, with a final one, compared, with a failed source, and without coverage."""
    n = lambda d: d.agg(F.count_distinct("law_id").alias("n"))
    active = laws.where("review <> 'rejected'").select("law_id")
    public = votes.where("is_public").join(active, "law_id", "left_semi")
    parts = {"laws": n(active), "voted": n(public), "final": n(public.where("is_final")), "compared": n(comparable), "failed": n(coverage.where("status = 'source_error'").join(active, "law_id", "left_semi")), "uncovered": n(active.join(coverage, "law_id", "left_anti"))}
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("measure"), "n")
        out = part if out is None else out.unionByName(part)
    return out
