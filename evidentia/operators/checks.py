"""Constraints of the evidence model as (rule, entity_id) tables; an empty union means a sound store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domain as D
from .evidence import accepted_impacts
from .tables import violations


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def windows(programs: DataFrame) -> DataFrame:
    """Programmes that start before their publication or end before their start."""
    broken = (F.col("published_at") > F.col("period_start")) | (F.col("period_end").isNotNull() & (F.col("period_end") <= F.col("period_start")))
    return violations(programs, "window order", "program_id", F.coalesce(broken, F.lit(True)))


def assessments(criteria: DataFrame, impacts: DataFrame, evidence: DataFrame) -> DataFrame:
    """Scores that don't fit their status, and an agent's evidence that is not accepted or another criterion's."""
    misfit = violations(criteria, "score fits status", "criterion_id", ~D.score_agrees(F.col("status"), F.col("assessed_score")))
    good = accepted_impacts(impacts).select("impact_id", F.col("criterion_id").alias("of"))
    loose = evidence.join(criteria.where("method = 'agent'").select("criterion_id"), "criterion_id", "left_semi").join(good, "impact_id", "left")
    return misfit.unionByName(violations(loose, "evidence accepted and own", "impact_id", ~F.coalesce(F.col("of") == F.col("criterion_id"), F.lit(False))).distinct())


def impacts_in_window(impacts: DataFrame, criteria: DataFrame, laws: DataFrame, programs: DataFrame) -> DataFrame:
    """Impacts whose criterion or law is missing, or whose law lies outside the programme's window."""
    c = criteria.select("criterion_id", "program_id").join(F.broadcast(programs.select("program_id", "period_start", "period_end")), "program_id")
    # Laws first, as impacts are grouped by law; both rules are read off one pass, as no impact breaks both.
    rows = impacts.select("impact_id", "criterion_id", "law_id").join(laws.select("law_id", "published_at"), "law_id", "left").join(c, "criterion_id", "left")
    dangling = F.col("program_id").isNull() | F.col("published_at").isNull()
    inside = F.coalesce(D.in_window(F.col("published_at"), F.col("period_start"), F.col("period_end")), F.lit(False))
    rule = F.when(dangling, "impact dangles").when(~inside, "law in window")
    return rows.select(rule.alias("rule"), F.col("impact_id").cast("string").alias("entity_id")).where("rule is not null")


def votes(all_votes: DataFrame, laws: DataFrame, groups: DataFrame, parties: DataFrame) -> DataFrame:
    """Votes after publication, groups of no party, and groups with some of their counts unknown."""
    late = all_votes.join(laws.select("law_id", "published_at"), "law_id")
    stray = groups.join(parties.select("party_id"), "party_id", "left_anti")
    known = [F.col(c).isNotNull().cast("int") for c in ("yes", "no", "abstain", "absent")]
    some = (known[0] + known[1] + known[2] + known[3]).between(1, 3)
    key = F.concat_ws(":", "vote_id", "party_id")
    return union(violations(late, "vote before publication", "vote_id", F.col("vote_date") > F.col("published_at")), violations(stray, "group has party", "vote_id", F.lit(True)).distinct(), violations(groups.withColumn("k", key), "counts all or none", "k", some))


def members_reconcile(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Counts of members by vote, group and choice that differ from the group's stated counts."""
    choices = ["yes", "no", "abstain", "absent"]
    counted = members.groupBy("vote_id", "party_id").agg(*[F.count_if(F.col("choice") == c).alias(f"m_{c}") for c in choices])
    both = groups.where("yes is not null").join(counted, ["vote_id", "party_id"]).withColumn("k", F.concat_ws(":", "vote_id", "party_id"))
    differ = F.lit(False)
    for c in choices:
        differ = differ | (F.col(c) != F.col(f"m_{c}"))
    return violations(both, "members reconcile", "k", differ)


def judgments(pairs: DataFrame) -> DataFrame:
    """Pairs (key, supported, disposition, score, law_quote, criterion_quote) whose fields don't go together."""
    linked = F.col("disposition").isin("proposed_link", "preserved_link")
    full = F.col("score").isNotNull() & (F.length(F.coalesce("law_quote", F.lit(""))) >= 10) & (F.length(F.coalesce("criterion_quote", F.lit(""))) >= 10)
    return union(violations(pairs, "supported means linked", "key", F.col("supported") != linked), violations(pairs, "a link has score and quotes", "key", linked & ~full), violations(pairs, "no score without link", "key", ~linked & F.col("score").isNotNull()))


def spans(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """Leaves (doc_id, leaf_id, page, line_start, line_end, quote) that their document's lines (doc_id, line_no, text, page) don't bear out."""
    cited = leaves.join(lines.withColumnRenamed("page", "actual"), "doc_id").where(F.col("line_no").between(F.col("line_start"), F.col("line_end")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    whole = cited.groupBy("doc_id", "leaf_id", "page", "quote").agg(text.alias("cited"), F.min("actual").alias("first"), F.max("actual").alias("last"))
    absent = leaves.join(cited.select("doc_id", "leaf_id"), ["doc_id", "leaf_id"], "left_anti")
    wrong_page = ~(F.col("first").eqNullSafe(F.col("page")) & F.col("last").eqNullSafe(F.col("page")))
    return union(violations(whole, "quote in lines", "leaf_id", ~F.contains("cited", "quote")), violations(whole, "page of lines", "leaf_id", wrong_page), violations(absent, "lines exist", "leaf_id", F.lit(True)))


def page_of_line(lines: DataFrame, marker: Column) -> DataFrame:
    """lines (doc_id, line_no, text) with page: the last marker at or before the line, or null before the first."""
    upto = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("page", F.last(marker, ignorenulls=True).over(upto))


def tree_covers(tree: DataFrame, leaves: DataFrame) -> DataFrame:
    """Leaves that a tree (program_id, node_id, leaf_id) names never or more than once, and node ids of no leaf."""
    n = tree.groupBy("program_id", "leaf_id").agg(F.count("*").alias("n"))
    both = leaves.select("program_id", "leaf_id").withColumn("is_leaf", F.lit(1)).join(n, ["program_id", "leaf_id"], "full")
    rule = F.when(F.col("is_leaf").isNull(), "no such leaf").when(F.col("n").isNull(), "leaf not in tree").when(F.col("n") > 1, "leaf twice in tree")
    return both.select(rule.alias("rule"), F.col("leaf_id").cast("string").alias("entity_id")).where("rule is not null")


def tiles(ranges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Documents whose ranges (doc_id, start, end; inclusive) don't tile 0 to size - 1 in order without gap or overlap."""
    w = Window.partitionBy("doc_id").orderBy("start", "end")
    steps = ranges.withColumn("due", F.coalesce(F.lag("end").over(w), F.lit(-1)) + 1)
    per = steps.groupBy("doc_id").agg(F.bool_and((F.col("start") == F.col("due")) & (F.col("end") >= F.col("start"))).alias("even"), F.max("end").alias("last"))
    both = sizes.join(per, "doc_id", "left")
    return violations(both, "ranges tile the document", "doc_id", ~F.coalesce(F.col("even") & (F.col("last") == F.col("size") - 1), F.col("size") == 0))


def catalogue(sources: DataFrame) -> DataFrame:
    """Sources (id, published_at, period_start, permission, textless array, pages) with a field that may not be."""
    inside = F.forall(F.coalesce("textless", F.array().cast("array<int>")), lambda p: (p >= 1) & (p <= F.col("pages")))
    distinct = F.size(F.array_distinct("textless")) == F.size("textless")
    return union(
        violations(sources, "textless pages in range", "id", ~F.coalesce(inside, F.lit(False))), violations(sources, "textless pages once", "id", ~F.coalesce(distinct, F.lit(True))),
        violations(sources, "permission stated", "id", F.coalesce(F.trim("permission"), F.lit("")) == ""), violations(sources, "published before period", "id", F.col("published_at") > F.col("period_start")),
    )


def cliques(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Groups (group_id, id) with two members that no pair (left_id, right_id) links; expected pairs are counted, not made."""
    g = groups.select("group_id", "id")
    linked = pairs.join(g.select(F.col("id").alias("left_id"), "group_id"), "left_id").join(g.select(F.col("id").alias("right_id"), F.col("group_id").alias("other")), "right_id").where("group_id = other")
    have = linked.select("group_id", "left_id", "right_id").distinct().groupBy("group_id").agg(F.count("*").alias("have"))
    need = g.groupBy("group_id").agg((F.count("*") * (F.count("*") - 1) / 2).cast("long").alias("need"))
    return violations(need.join(have, "group_id", "left"), "group is a clique", "group_id", F.coalesce("have", F.lit(0)) < F.col("need"))
