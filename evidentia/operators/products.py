"""Reports, transitions and browsing products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.domain import accepted
from ..functions.vote_wordings import ROLL_CALL_ABBREVIATED, ROLL_CALL_NUMBERED, ROLL_CALL_PARTS, ROLL_CALL_WORDS, phrases


def experiment_totals(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row: pairs by disposition, laws completed, groups, and those with several members."""
    p = pairs.agg(F.count("*").alias("candidate_pairs"), F.count_if(F.col("linked")).alias("links"), F.count_if(F.col("disposition") == "missing_context").alias("missing_context"), F.count_if(F.col("disposition") == "no_supported_link").alias("unsupported"))
    g = groups.groupBy("group_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("criteria"), F.count("*").alias("grouped"), F.count_if(F.col("n") > 1).alias("combined"))
    return p.join(g, F.lit(True))  # one row each


def overview(parties: DataFrame, programs: DataFrame, outcomes: DataFrame, laws: DataFrame) -> DataFrame:
    """(measure, n): parties with a programme, criteria, covered ones, and laws."""
    own = outcomes.join(programs.where("review <> 'rejected'").select("program_id"), "program_id", "left_semi")
    held = programs.where("review <> 'rejected'").join(parties.select("party_id"), "party_id", "left_semi")
    rows = [("parties", held.agg(F.count_distinct("party_id").alias("n"))), ("criteria", own.agg(F.count("*").alias("n"))), ("covered", own.agg(F.count_if("covered").alias("n"))), ("laws", laws.agg(F.count("*").alias("n")))]
    out = None
    for name, part in rows:
        part = part.select(F.lit(name).alias("measure"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def last_assessed(criteria: DataFrame, evidence: DataFrame, impacts: DataFrame, *by: str) -> DataFrame:
    """Per group the latest assessed_at of assessed criteria all of whose evidence, at least one piece, is accepted."""
    good = impacts.where(accepted(F.col("review"), F.col("evaluation"))).select("impact_id", F.lit(True).alias("good"))
    proof = evidence.join(good, "impact_id", "left").groupBy("criterion_id").agg(F.bool_and(F.coalesce("good", F.lit(False))).alias("proven"))
    rows = criteria.where("status <> 'unassessed'").join(proof.where("proven"), "criterion_id", "left_semi")
    return rows.groupBy(*by).agg(F.max("assessed_at").alias("last_assessed_at"))


def decisions(prior: DataFrame, drafts: DataFrame) -> DataFrame:
    """What final decisions do to links: (key, disposition, impact, invalidates).

    prior (key, review): existing links; drafts (key, outcome). A corrected link is preserved; an accepted decision
    proposes or renews one; another decision on an existing link keeps it as an audit record only.
    """
    both = drafts.join(prior.select("key", F.col("review").alias("prior_review")), "key", "left")
    kept = F.col("prior_review").isNotNull() & (F.col("prior_review") != "proposed")
    disposition = F.when(kept, "preserved_link").when(F.col("outcome") == "accepted", "proposed_link").when(F.col("outcome") == "missing_context", "missing_context").otherwise("no_supported_link")
    impact = F.when(kept, "unchanged").when(F.col("outcome") == "accepted", F.when(F.col("prior_review").isNull(), "created").otherwise("renewed")).when(F.col("prior_review").isNotNull(), "superseded")
    return both.select("key", disposition.alias("disposition"), impact.alias("impact"), (~kept).alias("invalidates"))


def law_coverage(official: DataFrame, imported: DataFrame, inventory_until: Column, requested: Column) -> DataFrame:
    """One row: official and imported entries, pending ones, entries beyond the inventory, as_of, and whether it is complete."""
    as_of = F.least(inventory_until, requested)
    rows = official.withColumn("as_of", as_of).join(imported.select("law_id").distinct().withColumn("got", F.lit(1)), "law_id", "left")
    inside = F.col("published_at") <= F.col("as_of")
    out = rows.agg(F.max("as_of").alias("as_of"), F.count_if(inside).alias("official"), F.count_if(inside & F.col("got").isNotNull()).alias("imported"), F.count_if(inside & F.col("got").isNull()).alias("pending"), F.count_if(~inside).alias("beyond"))
    return out.withColumn("complete", F.col("pending") == 0)


def pilot_leaves(leaves: DataFrame, terms: list[str], *, each: int = 2, least: int = 80) -> DataFrame:
    """Leaves (doc_id, pos, text): for each term and document the first ones of some length that hold it, each once."""
    listed = F.array(*[F.lit(t.lower()) for t in terms])
    found = leaves.where(F.length("text") >= least).select("doc_id", "pos", F.explode(F.filter(listed, lambda t: F.contains(F.lower("text"), t))).alias("term"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "term").orderBy("pos"))
    return found.withColumn("nth", nth).where(F.col("nth") <= each).select("doc_id", "pos").distinct()


def cited_groups(blocks: DataFrame) -> DataFrame:
    """blocks (doc_id, pos, page, line_start, line_end) with group: a new one at a page change or an overlap of lines."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    new = (F.col("page") != F.lag("page").over(w)) | (F.col("line_start") <= F.lag("line_end").over(w))
    return blocks.withColumn("new", F.coalesce(new.cast("int"), F.lit(0))).withColumn("group", F.sum("new").over(w)).drop("new")


def section_anchors(leaves: DataFrame) -> DataFrame:
    """(doc_id, pos, page, anchor) where a leaf (doc_id, pos, page, section) enters a section; later entries are numbered."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    entered = leaves.where(F.col("section").isNotNull()).withColumn("before", F.lag("section").over(w)).where(~F.col("section").eqNullSafe(F.col("before")))
    nth = F.row_number().over(Window.partitionBy("doc_id", "section").orderBy("pos"))
    rows = entered.withColumn("nth", nth)
    return rows.select("doc_id", "pos", "page", F.when(F.col("nth") == 1, F.col("section")).otherwise(F.concat(F.col("section"), F.lit("-continuation-"), F.col("nth"))).alias("anchor"))


def page_annotations(criteria: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Criteria by page (doc_id, page, n, ids), and those that cite a page the document lacks."""
    by_page = criteria.groupBy("doc_id", "page").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("criterion_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return by_page, criteria.join(pages.select("doc_id", "page"), ["doc_id", "page"], "left_anti")


def whole_law_roll_call(motion: Column, title: Column, numbers: Column) -> Column:
    """Whether a roll call is on all of a bill: its numbers are named, and no part, amendment or resolution is."""
    both = F.concat_ws(" ", title, motion)
    part = both.rlike(phrases(ROLL_CALL_PARTS, whole=False, case=False)) | both.rlike(phrases(ROLL_CALL_WORDS, case=False))
    numbered = both.rlike(phrases(ROLL_CALL_NUMBERED, case=False) + r"\s+\w") | both.rlike(phrases(ROLL_CALL_ABBREVIATED, whole=False, case=False) + r"\s*\d")
    named = (F.size(numbers) > 0) & (F.size(F.array_except(numbers, T.document_numbers(motion))) == 0) & F.contains(motion, F.lit("Gesetzentwurf"))
    return F.coalesce(named & ~part & ~numbered, F.lit(False))


def motion_references(context: Column) -> Column:
    """Document numbers of the sentence with the last recommendation, or of the whole text without one."""
    before = F.regexp_extract(context, r"(?s)^(.*)\bempfiehlt\b", 1)
    last = T.bound(before, lambda b: F.substring(context, F.length(b) - F.length(F.substring_index(b, ". ", -1)) + 1, F.length(context)))
    return T.document_numbers(F.when(F.contains(context, F.lit("empfiehlt")), last).otherwise(context))


def vote_ladder(positions: DataFrame) -> DataFrame:
    """(vote_id, type, status) by the best evidence: named ballots, announced groups, or the record of the decision only."""
    kind = F.when(F.col("ballots") > 0, "roll_call").when(F.col("announced") > 0, "group_record").otherwise("plenary_record")
    status = F.when(F.col("ballots") > 0, "roll_call_found").when(F.col("named_vote"), "roll_call_unmatched").when(~F.col("whole_law"), "partial_law").when(~F.col("has_transcript"), "no_structured_transcript").when(F.col("announced") > 0, "groups_found").otherwise("no_explicit_groups")
    return positions.select("vote_id", kind.alias("type"), status.alias("status"))


def comparable_rule(positions: DataFrame) -> DataFrame:
    """positions (law_id, vote_id, day, match, stage, scope, mediation, tenor) with comparable: the law's last final passage, officially matched, whole, unmediated and adopted."""
    last = F.max(F.when(F.col("stage") == "final_passage", F.col("day"))).over(Window.partitionBy("law_id"))
    rule = (F.col("match") == "official_reference") & (F.col("stage") == "final_passage") & (F.col("scope") == "whole_law") & (F.col("day") == last) & ~F.col("mediation") & F.startswith("tenor", F.lit("Annahme"))
    return positions.withColumn("comparable", F.coalesce(rule, F.lit(False)))


def preferred_transcript(positions: DataFrame, open_data: DataFrame, linked: DataFrame) -> DataFrame:
    """(position_id, url, reason): the open-data transcript, else the linked one with the reason for falling back."""
    rows = positions.join(open_data.select("term", "sitting", F.col("url").alias("open_url")), ["term", "sitting"], "left").join(linked.select("position_id", F.col("url").alias("linked_url")), "position_id", "left")
    reason = F.when(F.col("open_url").isNotNull(), F.lit(None)).when(F.col("linked_url").isNotNull(), "not in the open-data index").otherwise("no structured transcript")
    return rows.select("position_id", F.coalesce("open_url", "linked_url").alias("url"), reason.cast("string").alias("reason"))


def page_texts(pages: DataFrame, textless: DataFrame) -> DataFrame:
    """pages (doc_id, page, markdown, native) with text: the Markdown, else the native text; empty pages that are not known to be so are an error."""
    rows = pages.withColumn("text", F.coalesce(F.nullif(F.trim("markdown"), F.lit("")), F.nullif(F.trim("native"), F.lit("")), F.lit("")))
    rows = rows.join(textless.select("doc_id", "page").distinct().withColumn("may", F.lit(True)), ["doc_id", "page"], "left")
    fault = F.raise_error(F.concat(F.lit("unexpected empty page "), F.col("page").cast("string"))).cast("string")
    return rows.withColumn("text", F.when((F.col("text") == "") & F.col("may").isNull(), fault).otherwise(F.col("text"))).drop("may")


def publishable(sources: DataFrame) -> DataFrame:
    """Sources with a stated basis for publication; others are an error and never pass silently."""
    fault = F.raise_error(F.concat(F.lit("no publication basis: "), F.col("id"))).cast("string")
    return sources.withColumn("permission", F.when(F.coalesce(F.trim("permission"), F.lit("")) == "", fault).otherwise(F.col("permission")))


def poll_matches(polls: DataFrame, term: Column, day: Column, numbers: Column, adopted: Column, host: str) -> DataFrame:
    """polls (poll_id, date, adopted, legislature, url, intro) of one vote: same day, result and term, and the first official link of its first paragraph is to one of the numbers."""
    lead = F.regexp_extract("intro", r"(?is)<p\b[^>]*>(.*?)(?:</p\s*>|$)", 1)
    official = F.filter(F.regexp_extract_all(lead, F.lit(r"(?is)<a\b[^>]*\bhref[^>]*>.*?</a\s*>"), F.lit(0)), lambda a: a.rlike(r"""(?is)^<a\b[^>]*\bhref\s*=\s*["']https://dserver\.bundestag\.de(?:/|["'])"""))
    link = F.get(official, F.lit(0))
    paper = r"""^/btd/(\d{2})/\d{3}/\1(\d{5})\.pdf$"""
    target = F.try_parse_url(F.regexp_extract(link, r"""(?is)\bhref\s*=\s*["']([^"']*)["']""", 1), F.lit("PATH"))
    cited = F.concat_ws("/", F.regexp_extract(target, paper, 1).try_cast("int"), F.nullif(F.regexp_extract(target, paper, 2), F.lit("")).try_cast("int"))
    label = F.regexp_replace(link, r"<[^>]*>", "")
    path = F.concat(F.lit("/bundestag/"), term, F.lit("/abstimmungen/"))
    rule = (F.col("date") == day) & (F.col("adopted") == adopted) & F.startswith("legislature", F.lit("Bundestag ")) & (F.try_parse_url("url", F.lit("HOST")) == host) & F.startswith(F.try_parse_url("url", F.lit("PATH")), path)
    return polls.where(rule & F.array_contains(numbers, cited) & F.lower(label).contains("gesetzentwurf"))


def progress_label() -> Column:
    return F.format_string("%d gesetzlich umgesetzt, %d teilweise umgesetzt, %d widersprochen, %d gemischte Wirkung, %d offen", *[F.col(c) for c in ("fulfilled", "partial", "contradicted", "mixed", "unassessed")])


def concept_checks(answers: DataFrame, concepts: DataFrame) -> DataFrame:
    """Per case: concepts (case_id, name, pattern) found in any of its answers (case_id, text), of all it should have."""
    hit = concepts.join(answers, "case_id", "left").groupBy("case_id", "name").agg(F.coalesce(F.bool_or(F.expr("text rlike pattern")), F.lit(False)).alias("hit"))
    return hit.groupBy("case_id").agg(F.count_if("hit").alias("passed"), F.count("*").alias("total"))
