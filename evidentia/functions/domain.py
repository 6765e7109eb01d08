"""Decision expressions of the evidence model: positions, outcomes, stages, statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vote_wordings import SIDES, phrases


def accepted(review: Column, evaluation: Column) -> Column:
    """Evidence counts if it is not rejected, and either reviewed or accepted by the final evaluation; null counts as no."""
    return (F.coalesce(review, F.lit("")) != "rejected") & ((F.coalesce(review, F.lit("")) == "reviewed") | (F.coalesce(evaluation, F.lit("")) == "accepted"))


def in_window(day: Column, start: Column, end: Column, published: Column | None = None) -> Column:
    """Half-open window; an unknown end is open. With published, the day must not precede it."""
    inside = (day >= start) & (end.isNull() | (day < end))
    return inside & (day >= published) if published is not None else inside


def group_position(yes: Column, no: Column, abstain: Column, documented: Column) -> Column:
    """The one direction with votes, mixed if several, unknown if none; the documented position if counts are unknown."""
    counted = yes.isNotNull() & no.isNotNull() & abstain.isNotNull()
    sides = (yes > 0).cast("int") + (no > 0).cast("int") + (abstain > 0).cast("int")
    single = F.when(yes > 0, "yes").when(no > 0, "no").otherwise("abstain")
    return F.when(counted, F.when(sides == 0, "unknown").when(sides > 1, "mixed").otherwise(single)).otherwise(F.coalesce(documented, F.lit("unknown")))


def comparison_outcome(position: Column, score: Column, counted: Column) -> Column:
    """How a position relates to a signed effect; the order of the cases matters."""
    agree = ((position == "yes") & (score > 0)) | ((position == "no") & (score < 0))
    return (
        F.when(position == "unknown", F.when(counted, "neutral").otherwise("unknown"))
        .when(position == "abstain", "neutral").when(score == 0, "contextual").when(position == "mixed", "mixed")
        .when(agree, "consistent").otherwise("tension")
    )


def law_direction(supporting: Column, opposing: Column, neutral: Column) -> Column:
    return F.when((neutral > 0) | ((supporting > 0) & (opposing > 0)), "mixed").when(opposing > 0, "opposing").otherwise("supporting")


def decision_stage(tenor: Column, reading: Column) -> Column:
    """Stage of a decision by its wording and reading."""
    t = F.lower(F.coalesce(tenor, F.lit("")))
    r = F.coalesce(reading, F.lit(""))
    return (
        F.when(t.contains("entschließung"), "resolution").when(t.contains("änderungsantrag") | t.contains("änderungsanträge"), "amendment")
        .when(~(t.startswith("annahme") | t.startswith("ablehnung")), "procedural").when(r.contains("3.") | r.contains("Schlussabstimmung"), "final_passage")
        .when(r.contains("2."), "second_reading").otherwise("unknown")
    )


def decision_scope(tenor: Column, remark: Column) -> Column:
    """Whether a decision names a part of the law."""
    parts = r"(?iU)\b(?:Artikel|Art\.|Einzelpl(?:an|äne)|Buchstabe|Ziffer|Nummer|übrig\w*|Teile)\b"
    return F.when(F.concat_ws(" ", F.coalesce(tenor, F.lit("")), F.coalesce(remark, F.lit(""))).rlike(parts), "partial_law").otherwise("whole_law")


def prompt_position(prompt: Column) -> Column:
    """Which side a chair's question asks for: the first of which it has a part of a word, a word, or the last word."""

    def named(stems: list[str], whole: list[str], last: list[str]) -> Column:
        found = prompt.rlike(phrases(stems, whole=False, case=False))
        found = found | prompt.rlike(phrases(whole, case=False)) if whole else found
        return found | prompt.rlike(phrases(last, case=False) + r"\W*$") if last else found

    return F.coalesce(*[F.when(named(*words), side) for side, words in SIDES.items()])


def crosscheck_status(compared: Column, matched: Column, total: Column) -> Column:
    return F.when(compared.isNull() | matched.isNull(), "unmatched").when(compared != matched, "mismatch").when(compared == total, "matched").otherwise("partial")


def matching_status(has_text: Column, programs: Column, candidates: Column, completed: Column, links: Column) -> Column:
    return F.when(~has_text, "needs_ocr").when(programs == 0, "no_programs").when(candidates == 0, "no_candidates").when(completed < candidates, "pending").when(links > 0, "proposed").otherwise("no_supported_links")


def score_agrees(status: Column, score: Column) -> Column:
    """Whether an assessment's score fits its status."""
    fits = F.when(status == "fulfilled", score == 2).when(status == "partial", score == 1).when(status == "contradicted", score < 0).when(status == "mixed", score == 0)
    return F.coalesce(F.when(status == "unassessed", score.isNull()).otherwise(fits), F.lit(False))


def retryable(code: Column) -> Column:
    """Whether a provider's status code is worth another attempt."""
    return F.coalesce(code.isin(408, 409, 425, 429) | (code >= 500), F.lit(False))


def group_preview(label: Column, yes: Column, no: Column, abstain: Column, position: Column) -> Column:
    counted = F.format_string("%s: %d/%d/%d", label, yes, no, abstain)
    return F.when(yes.isNotNull() & no.isNotNull() & abstain.isNotNull(), counted).otherwise(F.concat_ws(": ", label, F.coalesce(position, F.lit("unknown"))))


def page_links(page: Column, pages: Column) -> Column:
    """At most seven page controls; -1 stands for a gap."""
    gap = F.lit(-1)
    near_start = F.array(*[F.lit(i) for i in range(1, 6)], gap, pages)
    near_end = F.array(F.lit(1), gap, *[pages - i for i in range(4, -1, -1)])
    middle = F.array(F.lit(1), gap, page - 1, page, page + 1, gap, pages)
    return F.when(pages <= 7, F.sequence(F.lit(1), pages)).when(page <= 4, near_start).when(page >= pages - 3, near_end).otherwise(middle)
