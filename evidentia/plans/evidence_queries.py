"""Evidence, metrics, timelines and votes on the evidence model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import domain as D
from ..operators import evidence as E
from ..operators import retrieval as R
from ..operators import votes as V
from ..session import task_count
from ..tables import load, model
from .registry import query

OK = "review <> 'rejected' AND (review = 'reviewed' OR evaluation = 'accepted')"


def m(spark, sf_dir, *names):
    return [model(spark, sf_dir, n) for n in names]


@query(f"SELECT impact_id, law_id, criterion_id, score FROM impact WHERE {OK}", "impact")
def accepted_evidence(spark, sf_dir):
    """FIL-01, SNK-06."""
    return E.accepted_impacts(model(spark, sf_dir, "impact")).select("impact_id", "law_id", "criterion_id", "score")


@query("""SELECT p.program_id, count(DISTINCT l.law_id) AS laws, count(*) AS pairs, count(DISTINCT c.criterion_id) AS criteria FROM law l JOIN program p ON l.published_at >= p.period_start AND (p.period_end IS NULL OR l.published_at < p.period_end)
  JOIN criterion c ON c.program_id = p.program_id WHERE l.review <> 'rejected' AND p.review <> 'rejected' AND c.review <> 'rejected' GROUP BY p.program_id""", "law", "program", "criterion")
def eligibility_window(spark, sf_dir):
    """JOIN-01, FIL-03: pairs of laws and criteria whose programme was in force, counted by programme without being made."""
    laws, criteria, programs = m(spark, sf_dir, "law", "criterion", "program")
    live = programs.where("review <> 'rejected'").select("program_id", "period_start", "period_end")
    in_force = laws.where("review <> 'rejected'").join(F.broadcast(live), D.in_window(F.col("published_at"), F.col("period_start"), F.col("period_end")))
    by_law = in_force.groupBy("program_id").agg(F.count("*").alias("laws"))
    by_criterion = criteria.where("review <> 'rejected'").groupBy("program_id").agg(F.count("*").alias("criteria"))
    return by_law.join(by_criterion, "program_id").select("program_id", "laws", (F.col("laws") * F.col("criteria")).alias("pairs"), "criteria")


@query("""SELECT i.impact_id, l.law_id, c.criterion_id FROM impact i JOIN law l ON i.law_id = l.law_id JOIN criterion c ON c.criterion_id = i.criterion_id JOIN program p ON p.program_id = c.program_id
  WHERE l.published_at >= p.period_start AND (p.period_end IS NULL OR l.published_at < p.period_end) AND l.review <> 'rejected' AND p.review <> 'rejected' AND c.review <> 'rejected'""", "impact", "law", "criterion", "program")
def eligible_impacts(spark, sf_dir):
    """FIL-03, JOIN-01: impacts whose pair of law and criterion is eligible."""
    impacts, laws, criteria, programs = m(spark, sf_dir, "impact", "law", "criterion", "program")
    return R.eligible_only(impacts.select("impact_id", "law_id", "criterion_id"), laws, criteria, programs)


OUT = f"""good AS (SELECT * FROM impact WHERE {OK}),
  proof AS (SELECT e.criterion_id, bool_and(coalesce(g.criterion_id = e.criterion_id, false)) AS proven FROM evidence e LEFT JOIN good g USING (impact_id) GROUP BY 1),
  strong AS (SELECT criterion_id, bool_or(evaluation = 'accepted') AS evaluated FROM good GROUP BY 1),
  outcome AS (SELECT c.criterion_id, c.program_id, method = 'agent' AND coalesce(proven, false) AS automatic, c.review = 'reviewed' AND p.review = 'reviewed' AS reviewed,
    coalesce(evaluated, false) OR (s.criterion_id IS NOT NULL AND c.review = 'reviewed') AS covered, c.status AS stated, assessed_score
    FROM criterion c JOIN program p ON p.program_id = c.program_id LEFT JOIN proof ON proof.criterion_id = c.criterion_id LEFT JOIN strong s ON s.criterion_id = c.criterion_id WHERE c.review <> 'rejected' AND p.review <> 'rejected'),
  o AS (SELECT criterion_id, program_id, CASE WHEN automatic OR reviewed THEN stated ELSE 'unassessed' END AS status, automatic, reviewed, covered, CASE WHEN automatic THEN assessed_score END AS score FROM outcome)"""
TABLES = ("impact", "evidence", "criterion", "program")


def _outcomes(spark, sf_dir):
    criteria, programs, impacts, evidence = m(spark, sf_dir, "criterion", "program", "impact", "evidence")
    return E.outcomes(criteria, programs, impacts, evidence)


def _register():
    from . import registry
    from ..tables import with_model

    def add(name, f, select, extra=()):
        registry.QUERIES[name] = f
        registry.SQL[name] = with_model("", *TABLES, *extra).rstrip() + ", " + OUT + " " + select

    def criterion_outcomes(spark, sf_dir):
        """AGG-01."""
        return _outcomes(spark, sf_dir)

    def program_metrics(spark, sf_dir):
        """AGG-02, AGG-24."""
        return E.metrics(_outcomes(spark, sf_dir), "program_id")

    def topic_progress(spark, sf_dir):
        """AGG-07, AGG-08, WIN-06."""
        return E.topic_progress(_outcomes(spark, sf_dir), model(spark, sf_dir, "criterion_tag"))

    add("criterion_outcomes", criterion_outcomes, "SELECT * FROM o")
    add("program_metrics", program_metrics, """SELECT program_id, total, reviewed, fulfilled, partial, contradicted, mixed, total - fulfilled - partial - contradicted - mixed AS unknown, covered, automated, scored,
      floor(mean * 100 + 0.5) / 100 AS alignment, CAST(floor(covered * 100.0 / total + 0.5) AS INT) AS coverage, CAST(floor(fulfilled * 100.0 / total + 0.5) AS INT) AS fulfilment, round((fulfilled + partial) * 100.0 / total, 6) AS implemented
      FROM (SELECT program_id, count(*) AS total, count_if(reviewed) AS reviewed, count_if(status = 'fulfilled') AS fulfilled, count_if(status = 'partial') AS partial, count_if(status = 'contradicted') AS contradicted, count_if(status = 'mixed') AS mixed,
        count_if(covered) AS covered, count_if(automatic) AS automated, count(score) AS scored, avg(score) AS mean FROM o GROUP BY program_id)""")
    add("topic_progress", topic_progress, """SELECT *, row_number() OVER (ORDER BY covered DESC, total DESC, tag) AS rank FROM (SELECT tag, count(*) AS total, count_if(covered) AS covered, count_if(status = 'fulfilled') AS fulfilled, count_if(status = 'partial') AS partial, count_if(status = 'contradicted') AS contradicted,
      count_if(status = 'mixed') AS mixed, count_if(status NOT IN ('fulfilled', 'partial', 'contradicted', 'mixed')) AS unassessed FROM (SELECT DISTINCT * FROM criterion_tag) JOIN o USING (criterion_id) GROUP BY tag)""", ("criterion_tag",))


INS = f"""ins AS (SELECT i.impact_id, c.party_id, c.program_id, i.criterion_id, i.law_id, l.published_at AS day, i.score, p.period_start FROM impact i JOIN criterion c ON c.criterion_id = i.criterion_id JOIN program p ON p.program_id = c.program_id JOIN law l ON l.law_id = i.law_id
  WHERE i.{OK.replace('(review', '(i.review').replace('OR evaluation', 'OR i.evaluation')} AND c.review <> 'rejected' AND p.review <> 'rejected' AND l.review <> 'rejected' AND l.published_at >= p.period_start AND (p.period_end IS NULL OR l.published_at < p.period_end) AND l.published_at >= p.published_at
  AND (i.evaluation = 'accepted' OR (c.review = 'reviewed' AND p.review = 'reviewed')))"""


def _tasks(spark, sf_dir):
    """Tasks of what has at most a row for each line item."""
    return task_count(load(spark, sf_dir, "lineitem"))


def _insights(spark, sf_dir):
    """The impacts, and how many tasks they are worth."""
    impacts, criteria, laws, programs = m(spark, sf_dir, "impact", "criterion", "law", "program")
    tasks = _tasks(spark, sf_dir)
    return E.insight_impacts(impacts, criteria, laws, programs, tasks), tasks


def law_effects(spark, sf_dir):
    """AGG-04, AGG-05, DOM-04."""
    return E.law_effects(*_insights(spark, sf_dir))


def timeline_cumulative(spark, sf_dir):
    """WIN-03."""
    return E.timeline(*_insights(spark, sf_dir))


def timeline_jumps(spark, sf_dir):
    """WIN-04."""
    rows, tasks = _insights(spark, sf_dir)
    return E.timeline_jumps(rows, tasks=tasks)


def first_evidence_exclusive(spark, sf_dir):
    """AGG-05, AGG-06: laws of each party that were first for some criterion, alone or shared, and all its laws."""
    e = E.law_effects(*_insights(spark, sf_dir))
    return e.groupBy("party_id").agg(F.count("*").alias("laws"), F.count_if(F.col("newly_covered") > 0).alias("exclusive"), F.count_if(F.col("shared") > 0).alias("sharing"), *[F.count_if(F.col("direction") == d).alias(d) for d in ("supporting", "opposing", "mixed")])


EFFECTS = """f AS (SELECT party_id, criterion_id, min(day) AS first FROM ins GROUP BY ALL), a AS (SELECT party_id, criterion_id, count(DISTINCT law_id) AS laws FROM ins JOIN f USING (party_id, criterion_id) WHERE day = first GROUP BY ALL),
  x AS (SELECT * FROM ins JOIN f USING (party_id, criterion_id) JOIN a USING (party_id, criterion_id)),
  e AS (SELECT party_id, law_id, day, count(DISTINCT criterion_id) AS affected, count(DISTINCT CASE WHEN score > 0 THEN criterion_id END) AS supporting, count(DISTINCT CASE WHEN score < 0 THEN criterion_id END) AS opposing, count(DISTINCT CASE WHEN score = 0 THEN criterion_id END) AS neutral,
    count(DISTINCT CASE WHEN day = first AND laws = 1 THEN criterion_id END) AS newly_covered, count(DISTINCT CASE WHEN day = first AND laws > 1 THEN criterion_id END) AS shared FROM x GROUP BY ALL),
  effect AS (SELECT *, CASE WHEN neutral > 0 OR (supporting > 0 AND opposing > 0) THEN 'mixed' WHEN opposing > 0 THEN 'opposing' ELSE 'supporting' END AS direction FROM e)"""

TIMELINE = """f AS (SELECT party_id, criterion_id, min(day) AS day FROM ins GROUP BY ALL), fc AS (SELECT party_id, day, count(*) AS new_covered FROM f GROUP BY ALL),
  g AS (SELECT party_id, criterion_id, min(day) AS day FROM ins WHERE score < 0 GROUP BY ALL), gc AS (SELECT party_id, day, count(*) AS new_opposed FROM g GROUP BY ALL),
  d AS (SELECT party_id, day, false AS baseline, count(*) AS n, count(DISTINCT law_id) AS laws, count_if(score = -2) AS s0, count_if(score = -1) AS s1, count_if(score = 0) AS s2, count_if(score = 1) AS s3, count_if(score = 2) AS s4 FROM ins GROUP BY party_id, day
    UNION ALL SELECT party_id, min(period_start) - 1, true, 0, 0, 0, 0, 0, 0, 0 FROM ins GROUP BY party_id),
  t AS (SELECT party_id, day, baseline, laws, coalesce(new_covered, 0) AS new_covered, coalesce(new_opposed, 0) AS new_opposed, n, s0, s1, s2, s3, s4 FROM d LEFT JOIN fc USING (party_id, day) LEFT JOIN gc USING (party_id, day))
  SELECT party_id, CAST(day AS DATE) AS day, baseline, laws, new_covered, new_opposed, CAST(sum(new_covered) OVER w AS BIGINT) AS covered, CAST(sum(new_opposed) OVER w AS BIGINT) AS opposed, CAST(sum(n) OVER w AS BIGINT) AS impacts, CAST(sum(s0) OVER w AS BIGINT) AS score_m2, CAST(sum(s1) OVER w AS BIGINT) AS score_m1,
    CAST(sum(s2) OVER w AS BIGINT) AS score_0, CAST(sum(s3) OVER w AS BIGINT) AS score_p1, CAST(sum(s4) OVER w AS BIGINT) AS score_p2 FROM t WINDOW w AS (PARTITION BY party_id ORDER BY day)"""

POSITION = """CASE WHEN yes IS NULL OR no IS NULL OR abstain IS NULL THEN coalesce(position, 'unknown') WHEN (yes > 0)::INT + (no > 0)::INT + (abstain > 0)::INT = 0 THEN 'unknown' WHEN (yes > 0)::INT + (no > 0)::INT + (abstain > 0)::INT > 1 THEN 'mixed' WHEN yes > 0 THEN 'yes' WHEN no > 0 THEN 'no' ELSE 'abstain' END"""
COMPARABLE = """comparable AS (SELECT vote_id, v.law_id, vote_date, published_at FROM vote v JOIN law l ON l.law_id = v.law_id LEFT JOIN vote_coverage c ON c.law_id = v.law_id WHERE is_public AND is_final AND whole_law AND checked AND coalesce(c.status, '') NOT IN ('source_error', 'source_changed', 'ambiguous')
  AND l.review <> 'rejected' AND vote_date <= published_at QUALIFY count(*) OVER (PARTITION BY v.law_id) = 1)"""
COMPARED = f"""k AS (SELECT v.vote_id, v.law_id, v.vote_date, i.impact_id, i.criterion_id, c.party_id, i.score, {POSITION} AS position, yes, no, abstain FROM comparable v JOIN impact i ON i.law_id = v.law_id JOIN criterion c ON c.criterion_id = i.criterion_id JOIN program p ON p.program_id = c.program_id AND p.party_id = c.party_id
    JOIN vote_group g ON g.vote_id = v.vote_id AND g.party_id = c.party_id WHERE i.{OK.replace('(review', '(i.review').replace('OR evaluation', 'OR i.evaluation')} AND c.review <> 'rejected' AND p.review <> 'rejected' AND v.vote_date >= p.period_start AND v.published_at >= p.period_start AND v.vote_date >= p.published_at AND v.published_at >= p.published_at
    AND (p.period_end IS NULL OR (v.vote_date < p.period_end AND v.published_at < p.period_end))),
  compared AS (SELECT vote_id, law_id, vote_date, impact_id, criterion_id, party_id, score, position, CASE WHEN position = 'unknown' THEN CASE WHEN yes IS NULL OR no IS NULL OR abstain IS NULL THEN 'unknown' ELSE 'neutral' END WHEN position = 'abstain' THEN 'neutral' WHEN score = 0 THEN 'contextual' WHEN position = 'mixed' THEN 'mixed'
    WHEN (position = 'yes' AND score > 0) OR (position = 'no' AND score < 0) THEN 'consistent' ELSE 'tension' END AS outcome, CASE WHEN score > 0 THEN yes WHEN score < 0 THEN no END AS consistent_ballots, CASE WHEN score > 0 THEN no WHEN score < 0 THEN yes END AS tension_ballots FROM k)"""


def _comparable(spark, sf_dir):
    return V.comparable_votes(*m(spark, sf_dir, "vote", "vote_coverage", "law"))


def _compared(spark, sf_dir):
    return V.comparisons(_comparable(spark, sf_dir), *m(spark, sf_dir, "impact", "criterion", "program", "vote_group"))


def comparable_unique(spark, sf_dir):
    """JOIN-03, FIL-02, DOM-10."""
    return _comparable(spark, sf_dir)


def vote_comparisons(spark, sf_dir):
    """JOIN-02, DOM-01, DOM-02, DOM-03, SNK-08."""
    return _compared(spark, sf_dir)


def comparison_highlights(spark, sf_dir):
    """WIN-05: the ten most telling comparisons; a limit is the feature."""
    return V.highlights(_compared(spark, sf_dir), 10)


def voting_patterns(spark, sf_dir):
    """AGG-10."""
    return V.patterns(model(spark, sf_dir, "party"), _comparable(spark, sf_dir), model(spark, sf_dir, "vote_group"), _compared(spark, sf_dir))


def voting_coverage(spark, sf_dir):
    """AGG-09, DOM-12."""
    laws, votes, coverage = m(spark, sf_dir, "law", "vote", "vote_coverage")
    return V.coverage_counts(laws, votes, coverage, _comparable(spark, sf_dir))


def vote_totals(spark, sf_dir):
    """AGG-03, AGG-12."""
    return V.totals(model(spark, sf_dir, "vote_group"), "vote_id", tasks=_tasks(spark, sf_dir))


def cards_final_else_all(spark, sf_dir):
    """JOIN-17."""
    return V.finals_else_all(model(spark, sf_dir, "vote").select("vote_id", "law_id", "is_final", "stage"))


def law_party_links(spark, sf_dir):
    """JOIN-04: parties that each law has accepted effects for, and their criteria."""
    impacts, criteria = m(spark, sf_dir, "impact", "criterion")
    rows = E.accepted_impacts(impacts).join(criteria.select("criterion_id", "party_id"), "criterion_id")
    return rows.groupBy("law_id", "party_id").agg(F.count_distinct("criterion_id").alias("criteria"), F.array_join(F.transform(F.array_sort(F.collect_set("criterion_id")), lambda x: x.cast("string")), ",").alias("ids"))


def evidence_signature(spark, sf_dir):
    """DOM-16."""
    return E.evidence_signature(*m(spark, sf_dir, "impact", "law"))


def extraction_coverage(spark, sf_dir):
    """JOIN-13, AGG-20: documents of each language that a label audits or a benchmark passage begins."""
    from ..tables import load

    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("leaf_id"), "lang", "n_chars")
    audited = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("leaf_id"))
    return E.extraction_coverage(docs, audited, docs.where("n_chars > 5000"), "lang")


def status_ladder(spark, sf_dir):
    """DOM-14, AGG-16, SNK-12: per law, candidates, completed pairs, links and status."""
    impacts, laws = m(spark, sf_dir, "impact", "law")
    per = impacts.groupBy("law_id").agg(F.count("*").alias("candidates"), F.count_if(F.col("evaluation") != "missing_context").alias("completed"), F.count_if(D.accepted(F.col("review"), F.col("evaluation"))).alias("links"))
    rows = laws.join(per, "law_id", "left").na.fill(0, ["candidates", "completed", "links"])
    status = D.matching_status(F.col("title") != "5-LOW", F.lit(1), F.col("candidates"), F.col("completed"), F.col("links"))
    return rows.select("law_id", "candidates", "completed", "links", status.alias("status"))


def _register_rest():
    from . import registry
    from ..tables import with_model

    def add(f, tables, sql, *parts):
        registry.QUERIES[f.__name__] = f
        head = with_model("", *tables).rstrip() if tables else ""
        registry.SQL[f.__name__] = (head + ", " + ", ".join(parts) + " " + sql) if parts else f"{head} {sql}".strip()

    four = ("impact", "criterion", "program", "law")
    add(law_effects, four, "SELECT * FROM effect", INS, EFFECTS)
    registry.QUERIES["timeline_cumulative"] = timeline_cumulative
    registry.SQL["timeline_cumulative"] = with_model("", *four).rstrip() + ", " + INS + ", " + TIMELINE
    add(timeline_jumps, four, "SELECT party_id, law_id, day, n, row_number() OVER (PARTITION BY party_id ORDER BY n DESC, day, law_id) AS rank FROM (SELECT party_id, law_id, day, count(*) AS n FROM ins GROUP BY ALL) QUALIFY rank <= 3", INS)
    add(first_evidence_exclusive, four, "SELECT party_id, count(*) AS laws, count_if(newly_covered > 0) AS exclusive, count_if(shared > 0) AS sharing, count_if(direction = 'supporting') AS supporting, count_if(direction = 'opposing') AS opposing, count_if(direction = 'mixed') AS mixed FROM effect GROUP BY party_id", INS, EFFECTS)
    votes = ("vote", "vote_coverage", "law")
    add(comparable_unique, votes, "SELECT * FROM comparable", COMPARABLE)
    all_votes = (*votes, "impact", "criterion", "program", "vote_group")
    add(vote_comparisons, all_votes, "SELECT * FROM compared", COMPARABLE, COMPARED)
    add(comparison_highlights, all_votes, "SELECT * FROM (SELECT * FROM compared QUALIFY row_number() OVER (PARTITION BY law_id ORDER BY outcome <> 'tension', vote_date DESC, vote_id, impact_id, party_id) = 1) ORDER BY outcome <> 'tension', vote_date DESC, vote_id, impact_id, party_id LIMIT 10", COMPARABLE, COMPARED)
    sides = ", ".join(f"count_if(side = '{p}') AS position_{p}" for p in V.POSITIONS)
    outs = ", ".join(f"count_if(outcome = '{o}') AS outcome_{o}" for o in V.OUTCOMES)
    names = [f"position_{p}" for p in V.POSITIONS] + [f"outcome_{o}" for o in V.OUTCOMES] + ["compared_laws"]
    add(voting_patterns, (*all_votes, "party"), f"SELECT party_id, {', '.join(f'coalesce({n}, 0) AS {n}' for n in names)} FROM party LEFT JOIN (SELECT party_id, {sides} FROM (SELECT party_id, {POSITION} AS side FROM vote_group WHERE vote_id IN (SELECT vote_id FROM comparable)) GROUP BY 1) USING (party_id) LEFT JOIN (SELECT party_id, {outs}, count(DISTINCT law_id) AS compared_laws FROM compared GROUP BY 1) USING (party_id)", COMPARABLE, COMPARED)
    active = "(SELECT law_id FROM law WHERE review <> 'rejected')"
    add(voting_coverage, votes, f"""SELECT 'laws' AS measure, count(DISTINCT law_id) AS n FROM law WHERE review <> 'rejected' UNION ALL SELECT 'voted', count(DISTINCT law_id) FROM vote WHERE is_public AND law_id IN {active} UNION ALL SELECT 'final', count(DISTINCT law_id) FROM vote WHERE is_public AND is_final AND law_id IN {active}
      UNION ALL SELECT 'compared', count(DISTINCT law_id) FROM comparable UNION ALL SELECT 'failed', count(DISTINCT law_id) FROM vote_coverage WHERE status = 'source_error' AND law_id IN {active} UNION ALL SELECT 'uncovered', count(DISTINCT law_id) FROM law WHERE review <> 'rejected' AND law_id NOT IN (SELECT law_id FROM vote_coverage)""", COMPARABLE)
    add(vote_totals, ("vote_group",), "SELECT *, yes + no + abstain AS cast_votes, yes + no + abstain + absent AS total FROM (SELECT vote_id, " + ", ".join(f"CASE WHEN bool_or(yes IS NULL OR no IS NULL OR abstain IS NULL OR absent IS NULL) THEN NULL ELSE CAST(sum({c}) AS BIGINT) END AS {c}" for c in ("yes", "no", "abstain", "absent")) + " FROM vote_group GROUP BY vote_id)")
    add(cards_final_else_all, ("vote",), "SELECT vote_id, law_id, is_final, stage FROM vote QUALIFY is_final OR NOT bool_or(is_final) OVER (PARTITION BY law_id)")
    add(law_party_links, ("impact", "criterion"), f"SELECT law_id, party_id, count(DISTINCT criterion_id) AS criteria, string_agg(DISTINCT criterion_id::VARCHAR, ',' ORDER BY criterion_id::BIGINT) AS ids FROM impact JOIN (SELECT criterion_id, party_id FROM criterion) USING (criterion_id) WHERE {OK} GROUP BY 1, 2".replace("string_agg(DISTINCT criterion_id::VARCHAR, ',' ORDER BY criterion_id::BIGINT)", "array_to_string(list_sort(list(DISTINCT criterion_id)), ',')"))
    add(evidence_signature, ("impact", "law"), f"SELECT criterion_id, count(*) AS n, sha256(string_agg(concat_ws(':', strftime(published_at, '%Y-%m-%d'), law_id, impact_id, score), '|' ORDER BY published_at, law_id, impact_id, score)) AS signature FROM impact JOIN (SELECT law_id, published_at FROM law) USING (law_id) WHERE {OK} GROUP BY 1")
    add(extraction_coverage, (), "SELECT lang, count(*) AS leaves, count_if(n_chars > 5000 OR doc_id IN (SELECT doc_id FROM labels)) AS processed FROM documents GROUP BY lang")
    add(status_ladder, ("impact", "law"), f"""SELECT law_id, coalesce(c, 0) AS candidates, coalesce(d, 0) AS completed, coalesce(k, 0) AS links, CASE WHEN title = '5-LOW' THEN 'needs_ocr' WHEN coalesce(c, 0) = 0 THEN 'no_candidates' WHEN d < c THEN 'pending' WHEN k > 0 THEN 'proposed' ELSE 'no_supported_links' END AS status
      FROM law LEFT JOIN (SELECT law_id, count(*) AS c, count_if(evaluation <> 'missing_context') AS d, count_if({OK}) AS k FROM impact GROUP BY 1) USING (law_id)""")


_register()
_register_rest()
