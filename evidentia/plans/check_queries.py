"""Constraint checks, transitions and reports, on the evidence model and the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as K
from ..operators import products as P
from ..tables import load, model
from .evidence_queries import OK, _outcomes
from .evidence_queries import OUT as OUTCOME_SQL
from .evidence_queries import TABLES as OUTCOME_TABLES
from .registry import QUERIES, SQL, query


def m(spark, sf_dir, *names):
    return [model(spark, sf_dir, n) for n in names]


@query(f"""SELECT 'score fits status' AS rule, criterion_id::VARCHAR AS entity_id FROM criterion WHERE NOT coalesce(CASE status WHEN 'unassessed' THEN assessed_score IS NULL WHEN 'fulfilled' THEN assessed_score = 2 WHEN 'partial' THEN assessed_score = 1 WHEN 'contradicted' THEN assessed_score < 0 ELSE assessed_score = 0 END, false)
  UNION ALL SELECT DISTINCT 'evidence accepted and own', e.impact_id::VARCHAR FROM evidence e JOIN criterion c ON c.criterion_id = e.criterion_id AND c.method = 'agent' LEFT JOIN (SELECT * FROM impact WHERE {OK}) i ON i.impact_id = e.impact_id WHERE i.criterion_id IS DISTINCT FROM e.criterion_id""", "criterion", "evidence", "impact")
def assessment_checks(spark, sf_dir):
    """VAL-07, VAL-08, DOM-17."""
    return K.assessments(*m(spark, sf_dir, "criterion", "impact", "evidence"))


@query("""SELECT CASE WHEN c.criterion_id IS NULL OR l.law_id IS NULL THEN 'impact dangles' ELSE 'law in window' END AS rule, i.impact_id::VARCHAR AS entity_id FROM impact i LEFT JOIN criterion c ON c.criterion_id = i.criterion_id LEFT JOIN law l ON l.law_id = i.law_id LEFT JOIN program p ON p.program_id = c.program_id
  WHERE c.criterion_id IS NULL OR l.law_id IS NULL OR NOT (l.published_at >= p.period_start AND (p.period_end IS NULL OR l.published_at < p.period_end))""", "impact", "criterion", "law", "program")
def impact_checks(spark, sf_dir):
    """VAL-06, VAL-09, VAL-10."""
    return K.impacts_in_window(*m(spark, sf_dir, "impact", "criterion", "law", "program"))


@query("""SELECT 'vote before publication' AS rule, vote_id::VARCHAR AS entity_id FROM vote JOIN (SELECT law_id, published_at FROM law) USING (law_id) WHERE vote_date > published_at
  UNION ALL SELECT DISTINCT 'group has party', vote_id::VARCHAR FROM vote_group WHERE party_id NOT IN (SELECT party_id FROM party)
  UNION ALL SELECT 'counts all or none', vote_id || ':' || party_id FROM vote_group WHERE (yes IS NULL)::INT + (no IS NULL)::INT + (abstain IS NULL)::INT + (absent IS NULL)::INT BETWEEN 1 AND 3""", "vote", "law", "vote_group", "party")
def vote_checks(spark, sf_dir):
    """VAL-14, VAL-15, VAL-16."""
    return K.votes(*m(spark, sf_dir, "vote", "law", "vote_group", "party"))


@query("""SELECT 'members reconcile' AS rule, vote_id || ':' || party_id AS entity_id FROM (SELECT * FROM vote_group WHERE yes IS NOT NULL) g JOIN (SELECT l_orderkey * 10 + l_linenumber AS vote_id, s_nationkey AS party_id, count_if(l_discount > 0.04) AS a, count_if(l_discount <= 0.02) AS b, count_if(l_discount > 0.02 AND l_discount <= 0.03) AS c, count_if(l_discount > 0.03 AND l_discount <= 0.04) AS d
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) m USING (vote_id, party_id) WHERE yes <> a OR no <> b OR abstain <> c OR absent <> d""", "vote_group")
def member_checks(spark, sf_dir):
    """AGG-22, VAL-16: each line as one member's ballot against the stated counts."""
    li, s = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "supplier")
    choice = F.when(F.col("l_discount") > 0.04, "yes").when(F.col("l_discount") <= 0.02, "no").when(F.col("l_discount") <= 0.03, "abstain").otherwise("absent")
    members = li.join(s.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("party_id")), "l_suppkey").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("vote_id"), "party_id", choice.alias("choice"))
    return K.members_reconcile(members, model(spark, sf_dir, "vote_group"))


LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"
PAGED = f"p AS (SELECT *, last_value(CASE WHEN length(text) < 12 THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS page FROM {LINES})"


def _paged(spark, sf_dir):
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text")).withColumn("line_no", (F.col("line_no") + 1).cast("long"))
    return K.page_of_line(lines, F.when(F.length("text") < 12, F.col("line_no")))


@query(f"WITH {PAGED} SELECT doc_id, line_no, page FROM p")
def page_of_line(spark, sf_dir):
    """WIN-08: each line's page, a short line being a marker."""
    return _paged(spark, sf_dir).select("doc_id", "line_no", "page")


@query(f"""WITH {PAGED}, l AS (SELECT doc_id, doc_id || ':' || line_no AS leaf_id, CASE WHEN line_no > 5 THEN page + 1 ELSE page END AS page, line_no AS line_start, line_no AS line_end, CASE WHEN line_no = 3 THEN upper(text) ELSE text END AS quote FROM p WHERE page IS NOT NULL)
  SELECT 'quote in lines' AS rule, leaf_id AS entity_id FROM l JOIN p ON p.doc_id = l.doc_id AND line_no = line_start WHERE NOT contains(text, quote) UNION ALL SELECT 'page of lines', leaf_id FROM l JOIN p ON p.doc_id = l.doc_id AND line_no = line_start WHERE p.page <> l.page""")
def span_checks(spark, sf_dir):
    """VAL-03: quotations against the lines and pages that they cite."""
    lines = _paged(spark, sf_dir)
    n = F.col("line_no")
    leaves = lines.where("page is not null").select("doc_id", F.concat_ws(":", "doc_id", "line_no").alias("leaf_id"), F.when(n > 5, F.col("page") + 1).otherwise(F.col("page")).alias("page"), n.alias("line_start"), n.alias("line_end"), F.when(n == 3, F.upper("text")).otherwise(F.col("text")).alias("quote"))
    return K.spans(lines, leaves)


@query(f"""WITH {PAGED}, s AS (SELECT doc_id, line_no AS pos, page, regexp_extract(text, '^[\\p{{L}}]+') AS section FROM p WHERE regexp_extract(text, '^[\\p{{L}}]+') <> ''), e AS (SELECT *, lag(section) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM s),
  n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY pos) AS nth FROM e WHERE section IS DISTINCT FROM before) SELECT doc_id, pos, page, CASE WHEN nth = 1 THEN section ELSE section || '-continuation-' || nth END AS anchor FROM n""")
def section_anchors(spark, sf_dir):
    """TXT-18: where sections begin and go on."""
    section = F.nullif(F.regexp_extract("text", r"^[\p{L}]+", 0), F.lit(""))
    return P.section_anchors(_paged(spark, sf_dir).select("doc_id", F.col("line_no").alias("pos"), "page", section.alias("section")))


@query(f"""WITH {PAGED}, b AS (SELECT doc_id, line_no AS pos, coalesce(page, 0) AS page, line_no AS line_start, line_no + (length(text) > 300)::INT AS line_end FROM p), c AS (SELECT *, coalesce((page <> lag(page) OVER w OR line_start <= lag(line_end) OVER w)::INT, 0) AS new FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
  SELECT doc_id, pos, page, CAST(sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS grp FROM c""")
def cited_groups(spark, sf_dir):
    """TXT-28: blocks in groups that end at page changes and overlaps."""
    b = _paged(spark, sf_dir).select("doc_id", F.col("line_no").alias("pos"), F.coalesce("page", F.lit(0)).alias("page"), F.col("line_no").alias("line_start"), (F.col("line_no") + (F.length("text") > 300).cast("int")).alias("line_end"))
    return P.cited_groups(b).select("doc_id", "pos", "page", F.col("group").cast("long").alias("grp"))


@query("""WITH r AS (SELECT conv_id AS doc_id, turn AS start, CASE WHEN length(text) > 900 THEN turn + 1 ELSE turn END AS stop FROM conversations), s AS (SELECT *, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start, stop), -1) + 1 AS due FROM r), n AS (SELECT conv_id AS doc_id, count(*) AS size FROM conversations GROUP BY 1)
  SELECT 'ranges tile the document' AS rule, doc_id::VARCHAR AS entity_id FROM n LEFT JOIN (SELECT doc_id, bool_and(start = due AND stop >= start) AS even, max(stop) AS last FROM s GROUP BY 1) USING (doc_id) WHERE NOT coalesce(even AND last = size - 1, false)""")
def tiling_checks(spark, sf_dir):
    """TXT-29, VAL-11: turns that don't tile their conversation."""
    c = load(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "doc_id")
    ranges = c.select("doc_id", F.col("turn").alias("start"), F.when(F.length("text") > 900, F.col("turn") + 1).otherwise(F.col("turn")).alias("end"))
    return K.tiles(ranges, c.groupBy("doc_id").agg(F.count("*").alias("size")))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents), h AS (SELECT doc_id, pos, term FROM l, (VALUES ('the'), ('que'), ('und')) v(term) WHERE length(t) >= 80 AND contains(lower(t), term))
  SELECT DISTINCT doc_id, pos FROM (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY doc_id, term ORDER BY pos) <= 2)""")
def pilot_leaves(spark, sf_dir):
    """TXT-23: the first two longer lines of each document for each term; two is the feature."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")).withColumn("pos", (F.col("pos") + 1).cast("long"))
    return P.pilot_leaves(lines, ["the", "que", "und"])


@query("""WITH d AS (SELECT doc_id AS key, CASE WHEN quality = 1 AND toxic = 0 THEN 'accepted' WHEN quality = 1 THEN 'missing_context' ELSE 'rejected' END AS outcome FROM labels), p AS (SELECT doc_id AS key, CASE WHEN lang = 'de' THEN 'reviewed' ELSE 'proposed' END AS review FROM documents WHERE lang <> 'en'),
  b AS (SELECT key, outcome, review, review IS NOT NULL AND review <> 'proposed' AS kept FROM d LEFT JOIN p USING (key))
  SELECT key, CASE WHEN kept THEN 'preserved_link' WHEN outcome = 'accepted' THEN 'proposed_link' WHEN outcome = 'missing_context' THEN 'missing_context' ELSE 'no_supported_link' END AS disposition,
    CASE WHEN kept THEN 'unchanged' WHEN outcome = 'accepted' THEN CASE WHEN review IS NULL THEN 'created' ELSE 'renewed' END WHEN review IS NOT NULL THEN 'superseded' END AS impact, NOT kept AS invalidates FROM b""")
def decision_transitions(spark, sf_dir):
    """DOM-15: what decisions do to existing links."""
    outcome = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "accepted").when(F.col("quality") == 1, "missing_context").otherwise("rejected")
    drafts = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), outcome.alias("outcome"))
    prior = load(spark, sf_dir, "documents").where("lang <> 'en'").select(F.col("doc_id").alias("key"), F.when(F.col("lang") == "de", "reviewed").otherwise("proposed").alias("review"))
    return P.decisions(prior, drafts)


@query("""WITH o AS (SELECT law_id, published_at FROM law), i AS (SELECT DISTINCT law_id FROM impact WHERE review <> 'rejected'), a AS (SELECT o.*, i.law_id IS NOT NULL AS got, least(DATE '2000-12-31', DATE '2001-06-30') AS as_of FROM o LEFT JOIN i USING (law_id))
  SELECT max(as_of) AS as_of, count_if(published_at <= as_of) AS official, count_if(published_at <= as_of AND got) AS imported, count_if(published_at <= as_of AND NOT got) AS pending, count_if(published_at > as_of) AS beyond, count_if(published_at <= as_of AND NOT got) = 0 AS complete FROM a""", "law", "impact")
def law_coverage(spark, sf_dir):
    """AGG-19, INC-12: coverage up to the verified day, with later entries apart."""
    laws, impacts = m(spark, sf_dir, "law", "impact")
    return P.law_coverage(laws.select("law_id", "published_at"), impacts.where("review <> 'rejected'"), F.lit("2000-12-31").cast("date"), F.lit("2001-06-30").cast("date"))


def last_assessed(spark, sf_dir):
    """AGG-25."""
    criteria, evidence, impacts = m(spark, sf_dir, "criterion", "evidence", "impact")
    dated = criteria.withColumn("assessed_at", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("criterion_id") % 300).cast("int")))
    return P.last_assessed(dated, evidence, impacts, "program_id")


def overview_totals(spark, sf_dir):
    """AGG-21, FIL-09, SNK-15."""
    parties, programs, laws = m(spark, sf_dir, "party", "program", "law")
    return P.overview(parties, programs, _outcomes(spark, sf_dir), laws)


def comparable_rule(spark, sf_dir):
    """DOM-10, WIN-15: each law's last final passage by the rule."""
    votes = model(spark, sf_dir, "vote")
    p = votes.select("law_id", "vote_id", F.col("vote_date").alias("day"), F.when(F.col("checked"), "official_reference").otherwise("title").alias("match"), "stage", F.when(F.col("whole_law"), "whole_law").otherwise("partial_law").alias("scope"), (~F.col("is_public")).alias("mediation"), F.lit("Annahme").alias("tenor"))
    return P.comparable_rule(p).select("law_id", "vote_id", "comparable")


def vote_ladder(spark, sf_dir):
    """DOM-11, DOM-12: type and status of each vote by its best evidence."""
    votes, groups = m(spark, sf_dir, "vote", "vote_group")
    g = groups.groupBy("vote_id").agg(F.count("yes").alias("ballots"), F.count("position").alias("announced"))
    rows = votes.join(g, "vote_id", "left").na.fill(0, ["ballots", "announced"]).select("vote_id", "ballots", "announced", F.col("is_final").alias("named_vote"), "whole_law", F.col("checked").alias("has_transcript"))
    return P.vote_ladder(rows)


def page_criteria(spark, sf_dir):
    """JOIN-14, FIL-06: criteria by the page that they cite."""
    criteria = model(spark, sf_dir, "criterion").select("criterion_id", F.col("program_id").alias("doc_id"), (F.col("criterion_id") % 7).alias("page"))
    by_page, _ = P.page_annotations(criteria, criteria)
    return by_page


def _register():
    from ..tables import with_model

    head = lambda *t: with_model("", *t).rstrip()
    for f in (last_assessed, overview_totals, comparable_rule, vote_ladder, page_criteria):
        QUERIES[f.__name__] = f
    SQL["last_assessed"] = head("criterion", "evidence", "impact") + f""", g AS (SELECT impact_id FROM impact WHERE {OK}), proven AS (SELECT criterion_id FROM evidence GROUP BY criterion_id HAVING bool_and(impact_id IN (SELECT impact_id FROM g)))
      SELECT program_id, max(DATE '2024-01-01' + CAST(criterion_id % 300 AS INT)) AS last_assessed_at FROM criterion WHERE status <> 'unassessed' AND criterion_id IN (SELECT criterion_id FROM proven) GROUP BY program_id"""
    SQL["overview_totals"] = head(*OUTCOME_TABLES, "party", "law") + ", " + OUTCOME_SQL + " SELECT 'parties' AS measure, count(DISTINCT party_id) AS n FROM program WHERE review <> 'rejected' UNION ALL SELECT 'criteria', count(*) FROM o UNION ALL SELECT 'covered', count_if(covered) FROM o UNION ALL SELECT 'laws', count(*) FROM law"
    SQL["comparable_rule"] = head("vote") + " SELECT law_id, vote_id, coalesce(checked AND stage = 'final_passage' AND whole_law AND is_public AND vote_date = max(CASE WHEN stage = 'final_passage' THEN vote_date END) OVER (PARTITION BY law_id), false) AS comparable FROM vote"
    SQL["vote_ladder"] = head("vote", "vote_group") + """, g AS (SELECT vote_id, count(yes) AS b, count(position) AS a FROM vote_group GROUP BY 1) SELECT vote_id, CASE WHEN b > 0 THEN 'roll_call' WHEN a > 0 THEN 'group_record' ELSE 'plenary_record' END AS type,
      CASE WHEN b > 0 THEN 'roll_call_found' WHEN is_final THEN 'roll_call_unmatched' WHEN NOT whole_law THEN 'partial_law' WHEN NOT checked THEN 'no_structured_transcript' WHEN a > 0 THEN 'groups_found' ELSE 'no_explicit_groups' END AS status FROM vote LEFT JOIN g USING (vote_id)"""
    SQL["page_criteria"] = head("criterion") + " SELECT program_id AS doc_id, criterion_id % 7 AS page, count(*) AS n, array_to_string(list_sort(list(criterion_id)), ',') AS ids FROM criterion GROUP BY 1, 2"


_register()
