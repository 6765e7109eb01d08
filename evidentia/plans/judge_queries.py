"""Judges in batches and cascades, strict groups, and chained revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cascade as C
from ..operators import cliques as G
from ..operators import revisions as V
from ..operators.retrieval import telling_terms
from ..session import small_or_shuffled, stored
from ..streaming import bisect as B
from ..tables import load
from .registry import query
from .text_queries import ITEM_TERMS, Q_TERMS, SQL_PAIRS, jaccard_pairs


def batches_sql(tasks: str, size: int, by: str) -> str:
    """CTE batch_ (the columns of tasks, section, batch, nth) for tasks (key, by)."""
    return f"""sized AS (SELECT *, ceil(count(*) OVER (PARTITION BY {by}) / {64 * size})::BIGINT AS sections FROM ({tasks})), cut AS (SELECT *, ('0x' || left(md5(key::VARCHAR), 8))::BIGINT % sections AS section FROM sized),
  batch_ AS (SELECT *, n // {size} AS batch, n % {size} AS nth FROM (SELECT *, row_number() OVER (PARTITION BY {by}, section ORDER BY key) - 1 AS n FROM cut))"""


BAD = "doc_id % 97 = 13 OR text IS NULL"


@query(f"""WITH RECURSIVE {batches_sql(f"SELECT doc_id AS key, lang, {BAD} AS bad FROM documents", 32, 'lang')},
  b AS (SELECT lang, section, batch, nth::BIGINT AS nth, bad, ''::VARCHAR AS part, count(*) OVER w AS size, count_if(bad) OVER w AS bads, 0 AS round FROM batch_ WINDOW w AS (PARTITION BY lang, section, batch)
    UNION ALL SELECT lang, section, batch, n, bad, p, count(*) OVER w, count_if(bad) OVER w, round + 1
      FROM (SELECT lang, section, batch, round, bad, part || CASE WHEN nth >= size // 2 THEN 'b' ELSE 'a' END AS p, CASE WHEN nth >= size // 2 THEN nth - size // 2 ELSE nth END AS n FROM b WHERE bads > 0 AND size > 1) WINDOW w AS (PARTITION BY lang, section, batch, p))
  SELECT round, count(DISTINCT (lang, section, batch, part)) AS calls, count(DISTINCT (lang, section, batch, part)) FILTER (bads > 0) AS failed FROM b GROUP BY round""")
def bisected_calls(spark, sf_dir):
    """INC-06: calls of each round when batches of 32 documents fail for single ones and are halved."""
    return _bisected(spark, sf_dir).calls


@query(f"SELECT doc_id AS key, NOT ({BAD}) AS answered, CASE WHEN NOT ({BAD}) THEN length(text) END AS chars FROM documents")
def bisected_answers(spark, sf_dir):
    """INC-06: every document is answered but those that fail alone."""
    asked = _bisected(spark, sf_dir)
    missing = asked.unanswered.select("key", F.lit(False).alias("answered"), F.lit(None).cast("long").alias("chars"))
    return asked.answers.select("key", F.lit(True).alias("answered"), "chars").unionByName(missing)


def _bisected(spark, sf_dir) -> B.Asked:
    def lengths(frame):
        if ((frame["key"] % 97 == 13) | frame["chars"].isna()).any():
            raise ValueError("a document that the judge can't read")
        return frame[["key", "chars"]].astype({"chars": "int64"})

    tasks = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "lang", F.length("text").alias("chars"))
    return B.bisected(tasks, lengths, "key long, chars long", size=32, by=("lang",))


PAIRS = f"""t AS (SELECT item_id, unnest(list_distinct({ITEM_TERMS})) AS term FROM benchmark), telling AS (SELECT * FROM t WHERE term IN (SELECT term FROM t GROUP BY term HAVING count(*) <= 3)),
  line AS (SELECT doc_id, line_no, list_distinct({Q_TERMS.format(c='text')}) AS terms FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)),
  met AS (SELECT doc_id, line_no, item_id FROM (SELECT doc_id, line_no, unnest(terms) AS term FROM line) JOIN telling USING (term) GROUP BY ALL HAVING count(*) >= 2),
  pair AS (SELECT doc_id || ':' || line_no || ':' || item_id AS key, doc_id AS law_id, terms AS law_terms, item_terms FROM met JOIN line USING (doc_id, line_no) JOIN (SELECT item_id, list_distinct({ITEM_TERMS}) AS item_terms FROM benchmark) USING (item_id)),
  shared AS (SELECT key, law_id, len(list_intersect(law_terms, item_terms)) AS k, len(item_terms) AS n, len(list_filter(list_intersect(law_terms, item_terms), lambda x: length(x) >= 5)) AS k5, len(list_filter(item_terms, lambda x: length(x) >= 5)) AS n5 FROM pair),
  said AS (SELECT *, k > 0 AND 10 * k >= 2 * n AS screened, k > 0 AND 10 * k >= 3 * n AS linked, k5 > 0 AND 10 * k5 >= 4 * n5 AS challenged, k > 0 AND 10 * k >= 6 * n AS strict FROM shared),
  ruled AS (SELECT key, law_id, CASE WHEN NOT screened THEN 'screened_out' WHEN NOT linked THEN 'not_linked' WHEN challenged OR strict THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN screened AND linked THEN NOT challenged END AS disputed, CASE WHEN screened AND linked AND (challenged OR strict) THEN CASE WHEN k >= 8 THEN 2 ELSE 1 END END AS score FROM said)"""


def _distinct_terms(text: str) -> Column:
    return F.array_distinct(T.terms(F.col(text)))


def _ruled(spark, sf_dir) -> DataFrame:
    items = stored(load(spark, sf_dir, "benchmark").select("item_id", _distinct_terms("text").alias("criterion_terms"), F.col("text").alias("criterion_text")), "items")
    lines = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("law_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "law_text"))
    telling = telling_terms(items.select("item_id", F.explode("criterion_terms").alias("term")), 3)
    met = lines.select("law_id", "line_no", F.explode(_distinct_terms("law_text")).alias("term")).join(telling, "term").groupBy("law_id", "line_no", "item_id").agg(F.count("*").alias("n")).where("n >= 2")
    # Texts meet lines that have a pair only. A pair has its line's text; terms, and passages if they are few, are added to the judges' batches.
    of_line = met.groupBy("law_id", "line_no").agg(F.collect_list("item_id").alias("items"))
    pairs = of_line.join(lines, ["law_id", "line_no"]).select("law_id", "line_no", "law_text", F.explode("items").alias("item_id"))
    pairs = pairs.select(F.concat_ws(":", "law_id", "line_no", "item_id").alias("key"), "law_id", "law_text", "item_id")
    given = small_or_shuffled(items, 20_000)
    few = given is not items
    pairs = pairs if few else pairs.join(items.drop("criterion_terms"), "item_id")

    def seen(batches):
        both = batches.join(given, "item_id") if few else batches.withColumn("criterion_terms", _distinct_terms("criterion_text"))
        return both.withColumn("law_terms", _distinct_terms("law_text"))

    judge = C.term_judge(links=3, of=10, weak=8)
    return C.cascade(
        pairs, screen=C.screening(C.term_judge(links=2, of=10)), judge=judge, challenger=C.term_judge(links=4, of=10, least_length=5), final=C.settling(judge, C.term_judge(links=6, of=10, weak=8)), seen=seen
    )


@query(f"WITH {PAIRS} SELECT * FROM ruled")
def judgment_cascade(spark, sf_dir):
    """LLM-05, LLM-06, LLM-07: lines of documents and benchmark passages with two telling terms in common, through all judges."""
    return _ruled(spark, sf_dir).select("key", "law_id", "status", "disputed", "score")


def _calls(stage: str, where: str, size: int) -> str:
    return f"SELECT '{stage}' AS stage, count(*) AS tasks, count(DISTINCT (law_id, section, n // {size})) AS calls FROM (SELECT *, row_number() OVER (PARTITION BY law_id, section ORDER BY key) - 1 AS n FROM (SELECT *, ('0x' || left(md5(key), 8))::BIGINT % sections AS section FROM (SELECT *, ceil(count(*) OVER (PARTITION BY law_id) / {64 * size})::BIGINT AS sections FROM ruled WHERE {where}))) HAVING count(*) > 0"


@query(f"WITH {PAIRS} " + " UNION ALL ".join(_calls(*x) for x in (("screening", "true", 16), ("judgment", "status <> 'screened_out'", 6), ("challenge", "disputed IS NOT NULL", 6), ("final", "disputed IS NOT NULL", 12))))
def cascade_counts(spark, sf_dir):
    """LLM-05, LLM-06, LLM-07, TXT-25: pairs that each stage saw, and in how many calls of one document."""
    return C.stage_counts(_ruled(spark, sf_dir))


@query(SQL_PAIRS.replace("WITH ", "WITH RECURSIVE ", 1).replace("  SELECT * FROM j WHERE jaccard >= 0.02", "") + """, pair AS (SELECT left_id, right_id FROM j WHERE jaccard >= 0.02), both_ AS (SELECT left_id AS id, right_id AS other FROM pair UNION SELECT right_id, left_id FROM pair),
  reach AS (SELECT item_id AS id, item_id AS other FROM benchmark UNION SELECT reach.id, both_.other FROM reach JOIN both_ ON both_.id = reach.other), component AS (SELECT id, count(*) AS component_size FROM reach GROUP BY id),
  ids AS MATERIALIZED (SELECT item_id AS id, row_number() OVER (ORDER BY item_id) AS n, coalesce((SELECT list(other) FROM both_ WHERE both_.id = item_id), []) AS partners FROM benchmark),
  g AS (SELECT 0::BIGINT AS n, []::BIGINT[][] AS groups UNION ALL SELECT n, CASE WHEN at_ IS NULL THEN list_append(groups, [id]) ELSE list_concat(list_append(groups[:at_ - 1], list_append(groups[at_], id)), groups[at_ + 1:]) END
    FROM (SELECT ids.n, groups, id, list_position(list_transform(groups, lambda x: len(list_filter(x, lambda y: NOT list_contains(partners, y))) = 0), true) AS at_ FROM g JOIN ids ON ids.n = g.n + 1)),
  members AS (SELECT unnest(groups) AS members FROM g WHERE n = (SELECT count(*) FROM benchmark))
  SELECT 0 AS program_id, id, group_id, component_size FROM (SELECT unnest(members) AS id, members[1] AS group_id FROM members) JOIN component USING (id)""")
def complete_link_groups(spark, sf_dir):
    """WIN-12: passages in groups all of whose members pair with each other, and the size of the component that held them."""
    items = load(spark, sf_dir, "benchmark").withColumn("program_id", F.lit(0))
    return G.complete_link_groups(items, jaccard_pairs(spark, sf_dir), "item_id", "program_id")


EDITIONS = "p AS (SELECT doc_id, line_no // 8 AS number, string_agg(text, chr(10) ORDER BY line_no) AS md FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents) GROUP BY ALL)"
REPAIRS = f"""{EDITIONS}, r1 AS (SELECT *, CASE WHEN length(md) < 400 AND number % 2 = 0 THEN '[' || md || ']' ELSE md END AS md1, length(md) < 400 AND number % 2 = 0 AS c1 FROM p), r2 AS (SELECT *, CASE WHEN number = 0 AND doc_id % 3 = 0 THEN md1 || '.' ELSE md1 END AS md2, number = 0 AND doc_id % 3 = 0 AS c2 FROM r1),
  d AS (SELECT doc_id AS document_id, sha256(string_agg(md, chr(10) || chr(10) ORDER BY number)) AS d0, sha256(string_agg(md1, chr(10) || chr(10) ORDER BY number)) AS d1, sha256(string_agg(md2, chr(10) || chr(10) ORDER BY number)) AS d2, list(number ORDER BY number) FILTER (c1) AS p1, list(number ORDER BY number) FILTER (c2) AS p2 FROM r2 GROUP BY 1),
  log AS (SELECT document_id, 1 AS revision, d0 AS previous_sha256, d1 AS sha256, p1 AS pages FROM d WHERE p1 IS NOT NULL UNION ALL SELECT document_id, 1 + (p1 IS NOT NULL)::INT, d1, d2, p2 FROM d WHERE p2 IS NOT NULL)"""


def _revised(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The log of two repairs of documents in pages of eight lines, and the digests of the editions that they led to."""
    lines = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    pages = lines.groupBy("document_id", F.floor(F.col("line_no") / 8).alias("number")).agg(text.alias("markdown"))
    short, cover = (F.length("markdown") < 400) & (F.col("number") % 2 == 0), (F.col("number") == 0) & (F.col("document_id") % 3 == 0)
    log = spark.createDataFrame([], "document_id long, revision int, previous_sha256 string, sha256 string, pages array<long>, reason string")
    for flagged, redone, reason in ((short, F.concat(F.lit("["), "markdown", F.lit("]")), "short pages"), (cover, F.concat("markdown", F.lit(".")), "covers")):
        before = pages.select("document_id", "number", "markdown", flagged.alias("flagged"))
        after = V.repaired(before, before.select("document_id", "number", redone.alias("markdown")))
        log = log.unionByName(V.next_revisions(log, before, after, reason))
        pages = after.select("document_id", "number", "markdown")
    return log, V.digests(pages)


@query(f"WITH {REPAIRS} SELECT document_id, revision, previous_sha256, sha256, array_to_string(pages, ',') AS pages FROM log")
def revision_log(spark, sf_dir):
    """INC-13: the log of two repairs of each document's flagged pages, chained by digests."""
    return _revised(spark, sf_dir)[0].select("document_id", "revision", "previous_sha256", "sha256", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"))


TAMPERED = "SELECT document_id, CASE WHEN document_id % 9 = 6 AND revision = 2 THEN 3 ELSE revision END AS revision, CASE WHEN document_id % 10 = 3 AND revision = 2 THEN sha256(previous_sha256) ELSE previous_sha256 END AS previous_sha256, CASE WHEN document_id % 7 = 1 THEN previous_sha256 ELSE sha256 END AS sha256, CASE WHEN document_id % 13 = 5 THEN [] ELSE pages END AS pages FROM log WHERE NOT (document_id % 8 = 0 AND revision = 1)"


@query(f"""WITH {REPAIRS}, t AS ({TAMPERED}), e AS (SELECT t.*, d.d2 AS present, row_number() OVER w AS due, lag(sha256) OVER w AS before, lead(sha256) OVER w AS following FROM t JOIN d USING (document_id) WINDOW w AS (PARTITION BY document_id ORDER BY revision, sha256))
  SELECT 'revisions count up' AS rule, document_id || ':' || revision AS entity_id FROM e WHERE revision <> due UNION ALL SELECT 'names the one before', document_id || ':' || revision FROM e WHERE due > 1 AND previous_sha256 IS DISTINCT FROM before
  UNION ALL SELECT 'changes something', document_id || ':' || revision FROM e WHERE previous_sha256 = sha256 OR len(pages) = 0 UNION ALL SELECT 'leads to the edition', document_id || ':' || revision FROM e WHERE following IS NULL AND sha256 IS DISTINCT FROM present""")
def revision_faults(spark, sf_dir):
    """INC-13, VAL-12: links of the log that are broken, after entries were renumbered, emptied, removed or forged."""
    log, editions = _revised(spark, sf_dir)
    d, last = F.col("document_id"), F.col("revision") == 2
    forged = log.where(~((d % 8 == 0) & (F.col("revision") == 1))).select(
        "document_id", F.when((d % 9 == 6) & last, 3).otherwise(F.col("revision")).alias("revision"), F.when((d % 10 == 3) & last, F.sha2("previous_sha256", 256)).otherwise(F.col("previous_sha256")).alias("previous_sha256"),
        F.when(d % 7 == 1, F.col("previous_sha256")).otherwise(F.col("sha256")).alias("sha256"), F.when(d % 13 == 5, F.array().cast("array<long>")).otherwise(F.col("pages")).alias("pages"), "reason",
    )
    return V.chain_faults(forged, editions)
