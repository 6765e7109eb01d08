"""Labels, links, filters and checks over the input tables: smaller rows of the inventory, each against its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions import text as T
from ..operators import checks as K
from ..operators import ledger as L
from ..streaming import state as S
from ..tables import load, model
from .registry import query

HOSTS = ["www.official.example", "gazette.example"]
URL = """CASE page_id % 8 WHEN 0 THEN 'https://www.official.example/a/' || page_id WHEN 1 THEN 'http://www.official.example/a' WHEN 2 THEN 'https://user@gazette.example/x' WHEN 3 THEN 'https://GAZETTE.example:443/x?page=2'
    WHEN 4 THEN 'https://gazette.example:8443/x' WHEN 5 THEN 'https://gazette.example/x?apiKey=1' WHEN 6 THEN url ELSE 'https://gazette.example.evil/x' END"""
PATH = "CASE page_id % 5 WHEN 0 THEN 'live/laws/' || page_id || '.md' WHEN 1 THEN 'live/laws/../x.md' WHEN 2 THEN 'live/lawsuits/a.md' WHEN 3 THEN 'live/laws/a.txt' ELSE 'live/laws/a..b.md' END"
REFERENCE = "CASE page_id % 3 WHEN 0 THEN 'eli/bgbl-1-2024-' || page_id || 'a' WHEN 1 THEN 'BGBl. I ' || page_id ELSE 'bgbl-2-19-7' END"


@query("""SELECT page_id, page_id % 8 IN (0, 3) AS official, page_id % 5 IN (0, 4) AS safe, CASE WHEN page_id % 3 = 0 THEN '1/2024/' || page_id || 'a' END AS cited, '/laws/' || page_id || '/text/#page-' || (page_id % 7) AS href FROM pages""")
def links_of_pages(spark, sf_dir):
    """TXT-21, TXT-30, TXT-33, TXT-34: which URLs and paths may be followed, gazette references, and links to pages."""
    p = load(spark, sf_dir, "pages").select("page_id", F.expr(URL).alias("u"), F.expr(PATH).alias("path"), F.expr(REFERENCE).alias("reference"))
    c = T.citation(F.col("reference"))
    cited = F.when(c.isNotNull(), F.concat_ws("/", c["part"], c["year"], c["number"]))
    return p.select("page_id", T.is_official_url(F.col("u"), HOSTS).alias("official"), T.is_safe_path(F.col("path"), "live/laws").alias("safe"), cited.alias("cited"), T.page_href(F.lit("laws"), F.col("page_id"), F.col("page_id") % 7).alias("href"))


@query("""WITH t AS (SELECT doc_id, text, '##### no heading' || chr(10) || left(text, 40) || chr(10) || '### ' || lang || ' ' || source || chr(10) || '# later' AS page FROM documents WHERE length(text) >= 30)
  SELECT doc_id, regexp_extract(page, '(?m)^#{1,4}\\s+(.+)$', 1) AS heading, left(text, 4) || repeat(' ', 9) || substr(text, 14, 7) || repeat(' ', 5) || substr(text, 26) AS blanked FROM t""")
def headings_and_comments(spark, sf_dir):
    """TXT-16, TXT-19: each document's first heading, and its text with two spans blanked out in place."""
    d = load(spark, sf_dir, "documents").where(F.length("text") >= 30)
    page = F.concat(F.lit("##### no heading\n"), F.substring("text", 1, 40), F.lit("\n### "), "lang", F.lit(" "), "source", F.lit("\n# later"))
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((4, 13), (20, 25))])
    return d.select("doc_id", T.first_heading(page).alias("heading"), T.without_comments(F.col("text"), spans).alias("blanked"))


@query("""SELECT vote_id, party_id, CASE WHEN yes IS NOT NULL AND no IS NOT NULL AND abstain IS NOT NULL THEN 'P' || party_id || ': ' || yes || '/' || no || '/' || abstain ELSE 'P' || party_id || ': ' || coalesce(position, 'unknown') END AS preview FROM vote_group""", "vote_group")
def group_previews(spark, sf_dir):
    """DOM-05: each group's votes, or else its position, in a line."""
    g = model(spark, sf_dir, "vote_group")
    label = F.concat(F.lit("P"), F.col("party_id").cast("string"))
    return g.select("vote_id", "party_id", D.group_preview(label, F.col("yes"), F.col("no"), F.col("abstain"), F.col("position")).alias("preview"))


@query("""SELECT event_id, code, code IN (408, 409, 425, 429) OR code >= 500 AS retryable FROM (SELECT event_id, 400 + (event_id % 130) AS code FROM events)""")
def retryable_codes(spark, sf_dir):
    """DOM-18: which of a provider's answers are worth another attempt."""
    e = load(spark, sf_dir, "events").select("event_id", (400 + F.col("event_id") % 130).alias("code"))
    return e.select("event_id", "code", D.retryable(F.col("code")).alias("retryable"))


JUDGED = """SELECT doc_id AS key, doc_id % 3 <> 0 AS supported, CASE WHEN doc_id % 3 = 1 OR doc_id % 11 = 5 THEN 'proposed_link' WHEN doc_id % 3 = 2 THEN 'preserved_link' ELSE 'no_supported_link' END AS disposition,
    CASE WHEN doc_id % 3 <> 0 OR doc_id % 13 = 6 THEN 1 END AS score, CASE WHEN doc_id % 7 = 2 THEN left(text, 9) ELSE left(text, 40) END AS law_quote, CASE WHEN doc_id % 17 <> 3 THEN 'a quotation of a criterion' END AS criterion_quote FROM documents"""


@query(f"""WITH j AS ({JUDGED}), l AS (SELECT *, disposition <> 'no_supported_link' AS linked FROM j)
  SELECT 'supported means linked' AS rule, key::VARCHAR AS entity_id FROM l WHERE supported <> linked UNION ALL SELECT 'no score without link', key::VARCHAR FROM l WHERE NOT linked AND score IS NOT NULL
  UNION ALL SELECT 'a link has score and quotes', key::VARCHAR FROM l WHERE linked AND NOT (score IS NOT NULL AND length(coalesce(law_quote, '')) >= 10 AND length(coalesce(criterion_quote, '')) >= 10)""")
def judgment_faults(spark, sf_dir):
    """VAL-18, VAL-22: judgments whose fields don't go together, of which some are planted."""
    return K.judgments(spark.sql(JUDGED.replace("FROM documents", "FROM {documents}"), documents=load(spark, sf_dir, "documents")))


TREE = "SELECT c_nationkey AS program_id, 'n' || (c_custkey % 50) AS node_id, c_custkey + CASE WHEN c_custkey % 41 = 3 THEN 1 ELSE 0 END AS leaf_id FROM customer WHERE c_custkey % 37 <> 5"


@query(f"""WITH t AS ({TREE}), n AS (SELECT program_id, leaf_id, count(*) AS n FROM t GROUP BY ALL), l AS (SELECT c_nationkey AS program_id, c_custkey AS leaf_id FROM customer)
  SELECT 'leaf not in tree' AS rule, leaf_id::VARCHAR AS entity_id FROM l ANTI JOIN n USING (program_id, leaf_id) UNION ALL SELECT 'no such leaf', leaf_id::VARCHAR FROM n ANTI JOIN l USING (program_id, leaf_id)
  UNION ALL SELECT 'leaf twice in tree', leaf_id::VARCHAR FROM n JOIN l USING (program_id, leaf_id) WHERE n > 1""")
def tree_faults(spark, sf_dir):
    """VAL-04: leaves that a programme's tree lacks, names twice, or names in vain, of which some are planted."""
    c = load(spark, sf_dir, "customer")
    tree = spark.sql(TREE.replace("FROM customer", "FROM {customer}").replace("'n' || (c_custkey % 50)", "concat('n', c_custkey % 50)"), customer=c)
    return K.tree_covers(tree, c.select(F.col("c_nationkey").alias("program_id"), F.col("c_custkey").alias("leaf_id")))


@query("""WITH g AS (SELECT event_id // 3 AS grant_id, user_id AS task, 1 + event_id % 3 AS attempts FROM events), f AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY grant_id ORDER BY task, attempts) = 1) SELECT task, (sum(attempts) + 3)::BIGINT AS "limit" FROM f GROUP BY task""")
def granted_limits(spark, sf_dir):
    """WIN-16, INC-08: each task's attempts after its grants, of which each counts once."""
    grants = load(spark, sf_dir, "events").select(F.expr("event_id div 3").alias("grant_id"), F.col("user_id").alias("task"), (1 + F.col("event_id") % 3).alias("attempts"))
    return L.granted_limits(grants, 3)


@query("""WITH r AS (SELECT DISTINCT sha256(text) AS request_sha FROM documents), c AS (SELECT sha256(text) AS request_sha, max(source) FILTER (doc_id % 4 <> 1) AS answer FROM documents WHERE doc_id % 3 <> 0 GROUP BY 1)
  SELECT request_sha, answer FROM r LEFT JOIN c USING (request_sha)""")
def cached_answers(spark, sf_dir):
    """INC-05, INC-09: requests with a valid cached answer, and those without, for which none is given; invalid ones are misses."""
    d = load(spark, sf_dir, "documents").withColumn("request_sha", F.sha2("text", 256))
    cache = d.where("doc_id % 3 <> 0").groupBy("request_sha").agg(F.max(F.when(F.col("doc_id") % 4 != 1, F.col("source"))).alias("answer"))
    hits, misses = S.cached_or(d.select("request_sha").distinct(), cache.withColumn("valid", F.col("answer").isNotNull()))
    return hits.unionByName(misses.withColumn("answer", F.lit(None).cast("string")))


@query("""SELECT law_id, published_at FROM (SELECT law_id, published_at FROM law WHERE review <> 'rejected' AND published_at >= DATE '1996-01-01' AND law_id % 2 = 0 ORDER BY published_at DESC, law_id LIMIT 200)""", "law")
def law_scope(spark, sf_dir):
    """FIL-18: the newest two hundred of the chosen laws since a day; the limit is the feature."""
    laws = model(spark, sf_dir, "law").where("review <> 'rejected' and published_at >= date'1996-01-01' and law_id % 2 = 0")
    return laws.orderBy(F.desc("published_at"), "law_id").limit(200).select("law_id", "published_at")


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer WHERE contains(lower(c_name || ' ' || c_mktsegment), '01') AND contains(lower(c_name || ' ' || c_mktsegment), 'uil') AND c_acctbal > 0""")
def filtered_ballots(spark, sf_dir):
    """FIL-07, FIL-08: rows whose names hold every word of a search, of one choice."""
    c = load(spark, sf_dir, "customer")
    return c.where(T.matches_all(F.lower(F.concat_ws(" ", "c_name", "c_mktsegment")), "01 UIL") & (F.col("c_acctbal") > 0)).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))


_ALIASES = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in T.ALIASES.items()) + "}"
_TAGS = list(T.ALIASES)


@query(f"""SELECT item_id, 'T' || item_id || ' ' || text || ' q k1 k2 ' || coalesce({_ALIASES}[['{"', '".join(_TAGS)}'][1 + item_id % {len(_TAGS)}]], '') AS text FROM benchmark""")
def criterion_texts(spark, sf_dir):
    """TXT-03: a criterion's text for retrieval, with the synonyms of its tag."""
    tag = F.element_at(F.array(*[F.lit(t) for t in _TAGS]), (1 + F.col("item_id") % len(_TAGS)).cast("int"))
    title = F.concat(F.lit("T"), F.col("item_id").cast("string"))
    return load(spark, sf_dir, "benchmark").select("item_id", T.criterion_text(title, F.col("text"), F.lit("q"), F.array(F.lit("k1"), F.lit("k2")), F.array(tag)).alias("text"))
