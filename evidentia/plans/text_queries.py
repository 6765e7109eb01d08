"""Retrieval and text over documents, benchmark passages, pages and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import retrieval as R
from ..tables import load
from .registry import query

STOP = "[" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "]"
Q_WORDS = r"regexp_extract_all(replace(lower({c}), 'ß', 'ss'), '[\p{{L}}\p{{N}}_]+')"
Q_TERMS = f"list_filter({Q_WORDS}, lambda w: length(w) > 2 AND NOT list_contains({STOP}, w))"
DOC_TERMS, ITEM_TERMS = Q_TERMS.format(c="text"), Q_TERMS.format(c="text")

def bm25_sql(docs: str, queries: str, p: str = "") -> str:
    """CTEs up to {p}s (query_id, id, score) for docs (id, text) and queries (query_id, text)."""
    return f"""{p}d AS (SELECT id, unnest({DOC_TERMS}) AS term FROM ({docs})), {p}tf AS (SELECT id, term, count(*) AS tf FROM {p}d GROUP BY ALL), {p}len AS (SELECT id, sum(tf) AS length FROM {p}tf GROUP BY id),
  {p}n AS (SELECT count(*) AS n FROM ({docs})), {p}mean AS (SELECT greatest(1, sum(tf) * 1.0 / (SELECT n FROM {p}n)) AS mean FROM {p}tf), {p}df AS (SELECT term, count(*) AS df FROM {p}tf GROUP BY term),
  {p}w AS (SELECT id, term, ln(1 + ((SELECT n FROM {p}n) - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / (SELECT mean FROM {p}mean))) AS weight FROM {p}tf JOIN {p}len USING (id) JOIN {p}df USING (term)),
  {p}q AS (SELECT DISTINCT query_id, unnest({DOC_TERMS}) AS term FROM ({queries})), {p}s AS (SELECT query_id, id, round(sum(weight), 6) AS score FROM {p}q JOIN {p}w USING (term) GROUP BY ALL HAVING round(sum(weight), 6) > 0)"""


DOCS, ITEMS = "SELECT doc_id AS id, text FROM documents", "SELECT item_id AS id, text FROM benchmark"
BM25 = "WITH " + bm25_sql(DOCS, "SELECT item_id AS query_id, text FROM benchmark")


def _scores(spark, sf_dir, terms=T.terms):
    return R.rank(load(spark, sf_dir, "benchmark"), "item_id", load(spark, sf_dir, "documents"), "doc_id", terms=terms)


@query(BM25 + " SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s QUALIFY rank <= 6")
def bm25_topk(spark, sf_dir):
    """AGG-13, AGG-14, JOIN-05, WIN-01: the six best documents of each benchmark passage."""
    return R.top(_scores(spark, sf_dir), 6, "query_id")


@query(BM25 + ", l AS (SELECT s.*, lang FROM s JOIN documents ON id = doc_id) SELECT query_id, lang, id, score, row_number() OVER (PARTITION BY query_id, lang ORDER BY score DESC, id) AS rank FROM l QUALIFY rank <= 2")
def bm25_per_group_quota(spark, sf_dir):
    """WIN-01: the two best documents of each language for each passage."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return R.top(_scores(spark, sf_dir).join(docs, "id"), 2, "query_id", "lang").select("query_id", "lang", "id", "score", "rank")


TITLED = "SELECT doc_id, source || ' ' || text AS text FROM documents"
WINDOWS = "SELECT doc_id || ':' || o AS query_id, source || ' ' || substr(text, CAST(o AS INT) + 1, 8000) AS text FROM (SELECT doc_id, source, text, unnest(range(0, length(text), 6000)) AS o FROM documents)"


@query(f"""WITH {bm25_sql(ITEMS, TITLED.replace('doc_id,', 'doc_id AS query_id,'), 'a')}, {bm25_sql(ITEMS, WINDOWS, 'b')}, {bm25_sql(TITLED.replace('doc_id,', 'doc_id AS id,'), 'SELECT item_id AS query_id, text FROM benchmark', 'c')},
  u AS (SELECT query_id AS law_id, id AS criterion_id FROM (SELECT * FROM as_ QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 12)
    UNION SELECT split_part(query_id, ':', 1)::BIGINT, id FROM (SELECT * FROM bs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 2)
    UNION SELECT id, query_id FROM (SELECT * FROM cs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 3))
  SELECT law_id, criterion_id FROM u JOIN documents ON law_id = doc_id WHERE (criterion_id % 2 = 0) = (lang = 'en')""".replace("as AS (", "as_ AS (").replace("FROM as_", "FROM as_"))
def candidate_union(spark, sf_dir):
    """WIN-02, TXT-26, SET-01, SET-02: passages for documents and their windows, and documents for passages, ranked first, then eligible."""
    docs, items = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    laws, criteria = docs.select(F.col("doc_id").alias("law_id"), F.col("source").alias("title"), "text"), items.select(F.col("item_id").alias("criterion_id"), "text")
    found = R.candidates(laws, criteria).join(docs.select(F.col("doc_id").alias("law_id"), "lang"), "law_id")
    return found.where((F.col("criterion_id") % 2 == 0) == (F.col("lang") == "en")).select("law_id", "criterion_id")


@query("""SELECT doc_id, o AS "offset", length(substr(text, CAST(o AS INT) + 1, 8000)) AS n, sha256(substr(text, CAST(o AS INT) + 1, 8000)) AS part_sha256
  FROM (SELECT doc_id, text, unnest(range(0, length(text), 6000)) AS o FROM documents)""")
def text_windows(spark, sf_dir):
    """TXT-26: windows of 8,000 characters at a stride of 6,000."""
    each = load(spark, sf_dir, "documents").select("doc_id", F.explode(T.text_windows(F.col("text"))).alias("w"))
    return each.select("doc_id", F.col("w.offset").cast("long").alias("offset"), F.length("w.part").cast("long").alias("n"), T.digest(F.col("w.part")).alias("part_sha256"))


@query(f"""SELECT doc_id, len({Q_WORDS.format(c='text').replace("replace(lower(text), 'ß', 'ss')", 'text')}) AS n_words, len({DOC_TERMS}) AS n_terms, len(list_distinct({DOC_TERMS})) AS n_distinct FROM documents""")
def token_stats(spark, sf_dir):
    """TXT-02, TXT-14: words, index terms and distinct terms of each document."""
    t = F.col("terms")
    docs = load(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).cast("long").alias("n_words"), T.terms(F.col("text")).alias("terms"))
    return docs.select("doc_id", "n_words", F.size(t).cast("long").alias("n_terms"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


SELF = "WITH " + bm25_sql(ITEMS, "SELECT item_id AS query_id, text FROM benchmark")


SQL_PAIRS = SELF + f""", near AS (SELECT query_id, id FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 7),
  p AS (SELECT DISTINCT least(query_id, id) AS left_id, greatest(query_id, id) AS right_id FROM near WHERE query_id <> id),
  t AS (SELECT item_id, list_distinct({ITEM_TERMS}) AS terms, list_sort(list_distinct(regexp_extract_all(text, '\\d+(?:[.,]\\d+)?'))) AS numbers FROM benchmark),
  j AS (SELECT left_id, right_id, round(len(list_intersect(a.terms, b.terms)) * 1.0 / greatest(1, len(list_distinct(list_concat(a.terms, b.terms)))), 6) AS jaccard
    FROM p JOIN t a ON a.item_id = left_id JOIN t b ON b.item_id = right_id WHERE a.numbers = b.numbers)
  SELECT * FROM j WHERE jaccard >= 0.02"""


@query(SQL_PAIRS)
def jaccard_pairs(spark, sf_dir):
    """AGG-15, JOIN-06, FIL-16: pairs of passages among each other's neighbours, equal in numbers, by term overlap."""
    items = load(spark, sf_dir, "benchmark")
    return R.equal_pairs(items, "item_id", F.col("text"), [], R.rank(items, "item_id", items, "item_id"), share=0.02)


WS = r"trim(regexp_replace({c}, '[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"


FOLDED = WS.format(c="text")


@query(f"""WITH b AS (SELECT item_id, spaced, text AS quote, {FOLDED} AS q FROM (SELECT item_id, false AS spaced, text FROM benchmark UNION ALL SELECT item_id, true, replace(text, ' ', chr(10) || ' ') FROM benchmark)),
  d AS (SELECT doc_id, text AS source, {FOLDED} AS s FROM documents)
  SELECT item_id, spaced, doc_id, CASE WHEN length(q) < 10 THEN 'short' WHEN contains(source, quote) THEN 'exact' WHEN contains(substr(s, CAST(strpos(s, q) AS INT) + 1), q) THEN 'ambiguous' ELSE 'restored' END AS status
  FROM b JOIN d ON contains(s, q) WHERE len(string_split(q, ' ')) >= 3""")
def quote_anchor(spark, sf_dir):
    """TXT-01: how benchmark passages of three words and more, as they are and with other white space, anchor in documents."""
    b = load(spark, sf_dir, "benchmark")
    quotes = b.select("item_id", F.lit(False).alias("spaced"), F.col("text").alias("quote")).unionByName(b.select("item_id", F.lit(True).alias("spaced"), F.replace("text", F.lit(" "), F.lit("\n ")).alias("quote")))
    docs = load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source"))
    return R.anchored(quotes, ["item_id", "spaced"], docs, "doc_id").select("item_id", "spaced", "doc_id", "status")


LONG = r"list_distinct(regexp_extract_all(replace(lower(regexp_replace({c}, '([\p{{L}}\p{{N}}_])[-\x{{AD}}]\s*\n\s*([\p{{L}}\p{{N}}_])', '\1\2', 'g')), 'ß', 'ss'), '\p{{L}}{{4,}}'))"


@query(f"""WITH w AS (SELECT conv_id, turn, {LONG.format(c='text')} AS now, {LONG.format(c="coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '')")} AS after FROM conversations)
  SELECT conv_id, turn, CASE WHEN len(now) >= 8 THEN round_even(len(list_intersect(now, after)) / len(now), 3) END AS recall FROM w""")
def word_recall(spark, sf_dir):
    """TXT-11: how many longer words of a turn come again in the next."""
    following = F.coalesce(F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(""))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", T.native_recall(F.col("text"), following).alias("recall"))


@query("""WITH l AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) > 12 GROUP BY ALL)
  SELECT doc_id, max(n) AS most FROM l GROUP BY doc_id HAVING max(n) >= 4""")
def repeated_lines(spark, sf_dir):
    """TXT-13: documents in which a longer line stands four times or more."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") > 12)
    return lines.groupBy("doc_id", "line").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.max("n").alias("most")).where("most >= 4")


@query(r"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '!\[([^\]]*)\]\([^\n)]*\)', '\1', 'g'), '(?m)^[ \t]*img-\d+\.(?:jpeg|jpg|png)[ \t]*$', '', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '\x{AD}\n?', '', 'g'), '\n{3,}', E'\n\n', 'g') AS t FROM documents)
  SELECT doc_id, length(x) AS n, sha256(x) AS text_sha256 FROM (SELECT doc_id, regexp_replace(t, '^\s+|\s+$', '', 'g') AS x FROM c)""")
def clean_text(spark, sf_dir):
    """TXT-09: cleaned documents, by length and digest."""
    clean = T.clean_markdown(F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", F.length(clean).cast("long").alias("n"), T.digest(clean).alias("text_sha256"))


@query("""SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) GROUP BY ALL""")
def page_links(spark, sf_dir):
    """SRC-05: links of each page."""
    each = load(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    return each.groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query(r"""WITH r AS (SELECT page_id, list_sort(list_distinct(list_transform(regexp_extract_all(html, '\b\d{1,2}/\s*\d{1,6}\b'), lambda x: regexp_replace(x, '\s', '', 'g')))) AS refs FROM pages)
  SELECT page_id, len(refs) AS n, array_to_string(refs, ',') AS refs FROM r""")
def document_refs(spark, sf_dir):
    """TXT-06: document numbers in each page."""
    refs = load(spark, sf_dir, "pages").select("page_id", T.document_numbers(F.col("html")).alias("refs"))
    return refs.select("page_id", F.size("refs").cast("long").alias("n"), F.array_join("refs", ",").alias("refs"))


@query(r"""WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
  k AS (SELECT doc_id, pos, trim(regexp_replace(line, '\s+', ' ', 'g')) AS block FROM b WHERE regexp_matches(line, '\S')),
  o AS (SELECT doc_id, pos, block, row_number() OVER (PARTITION BY doc_id, replace(lower(block), 'ß', 'ss') ORDER BY pos) AS occurrence FROM k)
  SELECT doc_id, pos, occurrence, 'leaf-' || substr(sha256(replace(lower(doc_id || ':' || occurrence || ':' || block), 'ß', 'ss')), 1, 16) AS leaf_id FROM o""")
def leaf_blocks(spark, sf_dir):
    """SRC-09, WIN-07, TXT-31: lines as leaves, repeated ones numbered, with stable ids."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.col("line").rlike(r"\S"))
    block = F.trim(F.regexp_replace("line", r"\s+", " "))
    nth = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("pos"))
    rows = lines.select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), block.alias("block")).withColumn("key", T.folded(F.col("block"))).withColumn("occurrence", nth.cast("long"))
    return rows.select("doc_id", "pos", "occurrence", T.stable_id("leaf", F.concat_ws(":", "doc_id", "occurrence", "block")).alias("leaf_id"))


@query("""SELECT conv_id, turn, length(text) AS n, right(lag(text) OVER w, 40) AS before, left(lead(text) OVER w, 40) AS after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def neighbour_context(spark, sf_dir):
    """WIN-09: the end of the turn before and the start of the turn after."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("n"), F.right(F.lag("text").over(w), F.lit(40)).alias("before"), F.left(F.lead("text").over(w), F.lit(40)).alias("after"))


@query("""WITH b AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM conversations)
  SELECT conv_id, CAST(block AS BIGINT) AS block, count(*) AS turns, sha256(string_agg(text, chr(10) ORDER BY turn)) AS text_sha256 FROM b WHERE role <> 'user' GROUP BY conv_id, block""")
def chair_blocks(spark, sf_dir):
    """SRC-10: a chair's turns between speeches, joined; a speech ends a block."""
    block = F.sum((F.col("role") == "user").cast("long")).over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = load(spark, sf_dir, "conversations").withColumn("block", block).where("role <> 'user'")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return rows.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), T.digest(F.array_join(parts, "\n")).alias("text_sha256"))


@query("""WITH p AS (SELECT n, ceil(n / 50.0) AS pages FROM (SELECT count(*) AS n FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'on') AND lang = 'en'))
  SELECT doc_id, length(text) AS n, 2 AS page, CAST((SELECT pages FROM p) AS INT) AS pages, CAST((SELECT n FROM p) AS INT) AS total FROM documents
  WHERE contains(lower(text), 'the') AND contains(lower(text), 'on') AND lang = 'en' ORDER BY length(text) DESC, doc_id LIMIT 50 OFFSET 50""")
def paginate_search(spark, sf_dir):
    """FIL-05, ORD-02: the second page of a search; a page is the feature."""
    from ..operators.tables import paginate

    docs = load(spark, sf_dir, "documents")
    found = docs.where(T.matches_all(F.lower("text"), "the on") & (F.col("lang") == "en")).select("doc_id", F.length("text").cast("long").alias("n"))
    return paginate(found, 2, 50, F.desc("n"), F.asc("doc_id"))


@query("""SELECT doc_id, 'documents' AS collection, sha256(concat_ws(' ', lang, source, text)) AS search_sha256, '/documents/' || doc_id || '/' AS url FROM documents
  UNION ALL SELECT item_id, 'benchmark', sha256(text), '/benchmark/' || item_id || '/' FROM benchmark""")
def search_index(spark, sf_dir):
    """SNK-04: the search text and address of every record."""
    d, b = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    row = lambda df, key, name, *cols: df.select(F.col(key).alias("doc_id"), F.lit(name).alias("collection"), T.digest(F.concat_ws(" ", *cols)).alias("search_sha256"), F.concat(F.lit(f"/{name}/"), F.col(key), F.lit("/")).alias("url"))
    return row(d, "doc_id", "documents", "lang", "source", "text").unionByName(row(b, "item_id", "benchmark", "text"))
