"""What judges are shown, what may be quoted, where bookmarks point, and outlines without a model."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import checks as K
from ..operators import context as X
from ..operators.retrieval import telling_terms
from ..session import spread
from ..tables import load
from .registry import query
from .text_queries import ITEM_TERMS, Q_TERMS

CLAUSE, BUDGET = "ion was|as an|er the", 24_000
LAW_PASSAGES = "SELECT doc_id // 16 AS law_id, row_number() OVER (PARTITION BY doc_id // 16 ORDER BY doc_id, line_no) - 1 AS ordinal, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"


@query(f"""WITH RECURSIVE p AS ({LAW_PASSAGES}), t AS (SELECT item_id, unnest(list_distinct({ITEM_TERMS})) AS term FROM benchmark), telling AS (SELECT * FROM t WHERE term IN (SELECT term FROM t GROUP BY term HAVING count(*) <= 3)),
  s AS (SELECT law_id, ordinal, item_id AS criterion_id, count(*) AS score FROM (SELECT law_id, ordinal, unnest(list_distinct({Q_TERMS.format(c='text')})) AS term FROM p) JOIN telling USING (term) GROUP BY ALL),
  r AS (SELECT law_id, criterion_id, ordinal, row_number() OVER (PARTITION BY law_id, criterion_id ORDER BY score DESC, ordinal) - 1 AS position FROM s),
  o AS (SELECT law_id, o AS ordinal, min((position, criterion_id)) AS first FROM (SELECT law_id, position, criterion_id, unnest(range(ordinal - 2, ordinal + 3)) AS o FROM r) GROUP BY ALL),
  n AS MATERIALIZED (SELECT law_id, first[1] AS round, ordinal, length(text) AS size, row_number() OVER (PARTITION BY law_id ORDER BY first, ordinal) AS n FROM p JOIN o USING (law_id, ordinal)),
  f AS (SELECT law_id, n, ordinal, round, false AS stopped, size <= {BUDGET} AS take, CASE WHEN size <= {BUDGET} THEN size ELSE 0 END AS used FROM n WHERE n = 1
    UNION ALL SELECT law_id, n, ordinal, round, stop_, NOT stop_ AND used + size <= {BUDGET}, used + CASE WHEN NOT stop_ AND used + size <= {BUDGET} THEN size ELSE 0 END
      FROM (SELECT n.*, f.used, f.stopped OR (n.round <> f.round AND f.used >= {BUDGET} - 500) AS stop_ FROM f JOIN n ON n.law_id = f.law_id AND n.n = f.n + 1)),
  c AS MATERIALIZED (SELECT law_id, ordinal, length(text) AS size, row_number() OVER (PARTITION BY law_id ORDER BY ordinal) AS n FROM p ANTI JOIN (SELECT law_id, ordinal FROM f WHERE take) USING (law_id, ordinal) WHERE regexp_matches(text, '{CLAUSE}')),
  g AS (SELECT law_id, 0::BIGINT AS n, NULL::BIGINT AS ordinal, false AS take, coalesce(max(used), 0) AS used FROM (SELECT DISTINCT law_id FROM p) LEFT JOIN f USING (law_id) GROUP BY law_id
    UNION ALL SELECT c.law_id, c.n, c.ordinal, used + size <= {BUDGET}, used + CASE WHEN used + size <= {BUDGET} THEN size ELSE 0 END FROM g JOIN c ON c.law_id = g.law_id AND c.n = g.n + 1),
  u AS (SELECT law_id, ordinal, true AS offered FROM f WHERE take UNION ALL SELECT law_id, ordinal, false FROM g WHERE take), k AS (SELECT law_id, count(*) AS whole FROM p GROUP BY 1)
  SELECT law_id, ordinal, offered, count(*) OVER (PARTITION BY law_id) < whole AS partial FROM u JOIN k USING (law_id)""")
def legal_context(spark, sf_dir):
    """WIN-11: for each law, passages of all criteria's rankings in turn with two neighbours, within 24,000 characters, then clauses.

    A law is sixteen documents, a passage one of their lines; a passage is ranked by the terms that it shares with a
    benchmark passage and that at most three of these have.
    """
    lines = load(spark, sf_dir, "documents").select(F.expr("doc_id div 16").alias("law_id"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    place = F.row_number().over(Window.partitionBy("law_id").orderBy("doc_id", "line_no")) - 1
    passages = lines.select("law_id", place.cast("long").alias("ordinal"), "text")
    asked = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("criterion_id"), F.explode(F.array_distinct(T.terms(F.col("text")))).alias("term"))
    telling = telling_terms(asked, 3)
    shared = passages.select("law_id", "ordinal", F.explode(F.array_distinct(T.terms(F.col("text")))).alias("term")).join(telling, "term")
    scored = shared.groupBy("law_id", "ordinal", "criterion_id").agg(F.count("*").alias("score"))
    position = F.row_number().over(Window.partitionBy("law_id", "criterion_id").orderBy(F.desc("score"), "ordinal")) - 1
    ranked = scored.select("law_id", "criterion_id", "ordinal", position.cast("long").alias("position"))
    return X.legal_context(passages, ranked, clause=CLAUSE, budget=BUDGET)


BLOCKS = """SELECT doc_id, line_no AS pos, line_no // 12 AS page, line_no AS line_start, line_no + (length(text) > 900)::INT AS line_end, sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - length(text) - 1 AS from_char, sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS to_char
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"""


def _blocks(spark, sf_dir):
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    upto = F.sum(F.length("text") + 1).over(Window.partitionBy("doc_id").orderBy("pos")) - 1
    line = F.col("pos").cast("long")
    return lines.select("doc_id", line.alias("pos"), F.floor(F.col("pos") / 12).alias("page"), line.alias("line_start"), (line + (F.length("text") > 900).cast("int")).alias("line_end"), (upto - F.length("text")).alias("from_char"), upto.alias("to_char"))


def islands_sql(group: str) -> str:
    """CTEs b (blocks in groups), n and i (doc_id, grp, pos, island); `group` is SQL for a block's group."""
    return f"""b AS (SELECT *, {group} AS grp FROM ({BLOCKS})),
  n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, grp ORDER BY pos) AS n FROM b),
  i AS (SELECT doc_id, grp, pos, n, page, line_end, from_char, 0::BIGINT AS island FROM n WHERE n = 1
    UNION ALL SELECT n.doc_id, n.grp, n.pos, n.n, n.page, n.line_end, CASE WHEN cut THEN n.from_char ELSE i_from END, island + cut::BIGINT FROM
      (SELECT n.*, i.from_char AS i_from, i.island, n.page <> i.page OR n.line_start <= i.line_end OR n.to_char - i.from_char > 4500 AS cut FROM i JOIN n ON n.doc_id = i.doc_id AND n.grp = i.grp AND n.n = i.n + 1) n)"""


@query(f"WITH RECURSIVE {islands_sql('pos // 40')} SELECT doc_id, grp, pos, island FROM i")
def quotable_islands(spark, sf_dir):
    """TXT-28: what of a proposed group may be quoted as one: of one page, without overlaps, of at most 4,500 characters."""
    blocks = _blocks(spark, sf_dir).withColumn("group", F.floor(F.col("pos") / 40))
    return X.islands(blocks).select("doc_id", F.col("group").alias("grp"), "pos", F.col("island").cast("long").alias("island"))


CACHED = """SELECT doc_id, page, low AS start, CASE WHEN doc_id % 5 = 1 AND page = 1 THEN high - 1 ELSE high END AS stop, CASE WHEN doc_id % 7 <> 0 THEN 'section ' || page END AS section
    FROM (SELECT doc_id, page, min(pos) AS low, max(pos) AS high FROM b GROUP BY ALL) WHERE doc_id % 3 <> 0
    UNION ALL SELECT doc_id, page, min(pos), max(pos), 'whole page' FROM b WHERE doc_id % 11 = 0 GROUP BY ALL"""


@query(f"""WITH RECURSIVE {islands_sql('page')}, cached AS ({CACHED}),
  pages AS (SELECT doc_id, page, min(pos) AS low, max(pos) AS high FROM b GROUP BY ALL),
  sound AS (SELECT doc_id, page FROM (SELECT c.*, low, high, lag(stop) OVER (PARTITION BY c.doc_id, c.page ORDER BY start, stop) AS before FROM cached c JOIN pages USING (doc_id, page)) GROUP BY ALL
    HAVING bool_and(start = coalesce(before + 1, low) AND stop >= start AND section IS NOT NULL) AND max(stop) = max(high))
  SELECT doc_id, start, stop, section, false AS recovered FROM cached SEMI JOIN sound USING (doc_id, page)
  UNION ALL SELECT doc_id, min(pos), max(pos), 'page ' || grp, true FROM i ANTI JOIN (SELECT doc_id, page AS grp FROM sound) USING (doc_id, grp) GROUP BY doc_id, grp, island""")
def outline_recovery(spark, sf_dir):
    """LLM-11: cached ranges where they tile their page, else islands of the page's own blocks; each document is tiled (VAL-11)."""
    return _outline(spark, sf_dir)


def _outline(spark, sf_dir):
    blocks = _blocks(spark, sf_dir)
    pages = blocks.groupBy("doc_id", "page").agg(F.min("pos").alias("start"), F.max("pos").alias("high"))
    stop = F.when((F.col("doc_id") % 5 == 1) & (F.col("page") == 1), F.col("high") - 1).otherwise(F.col("high"))
    first = pages.where("doc_id % 3 <> 0").select("doc_id", "page", "start", stop.alias("stop"), F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("section "), F.col("page").cast("string"))).alias("section"))
    second = pages.where("doc_id % 11 = 0").select("doc_id", "page", "start", F.col("high").alias("stop"), F.lit("whole page").alias("section"))
    return X.recovered_outline(blocks, first.unionByName(second))


@query("SELECT doc_id, 0 AS faults FROM documents WHERE text IS NOT NULL")
def outline_tiles(spark, sf_dir):
    """LLM-11, VAL-11: no recovered outline leaves a gap or overlaps; one row a document, with the number of faults."""
    blocks = _blocks(spark, sf_dir)
    ranges = _outline(spark, sf_dir).select("doc_id", "start", F.col("stop").alias("end"))
    faults = K.tiles(ranges, blocks.groupBy("doc_id").agg(F.count("*").alias("size"))).groupBy("entity_id").agg(F.count("*").alias("n"))
    each = blocks.select("doc_id").distinct().join(faults, F.col("doc_id").cast("string") == F.col("entity_id"), "left")
    return each.select("doc_id", F.coalesce("n", F.lit(0)).cast("int").alias("faults"))


@query("""WITH l AS (SELECT o_custkey AS doc_id, o_orderkey AS leaf, row_number() OVER w AS pos, (row_number() OVER w - 1) // 4 AS page, ['root', o_orderpriority, o_orderpriority || '/' || o_orderstatus, o_orderpriority || '/' || o_orderstatus || '/' || (o_orderkey % 3)][1:4 - (o_orderkey % 4 = 0)::INT - (o_orderkey % 28 = 0)::INT * 2] AS path FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
  a AS (SELECT *, CASE WHEN len(path) > 1 THEN path[2:] ELSE path END AS own FROM l), b AS (SELECT *, coalesce(lag(own) OVER (PARTITION BY doc_id ORDER BY pos), []) AS before FROM a),
  s AS (SELECT doc_id, pos, page, own, coalesce(list_min(list_filter(range(1, len(own) + 1), lambda k: own[k] IS DISTINCT FROM before[k])), len(own) + 1) AS first FROM b),
  e AS (SELECT doc_id, pos, page, unnest(own[first:]) AS section, unnest(range(first, len(own) + 1)) AS depth FROM s),
  n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY pos, depth) AS nth FROM e)
  SELECT doc_id, page, CASE WHEN nth = 1 THEN section ELSE section || '-continuation-' || nth END AS anchor, pos FROM n UNION ALL SELECT doc_id, page, leaf::VARCHAR, pos FROM l
  UNION ALL SELECT doc_id, page, 'root', pos FROM l WHERE len(path) > 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) = 1""")
def page_anchors(spark, sf_dir):
    """TXT-18: a customer's orders as leaves below priority, status and a third level; anchors by common path prefix."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = spread(load(spark, sf_dir, "orders"), "o_custkey").withColumn("pos", F.row_number().over(w).cast("long"))
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    levels = F.array(F.lit("root"), p, F.concat_ws("/", p, s), F.concat_ws("/", p, s, F.col("o_orderkey") % 3))
    depth = 4 - (F.col("o_orderkey") % 4 == 0).cast("int") - (F.col("o_orderkey") % 28 == 0).cast("int") * 2
    leaves = o.select(F.col("o_custkey").alias("doc_id"), "pos", F.floor((F.col("pos") - 1) / 4).alias("page"), F.col("o_orderkey").cast("string").alias("leaf_id"), F.slice(levels, 1, depth).alias("path"))
    return X.page_anchors(leaves)
