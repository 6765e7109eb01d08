"""Merges, checks, ledgers, hierarchies and products over the input tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions import text as T
from ..operators import chunks as C
from ..operators import ledger as L
from ..operators import retrieval as R
from ..operators import tables as B
from ..operators import votes as V
from ..tables import load, model
from .registry import query


@query("""SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def anti_pending(spark, sf_dir):
    """JOIN-10, SET-03: documents without a label."""
    return load(spark, sf_dir, "documents").select("doc_id").join(load(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""SELECT 'order has customer' AS rule, CAST(o_custkey AS VARCHAR) AS entity_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 2
  UNION ALL SELECT 'line has order', CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 2
  UNION ALL SELECT 'line has part', CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2
  UNION ALL SELECT 'label has document', CAST(doc_id AS VARCHAR) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) GROUP BY 2
  UNION ALL SELECT 'one line per number', l_orderkey || ':' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  UNION ALL SELECT 'ships after order', CAST(l_orderkey AS VARCHAR) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""")
def integrity_violations(spark, sf_dir):
    """JOIN-11, VAL-01, VAL-05, VAL-13, VAL-14, SET-05."""
    o, c, li, p, d, lb = (load(spark, sf_dir, n) for n in ("orders", "customer", "lineitem", "part", "documents", "labels"))
    found = B.integrity({"order has customer": (o, "o_custkey", c, "c_custkey"), "line has order": (li, "l_orderkey", o, "o_orderkey"), "line has part": (li, "l_partkey", p, "p_partkey"), "label has document": (lb, "doc_id", d, "doc_id")})
    late = li.select("l_orderkey", "l_shipdate").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return found.unionByName(B.duplicates(li, "one line per number", "l_orderkey", "l_linenumber")).unionByName(B.violations(late, "ships after order", "l_orderkey", F.col("l_shipdate") < F.col("o_orderdate")))


@query("""WITH a AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus <> 'P'), f AS (SELECT l_orderkey AS id, CAST(max(l_shipdate) AS DATE) AS day FROM lineitem GROUP BY 1)
  SELECT id, coalesce(a.day, f.day) AS day, CASE WHEN a.day IS NOT NULL THEN 'archive' ELSE 'feed' END AS origin, coalesce(a.day <> f.day, false) AS conflict FROM a FULL JOIN f USING (id)""")
def archive_union_conflict(spark, sf_dir):
    """JOIN-12: archive and feed by id; the archive wins, a different day is a conflict."""
    a = load(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"))
    f = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_shipdate").cast("date").alias("day"))
    return B.union_first(a, f, "id", "day")


@query("""WITH o AS (SELECT doc_id, CAST(quality AS INT) AS old, CAST(toxic AS INT) AS generated FROM labels), n AS (SELECT doc_id, CAST(n_chars > 800 AS INT) AS new FROM documents WHERE lang <> 'es')
  SELECT doc_id, CASE WHEN new IS NULL THEN 'kept' WHEN generated IS NULL AND old IS NULL THEN 'inserted' WHEN old IS DISTINCT FROM generated THEN 'preserved' WHEN old = new THEN 'unchanged' ELSE 'written' END AS action,
    CASE WHEN action IN ('inserted', 'written') THEN new ELSE old END AS quality FROM o FULL JOIN n USING (doc_id)""")
def merge_upsert(spark, sf_dir):
    """JOIN-15, JOIN-16: generated values replace only what was generated; edits stay."""
    old = load(spark, sf_dir, "labels").select("doc_id", "quality", F.col("toxic").alias("generated"))
    new = load(spark, sf_dir, "documents").where("lang <> 'es'").select("doc_id", (F.col("n_chars") > 800).cast("int").alias("quality"))
    return B.merge_upsert(old, new, "doc_id", "quality")


@query("""WITH b AS (SELECT doc_id, sha256(text) AS was FROM documents WHERE lang <> 'fr'), a AS (SELECT doc_id, sha256(CASE WHEN lang = 'de' THEN upper(text) ELSE text END) AS now FROM documents WHERE lang <> 'es')
  SELECT doc_id, CASE WHEN was IS NULL THEN 'new' WHEN now IS NULL THEN 'gone' ELSE 'changed' END AS change FROM b FULL JOIN a USING (doc_id) WHERE was IS DISTINCT FROM now""")
def signature_diff(spark, sf_dir):
    """INC-01, INC-10: what is new, changed or gone between two states, by content signature."""
    d = load(spark, sf_dir, "documents")
    before = d.where("lang <> 'fr'").select("doc_id", T.digest(F.col("text")).alias("signature"))
    after = d.where("lang <> 'es'").select("doc_id", T.digest(F.when(F.col("lang") == "de", F.upper("text")).otherwise(F.col("text"))).alias("signature"))
    return B.signature_diff(before, after, "doc_id")


@query("""WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 'reserve' WHEN 'purchase' THEN 'settle' WHEN 'error' THEN 'unknown' END AS kind, user_id || ':' || (epoch(date_trunc('day', ts))::BIGINT) AS request_id, CAST(round(value, 2) AS DECIMAL(18,6)) AS amount FROM events WHERE event_type IN ('view', 'purchase', 'error')),
  o AS (SELECT user_id, request_id, max(CASE WHEN kind = 'reserve' THEN amount END) AS r, max(CASE WHEN kind = 'settle' THEN amount END) AS s, max(CASE WHEN kind = 'unknown' THEN amount END) AS u FROM e GROUP BY 1, 2),
  t AS (SELECT user_id, count(*) AS requests, sum(coalesce(s, 0)) AS reported, sum(CASE WHEN s IS NULL AND u IS NOT NULL THEN coalesce(r, u) ELSE 0 END) AS unknown, sum(CASE WHEN s IS NULL AND u IS NULL THEN coalesce(r, 0) ELSE 0 END) AS pending FROM o GROUP BY 1)
  SELECT user_id, requests, CAST(reported AS DECIMAL(18,6)) AS reported, CAST(unknown AS DECIMAL(18,6)) AS unknown, CAST(pending AS DECIMAL(18,6)) AS pending, CAST(reported + unknown + pending AS DECIMAL(18,6)) AS exposure, unknown = 0 AND pending = 0 AS complete FROM t""")
def cost_ledger(spark, sf_dir):
    """AGG-18, INC-07, INC-15: exposure per account from reservations, settlements and unknown outcomes."""
    e = load(spark, sf_dir, "events").where("event_type in ('view', 'purchase', 'error')")
    kind = F.when(F.col("event_type") == "view", "reserve").when(F.col("event_type") == "purchase", "settle").otherwise("unknown")
    request = F.concat_ws(":", "user_id", F.unix_timestamp(F.date_trunc("day", "ts")))
    return L.cost_ledger(e.select("user_id", request.alias("request_id"), kind.alias("kind"), F.round("value", 2).cast(L.MONEY).alias("amount")), "user_id")


@query("""WITH a AS (SELECT user_id AS task, epoch(date_trunc('second', ts))::BIGINT AS moment, CASE WHEN event_type = 'purchase' THEN 'done' WHEN event_type = 'signup' THEN 'fatal' ELSE 'failed' END AS outcome FROM events),
  t AS (SELECT task, count(*) AS attempts, arg_max(outcome, moment * 10 + CASE outcome WHEN 'failed' THEN 2 WHEN 'fatal' THEN 3 ELSE 1 END) AS last, max(moment) AS last_at, bool_or(outcome = 'done') AS done FROM a GROUP BY task)
  SELECT task, attempts, last, last_at, done, CASE WHEN NOT done THEN last_at + 60 * (2 ** least(attempts, 40))::BIGINT END AS next_retry_at, NOT done AND last <> 'fatal' AND attempts < 3 AND last_at + 60 * (2 ** least(attempts, 40))::BIGINT <= 1720000000 AS available FROM t""")
def queue_state(spark, sf_dir):
    """FIL-17, INC-04: attempts, backoff and availability of each task after all events."""
    e = load(spark, sf_dir, "events")
    outcome = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "signup", "fatal").otherwise("failed")
    return L.task_state(e.select(F.col("user_id").alias("task"), F.unix_timestamp(F.date_trunc("second", "ts")).alias("at"), outcome.alias("outcome")), 1720000000)


@query("""WITH a AS (SELECT o_custkey AS task, epoch(o_orderdate)::BIGINT AS moment, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'fatal' ELSE 'failed' END AS outcome FROM orders),
  t AS (SELECT task, count(*) AS attempts, arg_max(outcome, moment * 10 + CASE outcome WHEN 'failed' THEN 2 WHEN 'fatal' THEN 3 ELSE 1 END) AS last, max(moment) AS last_at, bool_or(outcome = 'done') AS done FROM a GROUP BY task),
  s AS (SELECT c_nationkey, done, last, NOT done AND last <> 'fatal' AND attempts < 9 AND last_at + 60 * (2 ** least(attempts, 40))::BIGINT <= 1000000000 AS available FROM t JOIN customer ON task = c_custkey)
  SELECT c_nationkey, count(*) AS tasks, count_if(done) AS completed, count_if(last = 'fatal') AS fatal, count_if(available) AS ready, CASE WHEN count_if(last = 'fatal') > 0 THEN 'blocked' WHEN count_if(done) = count(*) THEN 'completed' WHEN count_if(available) > 0 THEN 'continuing' ELSE 'needs_attention' END AS status FROM s GROUP BY 1""")
def queue_rollup(spark, sf_dir):
    """AGG-16, AGG-17: progress of each group's tasks and its status."""
    o = load(spark, sf_dir, "orders")
    outcome = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "fatal").otherwise("failed")
    tasks = L.task_state(o.select(F.col("o_custkey").alias("task"), F.unix_timestamp("o_orderdate").alias("at"), outcome.alias("outcome")), 1000000000, limit=9)
    return L.progress(tasks.join(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("task"), "c_nationkey"), "task"), "c_nationkey")


@query("""WITH i AS (SELECT p_partkey AS id, p_brand || '/' || p_size AS reference, p_name AS title FROM part), r AS (SELECT p_brand || '/' || p_size AS reference, p_partkey AS target FROM part WHERE p_size > 40),
  t AS (SELECT p_name AS title, p_partkey AS target FROM part WHERE p_retailprice > 1000), f AS (SELECT id, count(*) AS n, min(target) AS target, 'reference' AS how FROM i JOIN r USING (reference) GROUP BY id),
  s AS (SELECT id, count(*) AS n, min(target) AS target, 'title' AS how FROM i JOIN t USING (title) WHERE id NOT IN (SELECT id FROM f) GROUP BY id)
  SELECT id, CASE WHEN n = 1 THEN target END AS target, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE how END AS how FROM i LEFT JOIN (SELECT * FROM f UNION ALL SELECT * FROM s) USING (id)""")
def fallback_resolve(spark, sf_dir):
    """JOIN-07, FIL-13, FIL-14: by reference, else by title; several matches are ambiguous."""
    p = load(spark, sf_dir, "part")
    ref = F.concat_ws("/", "p_brand", "p_size")
    items = p.select(F.col("p_partkey").alias("id"), ref.alias("reference"), F.col("p_name").alias("title"))
    return V.resolve(items, p.where("p_size > 40").select(ref.alias("reference"), F.col("p_partkey").alias("target")), p.where("p_retailprice > 1000").select(F.col("p_name").alias("title"), F.col("p_partkey").alias("target")), "id")


@query("""WITH v AS (SELECT l_orderkey AS vote_id, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS votes, count_if(l_returnflag = 'R') AS yes FROM lineitem GROUP BY 1),
  f AS (SELECT a.vote_id, count(b.vote_id) AS n, min(b.vote_id) AS other_id FROM v a LEFT JOIN (SELECT * FROM v WHERE votes > 100) b ON a.n = b.n AND a.votes = b.votes AND a.yes = b.yes GROUP BY 1)
  SELECT vote_id, CASE WHEN n = 1 THEN other_id END AS other_id, CASE WHEN n = 1 THEN 'matched' WHEN n = 0 THEN 'missing' ELSE 'ambiguous' END AS status FROM f""")
def ballot_match_unique(spark, sf_dir):
    """JOIN-08: votes and the one ballot list with the same tallies."""
    v = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("vote_id")).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("votes"), F.count_if(F.col("l_returnflag") == "R").alias("yes"))
    return V.unique_matches(v, v.where("votes > 100"), ["n", "votes", "yes"], "vote_id")


@query("""WITH l AS (SELECT c_nationkey AS poll, lower(c_mktsegment) AS g, regexp_replace(lower(c_name), '[^\\p{L}\\p{N}_]', '', 'g') AS k, c_acctbal > 0 AS vote FROM customer), r AS (SELECT c_nationkey AS poll, lower(c_mktsegment) AS g, regexp_replace(lower(c_name), '[^\\p{L}\\p{N}_]', '', 'g') AS k, c_acctbal > 500 AS vote FROM customer WHERE c_nationkey < 20),
  s AS (SELECT poll, count(*) AS n, count(DISTINCT (g, k)) AS d FROM l GROUP BY 1), t AS (SELECT poll, count(*) AS n, count(DISTINCT (g, k)) AS d FROM r GROUP BY 1), a AS (SELECT poll, count(*) AS c, count_if(l.vote = r.vote) AS m FROM l JOIN r USING (poll, g, k) GROUP BY 1)
  SELECT poll, total, compared, matched, CASE WHEN compared IS NULL THEN 'unmatched' WHEN compared <> matched THEN 'mismatch' WHEN compared = total THEN 'matched' ELSE 'partial' END AS status FROM
    (SELECT poll, coalesce(s.n, 0) AS total, CASE WHEN s.n = s.d AND t.n = t.d AND s.n = t.n AND c > 0 THEN c END AS compared, CASE WHEN s.n = s.d AND t.n = t.d AND s.n = t.n AND c > 0 THEN m END AS matched FROM s FULL JOIN t USING (poll) LEFT JOIN a USING (poll))""")
def crosscheck_members(spark, sf_dir):
    """JOIN-09, DOM-13, TXT-07, TXT-08: two member lists of each poll by group and name."""
    c = load(spark, sf_dir, "customer")
    side = lambda d, least: d.select(F.col("c_nationkey").alias("poll"), T.group_key(F.col("c_mktsegment")).alias("group_key"), T.name_key(F.col("c_name")).alias("name_key"), (F.col("c_acctbal") > least).alias("vote"))
    return V.compare_members(side(c, 0), side(c.where("c_nationkey < 20"), 500), "poll")


TENOR = "CASE event_type WHEN 'view' THEN 'Annahme in Ausschussfassung' WHEN 'click' THEN 'Ablehnung von Artikel 2' WHEN 'purchase' THEN 'Annahme der Entschließung' WHEN 'error' THEN 'Annahme des Änderungsantrags' ELSE 'Überweisung' END"
READING = "CASE WHEN value < 5 THEN '3. Beratung' WHEN value < 10 THEN '2. Beratung' ELSE '1. Beratung' END"


@query(f"""WITH t AS (SELECT event_id, {TENOR} AS tenor, {READING} AS reading FROM events) SELECT event_id, CASE WHEN contains(lower(tenor), 'entschließung') THEN 'resolution' WHEN contains(lower(tenor), 'änderungsantr') THEN 'amendment' WHEN NOT (starts_with(lower(tenor), 'annahme') OR starts_with(lower(tenor), 'ablehnung')) THEN 'procedural'
  WHEN contains(reading, '3.') THEN 'final_passage' WHEN contains(reading, '2.') THEN 'second_reading' ELSE 'unknown' END AS stage, CASE WHEN contains(tenor, 'Artikel') THEN 'partial_law' ELSE 'whole_law' END AS scope FROM t""")
def stage_scope(spark, sf_dir):
    """FIL-11, FIL-12: stage and scope of decisions by their wording."""
    t = load(spark, sf_dir, "events").select("event_id", F.expr(TENOR).alias("tenor"), F.expr(READING).alias("reading"))
    return t.select("event_id", D.decision_stage(F.col("tenor"), F.col("reading")).alias("stage"), D.decision_scope(F.col("tenor"), F.lit(None)).alias("scope"))


@query("""WITH t AS (SELECT l_orderkey, (l_returnflag = 'R')::INT AS ja, (l_returnflag = 'A')::INT AS nein, (l_returnflag = 'N' OR l_quantity > 45)::INT AS enthalten FROM lineitem)
  SELECT l_orderkey, count_if(ja + nein + enthalten = 1 AND ja = 1) AS n_ja, count_if(ja + nein + enthalten = 1 AND nein = 1) AS n_nein, count_if(ja + nein + enthalten = 1 AND enthalten = 1) AS n_enthalten, count_if(ja + nein + enthalten <> 1) AS n_invalid_row FROM t GROUP BY 1""")
def ballot_counts(spark, sf_dir):
    """SRC-17, AGG-12, VAL-16: one-hot ballot rows counted by choice, rows without exactly one mark apart."""
    li = load(spark, sf_dir, "lineitem")
    rows = li.select("l_orderkey", (F.col("l_returnflag") == "R").cast("int").alias("ja"), (F.col("l_returnflag") == "A").cast("int").alias("nein"), ((F.col("l_returnflag") == "N") | (F.col("l_quantity") > 45)).cast("int").alias("enthalten"))
    return V.ballots(rows, ["ja", "nein", "enthalten"], "l_orderkey")


@query("""SELECT 'nation' AS dataset, count(*) AS total, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}', ',' ORDER BY n_nationkey) || ']' AS items FROM nation""")
def api_envelope(spark, sf_dir):
    """SNK-03: a collection as one document."""
    return B.envelope(load(spark, sf_dir, "nation"), "nation", "n_nationkey", "n_name")


@query("""WITH h AS (SELECT 'benchmark' AS dataset, sha256(coalesce(item_id::VARCHAR, chr(0)) || chr(31) || coalesce(text, chr(0))) AS h FROM benchmark UNION ALL SELECT 'labels', sha256(doc_id || chr(31) || quality || chr(31) || toxic) FROM labels),
  b AS (SELECT dataset, substr(h, 1, 2) AS b, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS d FROM h GROUP BY 1, 2) SELECT dataset, CAST(sum(n) AS BIGINT) AS total, sha256(string_agg(b || d, '' ORDER BY b || d)) AS digest FROM b GROUP BY 1""")
def snapshot_digest(spark, sf_dir):
    """SNK-05, SNK-10, VAL-21: counts and digests of tables, whatever the order of their rows."""
    return B.snapshot_digest({n: load(spark, sf_dir, n) for n in ("benchmark", "labels")})


@query("""SELECT 'R' || r_regionkey AS node_id, 0 AS depth, r_name AS path FROM region UNION ALL SELECT 'N' || n_nationkey, 1, r_name || ' > ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'C' || c_custkey, 2, r_name || ' > ' || n_name || ' > ' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def tree_paths(spark, sf_dir):
    """TXT-17, TXT-18: depth and path of every node of a forest, by a recursive query."""
    r, n, c = (load(spark, sf_dir, x) for x in ("region", "nation", "customer"))
    node = lambda df, p, key, q, parent, title: df.select(F.concat(F.lit(p), key).alias("node_id"), (F.concat(F.lit(q), parent) if parent else F.lit(None).cast("string")).alias("parent_id"), F.col(title).alias("title"))
    return B.tree_paths(spark, node(r, "R", "r_regionkey", "", None, "r_name").unionByName(node(n, "N", "n_nationkey", "R", "n_regionkey", "n_name")).unionByName(node(c, "C", "c_custkey", "N", "c_nationkey", "c_name")))


@query("""SELECT o_orderkey, o_orderpriority, CAST(floor((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) - 1) / 16) AS BIGINT) AS batch FROM orders""")
def ordered_batches(spark, sf_dir):
    """TXT-25, ORD-01, ORD-04: batches of sixteen, newest first, within each priority."""
    o = load(spark, sf_dir, "orders")
    nth = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_orderdate"), "o_orderkey"))
    return o.select("o_orderkey", "o_orderpriority", F.floor((nth - 1) / 16).alias("batch"))


@query("""WITH r AS (SELECT conv_id AS entity, count(*) FILTER (role = 'user') AS asked, count(*) FILTER (role = 'assistant') AS answered FROM conversations GROUP BY 1)
  SELECT CASE WHEN asked = 0 THEN 'unasked' WHEN answered = 0 THEN 'unanswered' ELSE 'repeated' END AS rule, CAST(entity AS VARCHAR) AS entity_id FROM r WHERE (asked = 0 AND answered > 0) OR (asked > 0 AND answered <> 1)""")
def answers_exactly_once(spark, sf_dir):
    """VAL-17, SET-04: conversations that were asked and not answered exactly once."""
    c = load(spark, sf_dir, "conversations")
    return B.exact_ids(c.where("role = 'user'").select("conv_id"), c.where("role = 'assistant'").select("conv_id"), "conv_id")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%-d.%-m.%Y') AS day, CASE WHEN o_totalprice > 400000 THEN '—' WHEN o_totalprice / 10000 < 0.1 AND o_totalprice > 0 THEN '<0,1 %' ELSE replace(printf('%.1f', o_totalprice / 10000), '.', ',') || ' %' END AS share FROM orders""")
def formatted(spark, sf_dir):
    """TXT-22: dates and percentages as text."""
    share = F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice") / 10000)
    return load(spark, sf_dir, "orders").select("o_orderkey", T.format_date(F.col("o_orderdate")).alias("day"), T.format_percentage(share).alias("share"))


@query()
def greedy_chunks(spark, sf_dir):
    """TXT-24, TXT-28: lines of documents packed in order."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return C.greedy_chunks(lines.select("doc_id", F.col("pos").cast("long").alias("pos"), F.length("line").cast("long").alias("chars")), max_chars=2000, max_leaves=8)


@query()
def stemmed_bm25(spark, sf_dir):
    """TXT-02 with stems: the six best documents of each passage."""
    from ..functions.python_text import stems

    ranked = R.rank(load(spark, sf_dir, "benchmark"), "item_id", load(spark, sf_dir, "documents"), "doc_id", terms=lambda c: stems(T.terms(c)))
    return R.top(ranked, 6, "query_id")


@query()
def legal_context_budget(spark, sf_dir):
    """WIN-10, WIN-11: lines of each document within a budget, longest lines first, with neighbours."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ordinal", "line")).withColumn("length", F.length("line"))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("length"), "ordinal"))
    return R.budget_context(lines.select("doc_id", "ordinal", "length"), lines.select("doc_id", "ordinal", order.alias("position")), budget=2000, reach=1)
