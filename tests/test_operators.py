"""Truth tables of relational operators, with unknown values, ties and empty tables."""

import pytest
from pyspark.sql import functions as F

from evidentia.operators import chunks, cliques, evidence, ledger, retrieval, tables, votes


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rank_rules(spark):
    docs = spark.createDataFrame([("a", "mindestlohn mindestlohn klima"), ("b", "klima"), ("c", ""), ("d", None)], "id string, text string")
    asked = spark.createDataFrame([("q", "klima klima unbekannt"), ("p", "mindestlohn"), ("n", None)], "q string, text string")
    got = retrieval.top(retrieval.rank(asked, "q", docs, "id"), 1, "query_id")
    assert [(r.query_id, r.id) for r in got.orderBy("query_id").collect()] == [("p", "a"), ("q", "b")]
    assert retrieval.rank(asked, "q", docs.limit(0), "id").count() == 0


def test_complete_link(spark):
    """Groups are cliques: 1-2 and 2-3 do not bring 1 and 3 together."""
    items = spark.createDataFrame([(0, i) for i in range(1, 7)], "program int, id long")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (4, 6), (5, 6)], "left_id long, right_id long")
    assert rows(cliques.complete_link_groups(items, pairs, "id", "program").drop("component_size")) == [(0, 1, 1), (0, 2, 1), (0, 3, 3), (0, 4, 4), (0, 5, 4), (0, 6, 4)]


def test_equal_pairs_respect_numbers(spark):
    items = spark.createDataFrame([(1, "mindestlohn auf 15 euro erhöhen", "x"), (2, "den mindestlohn auf 15 euro erhöhen", "x"), (3, "mindestlohn auf 14 euro erhöhen", "x"), (4, "mindestlohn auf 15 euro erhöhen", "y")], "id long, text string, program string")
    pairs = retrieval.equal_pairs(items, "id", F.col("text"), ["program"], retrieval.rank(items, "id", items, "id"))
    assert [r[:2] for r in rows(pairs)] == [(1, 2)]


def test_budget(spark):
    passages = spark.createDataFrame([(1, i, 10) for i in range(6)] + [(2, 0, 5)], "doc_id long, ordinal int, length int")
    ranked = spark.createDataFrame([(1, 4, 1), (1, 0, 2)], "doc_id long, ordinal int, position int")
    assert rows(retrieval.budget_context(passages, ranked, budget=40, reach=1)) == [(1, 0), (1, 3), (1, 4), (1, 5), (2, 0)]


def test_outcomes_and_metrics(spark):
    criteria = spark.createDataFrame([(1, 1, "draft", "fulfilled", "agent", 2), (2, 1, "draft", "partial", "agent", 1), (3, 1, "reviewed", "mixed", "editorial", 0), (4, 1, "draft", "contradicted", "editorial", -2), (5, 1, "rejected", "fulfilled", "agent", 2), (6, 2, "draft", "fulfilled", "agent", 2)], "criterion_id long, program_id int, review string, status string, method string, assessed_score int")
    programs = spark.createDataFrame([(1, "reviewed"), (2, "rejected")], "program_id int, review string")
    impacts = spark.createDataFrame([(10, 1, "draft", "accepted"), (11, 2, "draft", "rejected"), (12, 3, "reviewed", None)], "impact_id long, criterion_id long, review string, evaluation string")
    links = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "criterion_id long, impact_id long")
    out = evidence.outcomes(criteria, programs, impacts, links)
    assert [(r.criterion_id, r.status, r.automatic, r.covered, r.score) for r in out.orderBy("criterion_id").collect()] == [(1, "fulfilled", True, True, 2), (2, "unassessed", False, False, None), (3, "mixed", False, True, None), (4, "unassessed", False, False, None)]
    m = evidence.metrics(out, "program_id").first()
    assert (m.total, m.reviewed, m.fulfilled, m.mixed, m.unknown, m.covered, m.automated, m.alignment, m.coverage, m.fulfilment) == (4, 1, 1, 1, 2, 2, 1, 2.0, 50, 25)
    none = evidence.metrics(out.limit(0)).first()
    assert none.total == 0 and none.coverage is None and none.alignment is None
    assert spark.range(1).select(evidence.half_up(F.lit(-0.125), 2)).first()[0] == -0.12
    tags = spark.createDataFrame([(1, "a"), (1, "a"), (3, "b")], "criterion_id long, tag string")
    assert [(r.tag, r.total, r["rank"]) for r in evidence.topic_progress(out, tags).orderBy("rank").collect()] == [("a", 1, 1), ("b", 1, 2)]


def test_effects(spark):
    d = F.to_date
    data = [(1, 1, 1, 10, "2025-02-01", 2), (2, 1, 1, 11, "2025-02-01", -1), (3, 1, 2, 11, "2025-02-01", 1), (4, 1, 2, 12, "2025-03-01", 0)]
    df = spark.createDataFrame(data, "impact_id long, party_id int, criterion_id long, law_id long, day string, score int").withColumn("day", d("day")).withColumn("period_start", d(F.lit("2025-01-01")))
    e = {r.law_id: r for r in evidence.law_effects(df).collect()}
    assert [(e[k].affected, e[k].direction, e[k].newly_covered, e[k].shared) for k in (10, 11, 12)] == [(1, "supporting", 0, 1), (2, "mixed", 1, 1), (1, "mixed", 0, 0)]
    t = evidence.timeline(df).orderBy("day").collect()
    assert [(str(r.day), r.baseline, r.covered, r.opposed, r.impacts) for r in t] == [("2024-12-31", True, 0, 0, 0), ("2025-02-01", False, 2, 1, 3), ("2025-03-01", False, 2, 1, 4)]
    assert evidence.timeline(df.limit(0)).count() == 0


def test_vote_rules(spark):
    g = spark.createDataFrame([(1, 5, 1, 0, 0), (1, 2, 0, 1, 0), (2, 1, None, 0, 0), (2, 1, 1, 1, 1)], "vote_id long, yes int, no int, abstain int, absent int")
    assert rows(votes.totals(g, "vote_id")) == [(1, 7, 1, 1, 0, 9, 9), (2, None, None, None, None, None, None)]
    v = spark.createDataFrame([(1, 1, True), (2, 1, False), (3, 2, False)], "vote_id long, law_id long, is_final boolean")
    assert [r.vote_id for r in votes.finals_else_all(v).orderBy("vote_id").collect()] == [1, 3]
    m = lambda *r: spark.createDataFrame([(1, *x) for x in r], "poll int, group_key string, name_key string, vote string")
    check = lambda a, b: votes.compare_members(a, b, "poll").first().status
    two = m(("g", "a", "yes"), ("g", "b", "no"))
    assert check(two, two) == "matched" and check(two, m(("g", "a", "yes"), ("g", "b", "yes"))) == "mismatch" and check(two, m(("g", "a", "yes"), ("g", "c", "no"))) == "partial"
    assert check(two, m(("g", "a", "yes"))) == "unmatched" and check(m(("g", "a", "yes"), ("g", "a", "no")), two) == "unmatched"
    b = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 0, 1), (1, None, None)], "v int, ja int, nein int")
    assert rows(votes.ballots(b, ["ja", "nein"], "v")) == [(1, 1, 1, 2)]


def test_merges(spark):
    old = spark.createDataFrame([(1, 5, 5), (2, 6, 5), (3, 7, 7), (4, 8, 8)], "id long, v int, generated int")
    new = spark.createDataFrame([(1, 9), (2, 9), (3, 7), (5, 1)], "id long, v int")
    assert rows(tables.merge_upsert(old, new, "id", "v")) == [(1, 9, "written"), (2, 6, "preserved"), (3, 7, "unchanged"), (4, 8, "kept"), (5, 1, "inserted")]
    assert rows(tables.insert_only(new, old.select("id", "v"), "id")) == [(1, 9), (2, 9), (3, 7), (4, 8), (5, 1)]
    with pytest.raises(ValueError):
        tables.assert_valid(tables.duplicates(spark.createDataFrame([(1,), (1,)], "id int"), "unique", "id"))
    page = tables.paginate(spark.range(45), 9, 20, "id").collect()
    assert [r.id for r in page] == [40, 41, 42, 43, 44] and page[0].page == 3 and tables.paginate(spark.range(0), 1, 7, "id").count() == 0
    d = lambda n: tables.snapshot_digest({"x": spark.range(n).repartition(3)}).first().digest
    assert d(50) == d(50) != d(51)


def test_ledger(spark):
    e = spark.createDataFrame([("a", "reserve", "1.0"), ("a", "settle", "0.4"), ("a", "settle", "0.4"), ("b", "reserve", "2.0"), ("c", "reserve", "3.0"), ("c", "unknown", "0")], "request_id string, kind string, amount string")
    r = ledger.cost_ledger(e.withColumn("account", F.lit(1)), "account").first()
    assert tuple(map(float, (r.reported, r.pending, r.unknown, r.exposure))) == (0.4, 2.0, 3.0, 5.4) and not r.complete
    a = spark.createDataFrame([("t", 0, "failed"), ("t", 10, "failed"), ("u", 0, "done"), ("f", 0, "fatal")], "task string, at long, outcome string")
    at = lambda now: {x.task: x.available for x in ledger.task_state(a, now).collect()}
    assert at(249) == {"t": False, "u": False, "f": False} and at(250)["t"]
    g = spark.createDataFrame([("g1", "t", 2), ("g1", "t", 2), ("g2", "t", 1)], "grant_id string, task string, attempts int")
    assert rows(ledger.granted_limits(g, 3)) == [("t", 6)]


def test_chunks(spark):
    lines = spark.createDataFrame([(1, i, 400) for i in range(5)] + [(2, 0, 5000)], "doc_id long, pos long, chars long")
    assert rows(chunks.greedy_chunks(lines, max_chars=1000, max_leaves=9)) == [(1, 0, 0, 1, 800), (1, 1, 2, 3, 800), (1, 2, 4, 4, 400), (2, 0, 0, 0, 5000)]
    assert chunks.split_block("x" * 5000) == ["x" * 4500, "x" * 500] and chunks.split_block(("y" * 4000 + " ") * 2) == ["y" * 4000, "y" * 4000] and chunks.split_block(" ") == []
    pages = spark.createDataFrame([(1, 1, "Text\n\nTEXT\n\nother\nline"), (1, 2, None)], "doc_id long, page int, text string")
    got = chunks.page_leaves(pages, "d").orderBy("ordinal").collect()
    assert [(r.text, r.line_start, r.line_end) for r in got] == [("Text", 1, 1), ("TEXT", 3, 3), ("other\nline", 5, 6)] and len({r.leaf_id for r in got}) == 3


def test_decisions_on_orders_with_long_keys(spark, tmp_path):
    """A document's number has six digits at most, also where an order's key has more."""
    import duckdb

    from evidentia.plans import QUERIES, SQL

    spark.range(8_999_980, 9_000_040).selectExpr("id as o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.sql(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    want = con.sql(f"SELECT block_id, start, stop, quote FROM ({SQL['protocol_decisions']})").fetchall()
    got = QUERIES["protocol_decisions"](spark, str(tmp_path)).select("block_id", "start", "stop", "quote")
    assert rows(got) == sorted(map(tuple, want), key=repr) and want


def test_unique_matches_of_a_hot_key(spark):
    """Rows that share a key on both sides are counted, not paired: 80,000 of each would be 6.4 billion pairs."""
    import time

    hot = spark.range(80_000).selectExpr("id", "1 as k")
    left = hot.unionByName(spark.createDataFrame([(-1, 2), (-2, None), (-3, 3)], "id long, k int"))
    right = hot.unionByName(spark.createDataFrame([(-7, 2), (-8, None)], "id long, k int"))
    began = time.monotonic()
    got = votes.unique_matches(left, right, ["k"], "id")
    assert rows(got.where("id < 0")) == [(-1, -7, "matched"), (-2, None, "missing"), (-3, None, "missing")]
    assert rows(got.where("id >= 0").groupBy("status", "other_id").count()) == [("ambiguous", None, 80_000)]
    assert time.monotonic() - began < 60


def test_law_effects_expand_no_rows(spark):
    """Effects are counted from one row a criterion and law, not from a copy of each row for each distinct count."""
    day = "date'2020-01-0"
    given = spark.sql(f"select * from values (1, 1, 7, {day}1', 1), (1, 1, 7, {day}1', -1), (1, 1, 8, {day}1', 0), (1, 2, 8, {day}2', 2), (1, 2, 9, {day}3', cast(null as int)) as t(party_id, criterion_id, law_id, day, score)")
    got = evidence.law_effects(given)
    shown = got.select("law_id", "affected", "supporting", "opposing", "neutral", "newly_covered", "shared")
    assert rows(shown) == [(7, 1, 1, 1, 0, 0, 1), (8, 1, 0, 0, 1, 0, 1), (8, 1, 1, 0, 0, 1, 0), (9, 1, 0, 0, 0, 0, 0)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_equal_quotes_are_read_once(spark):
    """Quotes of equal texts share one reading; a comment's place makes another text."""
    from evidentia.sources import transcripts

    said = "Ich bitte diejenigen, die dem zustimmen, um das Handzeichen. – SPD. Gegenprobe! – AfD. Damit ist der Gesetzentwurf angenommen."
    quotes = spark.range(50).selectExpr("id as quote_id", f"'{said}' as text", "cast(null as array<struct<start:int,end:int>>) as comments")
    quotes = quotes.unionByName(spark.sql("select 99L as quote_id, cast(null as string) as text, cast(null as array<struct<start:int,end:int>>) as comments"))
    got = transcripts.group_positions(quotes)
    assert rows(got) == sorted(((q, p, side) for q in range(50) for p, side in (("spd", "yes"), ("afd", "no"))), key=repr)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()  # readings are a table by then


def test_few_query_terms_are_broadcast(spark):
    """Postings, hot on some terms, are not shuffled by them to meet a few queries' terms."""
    docs = spark.range(500).selectExpr("id", "concat('klima haushalt wort', id % 7) as text")
    got = retrieval.rank(spark.createDataFrame([("q", "klima wort3")], "q string, text string"), "q", docs, "id")
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 500
    plan = retrieval.telling_terms(docs.selectExpr("id", "text as term").limit(3), 3)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" in plan or "UnresolvedHint" in plan or "broadcast" in plan.lower()


def test_budget_holds_one_document_in_python(spark):
    """What Python holds doesn't grow with a batch's documents; unranked, sparse and null rankings are read as before."""
    import tracemalloc

    import pyarrow as pa

    from evidentia.functions import arrow

    n, lines = 3_000, 40
    parts = pa.array([[{"ordinal": o, "length": 100 + o} for o in range(lines)]] * n)
    order = pa.array([[{"position": p, "ordinal": lines - p} for p in range(1, lines + 1)]] * n)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), parts, order], ["doc_id", "parts", "order"])
    sizes = []
    tracemalloc.start()
    for out in arrow.packed(retrieval.chosen([batch], 2_000, 1), ["doc_id", "ordinal"], [pa.int64(), pa.int32()]):
        sizes.append(out.num_rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 << 20 and sum(sizes) == n * 15 and max(sizes) <= arrow.OUT_ROWS
    passages = spark.createDataFrame([(1, i, 10) for i in (0, 2, 3, 7)] + [(2, 0, 50), (2, 1, 5), (3, 0, 4)], "doc_id long, ordinal int, length int")
    ranked = spark.createDataFrame([(1, 1, 1), (1, 7, 2), (1, 3, 3), (9, 0, 1)], "doc_id long, ordinal int, position int")
    got = retrieval.budget_context(passages, ranked, budget=30, reach=1)
    assert rows(got) == [(1, 0), (1, 2), (1, 7), (3, 0)]
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()


def test_orders_texts_name_whole_keys(spark):
    """Orders whose keys agree in their last six digits have texts, and document numbers, of their own."""
    from evidentia.functions import text as T
    from evidentia.plans.protocol_queries import BLOCK

    keys = [7, 1_000_007, 2_000_007, 54_000_007, 216_000_007]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", F.expr(BLOCK).alias("text")).select("k", "text", T.document_numbers(F.col("text")).alias("refs")).collect()
    assert len({r.text for r in got}) == len(keys)
    assert {r.k: r.refs for r in got} == {7: ["20/7"], **{k: ["20/7", f"21/{k // 1_000_000}"] for k in keys[1:]}}


def test_rank_writes_common_terms_only(spark, monkeypatch):
    """Many queries' terms are written only if one of the few documents has them, and scored pairs are not shuffled."""
    from evidentia.operators import retrieval

    kept, stored = {}, retrieval.stored
    monkeypatch.setattr(retrieval, "stored", lambda df, label: kept.setdefault(label, stored(df, label)))
    queries = spark.createDataFrame([(n, f"apples other{n} words{n}") for n in range(9)], "q long, text string")
    docs = spark.createDataFrame([(1, "apples pears"), (2, "pears plums")], "d long, text string")
    got = retrieval.rank(queries, "q", docs, "d")
    assert "hashpartitioning(query_id" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.query_id, r.id) for r in got.collect()) == [(n, 1) for n in range(9)]
    assert {r.term for r in kept["asked"].collect()} == {"apples"}
