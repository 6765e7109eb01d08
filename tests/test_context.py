"""Context within a budget, islands, anchors and recovered outlines, against plain sequential rules."""

import datetime
import random
import re

from pyspark.sql import functions as F

from evidentia.operators import context as X


def test_legal_context_by_brute_force(spark):
    r = random.Random(3)
    passages, ranked = {}, {}
    for law in range(8):
        n = [0, 1, 3, 12, 40, 90, 90, 90][law]
        passages[law] = [r.choice([None, "", "x" * r.randrange(1, 400), "x" * 23_700, "y" * 30_000, "Inkrafttreten", "tritt am Tag danach in Kraft", "tritt\nin Kraft"]) if r.random() < 0.4 else "z" * r.randrange(1, 900) for _ in range(n)]
        for c in range(law % 4):
            ranked[law, c] = r.sample(range(n), r.randrange(0, n + 1)) if n else []
    frame = spark.createDataFrame([(law, i, t, 5) for law, all_ in passages.items() for i, t in enumerate(all_)], "law_id long, ordinal long, text string, size int")
    order = spark.createDataFrame([(law, c, p, o, "e") for (law, c), all_ in ranked.items() for p, o in enumerate(all_)], "law_id long, criterion_id long, position long, ordinal long, entries string")
    want = []
    for law, texts in passages.items():
        size, taken = 0, {}
        rankings = [v for (k, _), v in sorted(ranked.items()) if k == law]
        for p in range(max(map(len, rankings), default=0)):
            for ranking in rankings:
                for i in range(max(0, ranking[p] - 2), min(len(texts), ranking[p] + 3)) if p < len(ranking) else ():
                    if i not in taken and size + len(texts[i] or "") <= 24_000:
                        taken[i] = True
                        size += len(texts[i] or "")
            if size >= 23_500:
                break
        for i, t in enumerate(texts):
            if i not in taken and size + len(t or "") <= 24_000 and re.search("Inkrafttreten|In-Kraft-Treten|tritt.*Kraft|Geltungsbereich", t or "", re.I):
                taken[i] = False
                size += len(t or "")
        want += [(law, i, taken[i], len(taken) < len(texts)) for i in sorted(taken)]
    got = sorted(map(tuple, X.legal_context(frame, order).collect()))
    assert got == want
    assert {x[2] for x in want} == {x[3] for x in want} == {True, False}
    assert X.legal_context(frame.limit(0), order).collect() == []


def blocks_of(rows):
    """(doc_id, group, pos, page, line_start, line_end, from_char, to_char) of lines (page, text, lines covered)."""
    out, at = [], 0
    for k, (page, length, more) in enumerate(rows):
        out.append((1, 0, k, page, k, k + more, at, at + length))
        at += length + 1
    return out


def test_islands(spark):
    rows = blocks_of([(1, 4_000, 0), (1, 498, 0), (1, 1, 0), (1, 4_499, 0), (2, 5_000, 0), (2, 10, 1), (2, 10, 0), (2, 10, 0), (None, 3, 0), (3, 3, 0)])
    blocks = spark.createDataFrame(rows, "doc_id long, group long, pos long, page long, line_start long, line_end long, from_char long, to_char long")
    got = {r.pos: r.island for r in X.islands(blocks).collect()}
    # 4,000 + 1 + 498 fit; with a further line they don't. A block over the limit stands alone; an overlap begins an island.
    assert [got[k] for k in range(8)] == [0, 0, 1, 2, 3, 4, 5, 5]
    assert len(got) == len(rows)
    assert X.islands(blocks.limit(0)).collect() == []


def test_page_anchors(spark):
    paths = [["r", "a", "b"], ["r", "a", "b"], ["r", "a"], ["r", "a", "b"], None, ["r", "c", "b"], ["r"], ["r", "a", "b", "d"]]
    leaves = spark.createDataFrame([(7, k, k // 2, f"leaf{k}", p) for k, p in enumerate(paths)], "doc_id long, pos long, page long, leaf_id string, path array<string>")
    got = sorted((r.pos, r.anchor) for r in X.page_anchors(leaves).collect() if not r.anchor.startswith("leaf"))
    want, before, seen = [(0, "r")], [], {}
    for k, p in enumerate(paths):
        own = (p[1:] if len(p) > 1 else p) if p else []
        shared = 0
        while shared < min(len(own), len(before)) and own[shared] == before[shared]:
            shared += 1
        for s in own[shared:]:
            seen[s] = seen.get(s, 0) + 1
            want.append((k, s if seen[s] == 1 else f"{s}-continuation-{seen[s]}"))
        before = own
    assert got == sorted(want)
    assert X.page_anchors(leaves).where("anchor like 'leaf%'").count() == len(paths)


def test_recovered_outline(spark):
    rows = [(1, 0, k, k // 4, k, k, 10 * k, 10 * k + 9) for k in range(12)]
    blocks = spark.createDataFrame(rows, "doc_id long, group long, pos long, page long, line_start long, line_end long, from_char long, to_char long").drop("group")
    cached = spark.createDataFrame([(1, 0, 0, 1, "a"), (1, 0, 2, 3, "b"), (1, 1, 4, 5, "c"), (1, 1, 7, 7, "gap"), (1, 2, 8, 11, None), (2, 0, 0, 3, "other")], "doc_id long, page long, start long, stop long, section string")
    got = sorted((r.start, r.stop, r.section, r.recovered) for r in X.recovered_outline(blocks, cached).collect())
    assert got == [(0, 1, "a", False), (2, 3, "b", False), (4, 7, "page 1", True), (8, 11, "page 2", True)]


def test_more_rows_are_more_tasks(spark, monkeypatch, tmp_path):
    """Tables are dealt by rows: tasks don't grow with the input, and what is ordered by the key isn't shuffled again."""
    from evidentia import session
    from evidentia.plans import QUERIES

    monkeypatch.setattr(session, "TASK_ROWS", 100)
    dealt = session.spread(spark.range(1_000).selectExpr("id", "id % 300 as k"), "k")
    sizes = dealt.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 400
    orders = [(i, i % 90, "PO"[i % 2], "1-URGENT", datetime.datetime(1995, 1, 1 + i % 28)) for i in range(1_000)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    plan = QUERIES["page_anchors"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(o_custkey" in plan and ", 10), REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
