"""Constraint checks and products on small cases."""

import pytest
from pyspark.sql import functions as F

from evidentia.operators import checks as K
from evidentia.operators import products as P


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_tree_and_cliques(spark):
    leaves = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "program_id int, leaf_id string")
    tree = spark.createDataFrame([(1, "n", "a"), (1, "m", "a"), (1, "n", "b"), (1, "n", "x")], "program_id int, node_id string, leaf_id string")
    assert rows(K.tree_covers(tree, leaves)) == [("leaf not in tree", "c"), ("leaf twice in tree", "a"), ("no such leaf", "x")]
    groups = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (4, 4), (5, 5), (5, 6)], "group_id long, id long")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "left_id long, right_id long")
    assert rows(K.cliques(groups, pairs)) == [("group is a clique", "1")]


def test_judgments_and_catalogue(spark):
    schema = "key long, supported boolean, disposition string, score int, law_quote string, criterion_quote string"
    q = "long enough quote"
    data = [(1, True, "proposed_link", 1, q, q), (2, True, "no_supported_link", None, None, None), (3, True, "proposed_link", None, q, q), (4, False, "missing_context", 1, None, None), (5, True, "proposed_link", 0, q, "x")]
    assert rows(K.judgments(spark.createDataFrame(data, schema))) == [("a link has score and quotes", "3"), ("a link has score and quotes", "5"), ("no score without link", "4"), ("supported means linked", "2")]
    c = spark.createDataFrame([("a", "2020-01-01", "2021-01-01", "law", [1], 2), ("b", "2022-01-01", "2021-01-01", " ", [3, 3], 2), ("c", "2020-01-01", "2021-01-01", "law", None, 2)], "id string, published_at string, period_start string, permission string, textless array<int>, pages int")
    assert rows(K.catalogue(c)) == [("permission stated", "b"), ("published before period", "b"), ("textless pages in range", "b"), ("textless pages once", "b")]
    with pytest.raises(Exception, match="no publication basis: b"):
        P.publishable(c).collect()
    assert P.publishable(c.where("id = 'a'")).count() == 1
    w = spark.createDataFrame([(1, "2020-01-01", "2021-01-01", None), (2, "2020-01-01", "2021-01-01", "2021-01-01")], "program_id int, published_at string, period_start string, period_end string")
    assert rows(K.windows(w)) == [("window order", "2")]


def test_tiles(spark):
    r = spark.createDataFrame([(1, 0, 1), (1, 2, 2), (2, 0, 0), (2, 2, 2), (3, 0, 1), (3, 1, 2)], "doc_id int, start long, end long")
    sizes = spark.createDataFrame([(1, 3), (2, 3), (3, 3), (4, 1), (5, 0)], "doc_id int, size long")
    assert [x[1] for x in rows(K.tiles(r, sizes))] == ["2", "3", "4"]


def test_references(spark):
    assert one(spark, P.motion_references(F.lit("Zu 20/1 und 20/2. Der Ausschuss empfiehlt, 20/3 anzunehmen."))) == ["20/3"]
    assert one(spark, P.motion_references(F.lit("Drucksache 20/1"))) == ["20/1"]
    call = lambda motion, title="": one(spark, P.whole_law_roll_call(F.lit(motion), F.lit(title), F.array(F.lit("20/1"))))
    assert call("Gesetzentwurf 20/1") and not call("Gesetzentwurf 20/2") and not call("Gesetzentwurf 20/1", "Artikel 3") and not call("Antrag 20/1")
    assert not one(spark, P.whole_law_roll_call(F.lit("Gesetzentwurf"), F.lit(""), F.array().cast("array<string>")))


def test_polls(spark):
    intro = '<p>Der <a href="https://x.de">x</a> <a href="https://dserver.bundestag.de/btd/20/001/2000123.pdf">Gesetzentwurf</a></p>'
    schema = "poll_id int, date string, adopted boolean, legislature string, url string, intro string"
    ok = (1, "2025-01-01", True, "Bundestag 2021", "https://www.example.org/bundestag/20/abstimmungen/x", intro)
    late = intro.replace("</p>", "").replace("<a href=\"https://dserver", "</p><p><a href=\"https://dserver") + "</p>"
    other = intro.replace('<a href="https://x.de">x</a>', '<a href="https://dserver.bundestag.de/btd/20/001/2000124.pdf">Gesetzentwurf</a>')
    data = [(6, *ok[1:5], late), (7, *ok[1:5], other), (8, *ok[1:5], None), ok, (2, "2025-01-02", *ok[2:]), (3, "2025-01-01", False, *ok[3:]), (4, *ok[1:5], "<p>ohne</p>"), (5, *ok[1:4], "https://evil.org/bundestag/20/abstimmungen/x", intro)]
    found = P.poll_matches(spark.createDataFrame(data, schema), F.lit("20"), F.lit("2025-01-01"), F.array(F.lit("20/123")), F.lit(True), "www.example.org")
    assert [r.poll_id for r in found.collect()] == [1]


def test_texts(spark):
    p = spark.createDataFrame([(1, 1, "md", "n"), (1, 2, " ", "native"), (1, 3, None, None)], "doc_id int, page int, markdown string, native string")
    may = spark.createDataFrame([(1, 3)], "doc_id int, page int")
    assert [r.text for r in P.page_texts(p, may).orderBy("page").collect()] == ["md", "native", ""]
    with pytest.raises(Exception, match="unexpected empty page 3"):
        P.page_texts(p, may.limit(0)).collect()
    pos = spark.createDataFrame([(1, 20, 1), (2, 20, 2), (3, 20, 3)], "position_id int, term int, sitting int")
    got = P.preferred_transcript(pos, spark.createDataFrame([(20, 1, "o")], "term int, sitting int, url string"), spark.createDataFrame([(1, "l"), (2, "l")], "position_id int, url string"))
    assert rows(got) == [(1, "o", None), (2, "l", "not in the open-data index"), (3, None, "no structured transcript")]
    a = spark.createDataFrame([(1, "der Lohn steigt"), (1, "nie")], "case_id int, text string")
    c = spark.createDataFrame([(1, "x", "Lohn"), (1, "y", "Miete"), (2, "z", "a")], "case_id int, name string, pattern string")
    assert rows(P.concept_checks(a, c)) == [(1, 1, 2), (2, 0, 1)]


def test_totals(spark):
    pairs = spark.createDataFrame([(True, "proposed_link"), (False, "missing_context"), (False, "no_supported_link")], "linked boolean, disposition string")
    groups = spark.createDataFrame([(1, 1), (1, 2), (3, 3)], "group_id int, id int")
    assert rows(P.experiment_totals(pairs, groups)) == [(3, 1, 1, 1, 3, 2, 1)]
    d = P.decisions(spark.createDataFrame([(1, "reviewed"), (2, "proposed"), (3, "proposed")], "key int, review string"), spark.createDataFrame([(1, "rejected"), (2, "accepted"), (3, "rejected"), (4, "accepted"), (5, "missing_context")], "key int, outcome string"))
    assert rows(d) == [(1, "preserved_link", "unchanged", False), (2, "proposed_link", "renewed", True), (3, "no_supported_link", "superseded", True), (4, "proposed_link", "created", True), (5, "missing_context", None, True)]
    one_row = spark.range(1).selectExpr("1 fulfilled", "2 partial", "3 contradicted", "4 mixed", "5 unassessed").select(P.progress_label().alias("x")).first().x
    assert one_row.startswith("1 gesetzlich umgesetzt, 2 teilweise")


def test_impacts_are_joined_once(spark):
    """Both rules come of one pass over the joined impacts; null keys and open windows included."""
    import datetime

    day = datetime.date
    impacts = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 9, 1), (4, 1, 9), (5, None, 1), (6, 2, 2)], "impact_id long, criterion_id long, law_id long")
    criteria = spark.createDataFrame([(1, 1), (2, 2)], "criterion_id long, program_id long")
    laws = spark.createDataFrame([(1, day(2000, 1, 1)), (2, day(2001, 1, 1))], "law_id long, published_at date")
    programs = spark.createDataFrame([(1, day(2000, 1, 1), day(2001, 1, 1)), (2, day(2000, 1, 1), None)], "program_id long, period_start date, period_end date")
    found = K.impacts_in_window(impacts, criteria, laws, programs)
    assert sorted(map(tuple, found.collect())) == [("impact dangles", "3"), ("impact dangles", "4"), ("impact dangles", "5"), ("law in window", "2")]
    assert "Union" not in found._jdf.queryExecution().executedPlan().toString()


def test_line_items_are_dealt_by_rows(spark, monkeypatch):
    """The evidence model's groups of line items need no shuffle but that of some TASK_ROWS rows a partition."""
    from evidentia import session
    from evidentia.tables import model

    monkeypatch.setattr(session, "TASK_ROWS", 500)
    votes = model(spark, "/root/testdata/sf0.001", "impact")
    assert votes.rdd.getNumPartitions() > 10


def test_votes_are_dealt_by_rows(spark, monkeypatch):
    """Groups are dealt by their vote by rows, whatever number of partitions Spark's own shuffles have; the sums are the same."""
    from evidentia import session
    from evidentia.operators import votes
    from evidentia.plans import QUERIES
    from evidentia.tables import model

    want = votes.totals(model(spark, "/root/testdata/sf0.001", "vote_group"), "vote_id").collect()
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    got = QUERIES["vote_totals"](spark, "/root/testdata/sf0.001")
    assert sorted(map(str, got.collect())) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2 and "ENSURE_REQUIREMENTS" not in plan and got.rdd.getNumPartitions() > 10


def test_insights_are_dealt_by_rows(spark, monkeypatch):
    """Impacts are dealt by criterion and their sums by law, by rows; the results are those of Spark's own shuffles."""
    import re

    from evidentia import session
    from evidentia.operators import evidence as E
    from evidentia.plans import QUERIES
    from evidentia.tables import model

    data = "/root/testdata/sf0.001"
    given = E.insight_impacts(*[model(spark, data, n) for n in ("impact", "criterion", "law", "program")])
    want = {"law_effects": E.law_effects(given), "timeline_cumulative": E.timeline(given), "timeline_jumps": E.timeline_jumps(given)}
    want = {n: sorted(map(str, w.collect())) for n, w in want.items()}
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    for name, rows in want.items():
        assert sorted(map(str, QUERIES[name](spark, data).collect())) == rows
    plan = QUERIES["first_evidence_exclusive"](spark, data)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((.*?), (\d+)\), (\w+)", plan)
    ours = [re.sub(r"#\d+L?", "", keys) for keys, n, how in dealt if how == "REPARTITION_BY_NUM" and int(n) > 10]
    rest = [re.sub(r"#\d+L?", "", keys) for keys, n, how in dealt if how != "REPARTITION_BY_NUM"]
    assert ours == ["law_id", "criterion_id", "l_orderkey"] and rest == ["party_id"]
