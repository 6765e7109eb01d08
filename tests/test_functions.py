"""Truth tables of text and domain functions."""

import pytest
from pyspark.sql import functions as F

from evidentia.functions import domain as D
from evidentia.functions import python_text as P
from evidentia.functions import text as T
from evidentia.functions.german import stem


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize(
    "word, want",
    [("aufeinander", "aufeinand"), ("kategorischen", "kategor"), ("mindestlohns", "mindestlohn"), ("häuser", "haus"), ("wohnungen", "wohnung"), ("freiheitlich", "freiheit"), ("steuern", "steu"), ("gesetz", "gesetz"), ("bauer", "bau"), ("ergebnisse", "ergebnis"), ("straße", "strass")],
)
def test_stem(word, want):
    assert stem(word) == want


def test_text(spark):
    assert one(spark, T.terms(F.lit("Der Mindestlohn ist für die Straße 12a"))) == ["mindestlohn", "strasse", "12a"]
    assert one(spark, T.terms(F.lit(None).cast("string"))) == []
    assert one(spark, T.stable_id("p", F.lit("  A  B\n"))) == one(spark, T.stable_id("p", F.lit("a b"))) == P.stable_id("p", "A b")
    assert one(spark, T.document_numbers(F.lit("20/ 123, 20/123 und 19/7"))) == ["19/7", "20/123"]
    assert one(spark, T.group_key(F.lit("Bündnis 90/Die Grünen"))) == "gruene" and one(spark, T.group_key(F.lit("Fraktionslos"))) == "independent"
    assert one(spark, T.name_key(F.lit("Prof. Dr. Ann-Lee Groß (Ort)"))) == "annleegross"
    assert one(spark, T.clean_markdown(F.lit("![a](b.png)\n\n\n\nx­\ny\x07 "))) == "a\n\nxy"
    assert one(spark, T.native_recall(F.lit("eins zwei drei"), F.lit("x"))) is None
    assert one(spark, T.without_comments(F.lit("abcdef"), F.array(F.struct(F.lit(1).alias("start"), F.lit(3).alias("end"))))) == "a  def"
    assert [w.offset for w in one(spark, T.text_windows(F.lit("x" * 12001)))] == [0, 6000, 12000] and one(spark, T.text_windows(F.lit(""))) == []
    assert one(spark, T.feed_date(F.lit("Wed, 5 Mar 2025 10:00:00 +0100"))).isoformat() == "2025-03-05" and one(spark, T.feed_date(F.lit("x"))) is None
    assert one(spark, T.citation(F.lit("eli/bgbl-1-2025-107a"))).number == "107a"
    assert one(spark, T.format_percentage(F.lit(0.05))) == "<0,1 %" and one(spark, T.format_percentage(F.lit(None).cast("double"))) == "—"
    assert one(spark, T.repeats_hyphenated(F.lit("Bundes-\nBundestag"))) and not one(spark, T.repeats_hyphenated(F.lit("Bundes-\ntag")))
    hosts = ["www.bundestag.de"]
    for url, want in {"https://www.bundestag.de/x": True, "http://www.bundestag.de/x": False, "https://a@www.bundestag.de/": False, "https://www.bundestag.de/?apikey=1": False, "https://evil.de/": False, None: False}.items():
        assert one(spark, T.is_official_url(F.lit(url), hosts)) is want
    assert one(spark, T.is_safe_path(F.lit("data/live/../x.md"), "data/live")) is False and one(spark, T.is_safe_path(F.lit("data/live/x.md"), "data/live"))
    tables = F.array(F.struct(F.lit("t1").alias("id"), F.lit("|a|").alias("content")))
    assert one(spark, T.expand_tables(F.lit("x [t1](t1) y"), tables)) == "x \n\n|a|\n\n y" and one(spark, T.tables_placed(F.lit("none"), tables)) is False


@pytest.mark.parametrize(
    "quote, source, status",
    [("a long enough", "here: a long enough quote", "exact"), ("a long enough", "here: a long\n enough quote", "restored"), ("a long enough", "a long\nenough a long\n enough", "ambiguous"), ("a long enough", "nothing", "absent"), ("short", "short", "short")],
)
def test_anchor(spark, quote, source, status):
    assert one(spark, T.quote_status(F.lit(quote), F.lit(source))) == status
    found = P.anchor(quote, source)
    assert (found is not None) == (status in ("exact", "restored"))
    assert found is None or found in source
    assert one(spark, P.anchored(F.lit(quote), F.lit(source))) == found


def test_python_text(spark):
    assert P.search_text("Straße  Über­all") == "strasse uberall"
    assert P.squeezed("ﬁx-Y z") == "fixyz"
    assert one(spark, P.search_key(F.lit("Ä"))) == "a" and one(spark, P.search_key(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "yes, no, abstain, documented, position, outcomes",
    [(5, 0, 0, None, "yes", ["tension", "contextual", "consistent"]), (0, 4, 0, None, "no", ["consistent", "contextual", "tension"]), (1, 1, 0, None, "mixed", ["mixed", "contextual", "mixed"]),
     (0, 0, 0, "yes", "unknown", ["neutral"] * 3), (None, None, None, None, "unknown", ["unknown"] * 3), (None, None, None, "abstain", "abstain", ["neutral"] * 3)],
)
def test_positions(spark, yes, no, abstain, documented, position, outcomes):
    n = [F.lit(x).cast("int") for x in (yes, no, abstain)]
    assert one(spark, D.group_position(*n, F.lit(documented).cast("string"))) == position
    for score, want in zip((-1, 0, 2), outcomes):
        assert one(spark, D.comparison_outcome(F.lit(position), F.lit(score), F.lit(yes is not None))) == want


def test_decisions(spark):
    stage = lambda a, b="": one(spark, D.decision_stage(F.lit(a), F.lit(b)))
    assert [stage("Annahme", "3. Beratung"), stage("Ablehnung", "2. Beratung"), stage("Annahme"), stage("Annahme der Entschließung"), stage("Annahme des Änderungsantrags"), stage("Überweisung")] == ["final_passage", "second_reading", "unknown", "resolution", "amendment", "procedural"]
    scope = lambda a, b=None: one(spark, D.decision_scope(F.lit(a), F.lit(b).cast("string")))
    assert [scope("Annahme"), scope("Annahme", "Artikel 3"), scope("übrige Teile")] == ["whole_law", "partial_law", "partial_law"]
    assert [one(spark, D.prompt_position(F.lit(x))) for x in ("Wer enthält sich?", "Gegenprobe!", "Wer stimmt dafür?", "Bitte")] == ["abstain", "no", "yes", None]
    assert one(spark, D.page_links(F.lit(1), F.lit(3))) == [1, 2, 3] and one(spark, D.page_links(F.lit(9), F.lit(20))) == [1, -1, 8, 9, 10, -1, 20]
    assert one(spark, D.page_links(F.lit(19), F.lit(20))) == [1, -1, 16, 17, 18, 19, 20] and one(spark, D.page_links(F.lit(2), F.lit(20))) == [1, 2, 3, 4, 5, -1, 20]
    assert one(spark, D.accepted(F.lit("rejected"), F.lit("accepted"))) is False and one(spark, D.accepted(F.lit(None).cast("string"), F.lit("accepted"))) is True
    assert one(spark, D.score_agrees(F.lit("unassessed"), F.lit(None).cast("int"))) and not one(spark, D.score_agrees(F.lit("mixed"), F.lit(None).cast("int")))
