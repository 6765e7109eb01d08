"""Readers, writers and incremental forms on small fixtures."""

import datetime
import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evidentia.functions import python_text
from evidentia.sources import cursor, download, feeds, records, transcripts, workbook
from evidentia.streaming import state


def rows(df):
    return [tuple(r) for r in df.collect()]


FEED = """<rss><channel xmlns:meta="urn:m">
<item><title>Gesetz  zur Sache</title><link>https://x.de/eli/bund/bgbl-1/2025/107</link><pubDate>Wed, 5 Mar 2025 10:00:00 +0100</pubDate><meta:typ>Gesetz</meta:typ><meta:fundstelle>BGBl. 2025 I Nr. 107</meta:fundstelle></item>
<item><title>Verordnung</title><link>https://x.de/eli/bund/bgbl-1/2025/108</link><pubDate>2025-03-06</pubDate><meta:typ>Verordnung</meta:typ></item></channel></rss>"""


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    got = feeds.read_feed(spark, str(tmp_path / "feed.xml")).collect()
    assert [(r.law_id, r.title, str(r.published_at), r.citation) for r in got] == [("bgbl-1-2025-107", "Gesetz zur Sache", "2025-03-05", "BGBl. 2025 I Nr. 107")]
    (tmp_path / "empty.xml").write_text("<rss></rss>")
    with pytest.raises(ValueError):
        feeds.read_feed(spark, str(tmp_path / "empty.xml"))
    bad = spark.createDataFrame([("t", "nowhere", "2025-01-01", "Gesetz", None)], "title string, link string, pubDate string, typ string, fundstelle string")
    with pytest.raises(Exception, match="unreadable feed item"):
        feeds.parse_items(bad).collect()
    entries = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-03"), ("c", "2025-01-02"), ("d", "2024-01-01")], "law_id string, published_at string")
    known = spark.createDataFrame([("d",)], "law_id string")
    assert sorted((r.law_id, r.status) for r in feeds.new_entries(entries, known, 2).collect()) == [("a", "deferred"), ("b", "imported"), ("c", "imported")]


def archive_page(rows, total, following="", section="searchresult"):
    found = "".join(f'<h3>BGBl. 2025 {"I" if part == 1 else "II"} Nr. <b>{number}</b> vom {day}</h3><p>x</p><a class="t" href="https://{host}/bgbl/{part}/2025/{number}/VO.html">Gesetz&nbsp;{number} &amp; mehr</a>' for part, number, day, host in rows)
    return f'<p>Suchergebnisse: {total}</p><a href="/bgbl/1/2025/9/VO.html">außerhalb</a><section class="a {section}">{found}</section>{following}'


def test_archive(spark):
    """Several headings and links in one section, both layouts of the next link, and what is refused."""
    own = "www.recht.bund.de"
    modern, plain = '<li class="x c-nav-index__item--next"><a href="?p=2">2</a></li>', '<a class="forward button" href="?p=2">weiter</a>'
    pages = [
        archive_page([(1, "100", "30.05.2025", own), (2, "10a", "01.06.2025", own)], "1.002", modern), archive_page([(2, "11", "02.06.2025", own)], "1.002", plain), archive_page([], 0),
        archive_page([(1, "5", "30.05.2025", own)], 2, plain + plain.replace("p=2", "p=3")), archive_page([(1, "5", "30.05.2025", "example.org")], 2), archive_page([(1, "5", "30.05.2025", own)], 2).replace("/2025/5/", "/2025/6/"), "<p>nichts</p>", None,
    ]
    got = feeds.archive_results(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"), [own])
    want = [
        (0, 1002, "?p=2", 0, "bgbl-1-2025-100", "Gesetz 100 & mehr", "https://www.recht.bund.de/eli/bund/bgbl-1/2025/100", "BGBl. 2025 I Nr. 100", datetime.date(2025, 5, 30), None),
        (0, 1002, "?p=2", 1, "bgbl-2-2025-10a", "Gesetz 10a & mehr", "https://www.recht.bund.de/eli/bund/bgbl-2/2025/10a", "BGBl. 2025 II Nr. 10a", datetime.date(2025, 6, 1), None),
        (1, 1002, "?p=2", 0, "bgbl-2-2025-11", "Gesetz 11 & mehr", "https://www.recht.bund.de/eli/bund/bgbl-2/2025/11", "BGBl. 2025 II Nr. 11", datetime.date(2025, 6, 2), None),
        (2, 0, None, None, None, None, None, None, None, None),
    ]
    each = sorted(rows(got), key=lambda r: (r[0], r[3] or 0))
    assert each[:4] == want
    assert [(r[0], r[-1]) for r in each[4:]] == [(3, "conflicting next links"), (4, "no official law or citation"), (5, "citation of another law"), (6, "no result count"), (7, "no result count")]
    sound = got.where("problem is null")
    assert {r[0] for r in rows(feeds.archive_problems(sound))} == {"total drifts", "total differs", "page loop"}
    one = sound.where("page_id = 0").withColumn("total", F.lit(2).cast("long"))
    assert rows(feeds.archive_problems(one)) == []
    again = one.unionByName(one.where("pos = 0"))
    assert {r[0] for r in rows(feeds.archive_problems(again))} == {"entry twice", "total differs"}


def test_mirrors_and_cache(spark):
    c = spark.createDataFrame([(1, 0, "u0", "x", "y"), (1, 1, "u1", "y", "y"), (1, 2, "u2", "y", "y"), (2, 0, "v", "x", "y")], "id long, pos int, url string, sha string, expected string")
    assert rows(feeds.first_sound(c)) == [(1, "u1", 1)]
    cache = spark.createDataFrame([("a", "x", None, 90), ("b", "x", "bad", 90), ("c", None, None, 90), ("d", None, None, 40)], "url_sha string, content string, sha string, retrieved_at long").withColumn("sha", F.when(F.col("url_sha") == "a", F.sha2("content", 256)).otherwise(F.col("sha")))
    assert sorted(r.url_sha for r in feeds.fresh_cache(cache, 100, 60, 30).collect()) == ["a", "c"]


PROTOCOL = """<dbtplenarprotokoll><sitzungsverlauf><tagesordnungspunkt top-id="T1"><p>Wir kommen zur <a>Abstimmung</a>.</p><kommentar>(Beifall)</kommentar>
<rede><p>Rede</p></rede><p klasse="redner">N</p><p>Danke<sup>1</sup>.</p></tagesordnungspunkt></sitzungsverlauf></dbtplenarprotokoll>"""


def test_transcripts(spark):
    df = spark.createDataFrame([(1, PROTOCOL), (2, "<x/>"), (3, "<")], "sitting_id long, xml string")
    got = sorted(transcripts.chair_blocks(df).collect(), key=lambda r: (r.sitting_id, r.block or 0))
    assert [(r.text, [tuple(c) for c in r.comments]) for r in got if r.problem is None] == [("Wir kommen zur Abstimmung.\n(Beifall)", [(27, 36)]), ("Danke.", [])]
    assert [r.sitting_id for r in got if r.problem] == [2, 3]


@pytest.mark.parametrize(
    "quote, want",
    [
        ("Wer stimmt dafür? – Das sind die SPD und die CDU/CSU. Gegenprobe! – Die AfD. Enthaltungen? – Die Linke. Damit ist der Gesetzentwurf angenommen.", {"spd": "yes", "cdu-csu": "yes", "afd": "no", "linke": "abstain"}),
        ("Der Gesetzentwurf ist mit den Stimmen der SPD gegen die Stimmen der AfD bei Enthaltung der Linken angenommen.", {"spd": "yes", "afd": "no", "linke": "abstain"}),
        ("Der Gesetzentwurf ist mit den Stimmen der SPD gegen die Stimmen der AfD abgelehnt.", {"spd": "no", "afd": "yes"}),
        ("Wer stimmt dafür? – Die SPD. Gegenprobe! – Die SPD. Damit ist der Gesetzentwurf angenommen.", {}),
        ("Wer stimmt dafür? – Einige Abgeordnete der SPD. Gegenprobe! – Die AfD. Damit ist der Gesetzentwurf angenommen.", {"afd": "no"}),
        ("Wer stimmt dafür? – Die Koalition. Damit ist der Gesetzentwurf angenommen.", {}),
        ("Der Gesetzentwurf ist angenommen. Der Gesetzentwurf ist abgelehnt.", {}), ("Nichts.", {}),
        ("Wer zustimmen möchte, möge sich bitte erheben. – Es stimmen dafür die SPDFraktion und  BÜNDNIS 90/DIE GRÜNEN. Sie dürfen sich wieder setzen. Nun diejenigen, die sich enthalten. – Es enthält sich die AfDFraktion. Damit ist der Gesetzentwurf angenommen.", {"spd": "yes", "gruene": "yes", "afd": "abstain"}),
        ("Jetzt bitte ich diejenigen, die zustimmen wollen, sich zu erheben. – Dagegen stimmen die SPD. Damit ist der Gesetzentwurf angenommen.", {}),
        ("Wer dagegenstimmen will, möge sich erheben. – Die Grünen. Vielen Dank. Wer enthält sich? – Die Unionsfraktion. Somit ist die Vorlage angenommen.", {"gruene": "no", "cdu-csu": "abstain"}),
        ("Wer stimmt für den Gesetzentwurf auf Drs. 20/7? – Die FDPFraktion. Der Gesetzentwurf auf Drs. 20/7 ist gegen die AfD und bei Enthaltung der Fraktion Die Linke angenommen.", {"fdp": "yes", "afd": "no", "linke": "abstain"}),
        ("Gegenstimmen? – BSW; Enthaltung? – SSW. Der Gesetzentwurf ist bei Zustimmung der SPD und Ablehnung der AfD angenommen worden.", {"bsw": "no", "ssw": "abstain", "spd": "yes", "afd": "no"}),
        ("Wer stimmt dafür? – Alle übrigen Fraktionen. Wer stimmt dagegen? – Bis auf einige die SPD. Der Gesetzentwurf ist einstimmig angenommen.", {}),
    ],
)
def test_positions(spark, quote, want):
    df = spark.createDataFrame([(1, quote, None)], "quote_id long, text string, comments array<struct<start:int,end:int>>")
    assert {r.party_id: r.position for r in transcripts.group_positions(df).collect()} == want


def test_positions_in_spark(spark):
    df = spark.createDataFrame([(1, "Der Gesetzentwurf ist mit den Stimmen der SPD (die AfD) angenommen.", [(46, 55)]), (2, None, None)], "quote_id long, text string, comments array<struct<start:int,end:int>>")
    assert rows(transcripts.group_positions(df)) == [(1, "spd", "yes")]


def workbook_bytes(table, formula=False):
    cells = "".join(f"<row>{''.join(f'<c r="{chr(65 + i)}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(r))}</row>" for n, r in enumerate(table, 1))
    cells += '<row><c r="A9"><f>1+1</f><v>2</v></c></row>' if formula else ""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_workbook(spark):
    head = ["Sitzungnr", "Abstimmnr", "Fraktion/Gruppe", "Name", "Vorname", *workbook.FLAGS]
    good = workbook_bytes([head, ["1", "2", "SPD", "A", "B", "1", "0", "0", "0", "0"], ["1", "2", "SPD", "C", "D", "0", "1", "0", "0", "0"], ["1", "2", "AfD", "E", "F", "1", "1", "0", "0", "0"]])
    files = spark.createDataFrame([("a", good), ("b", workbook_bytes([head], True)), ("c", b"zip")], "path string, content binary")
    got = workbook.ballot_rows(files).cache()
    assert sorted(rows(workbook.group_counts(got))) == [("a", "SPD", 1, 1, 0, 0, 0)]
    assert sorted(r[1] for r in rows(workbook.ballot_problems(got))) == ["a:4", "b", "c"]
    listing = spark.createDataFrame([(1, '<a href="/x">05.03.2025: Haushalt</a><a href="/y">kein</a>')], "page_id long, html string")
    assert [(r.href, str(r.date), r.title) for r in workbook.vote_listing(listing).collect()] == [("/x", "2025-03-05", "Haushalt")]
    schema = "vote_id long, yes int, no int, abstain int, absent int"
    assert rows(workbook.reconcile(spark.createDataFrame([(1, 2, 1, 0, 0), (2, 5, 0, 0, 0)], schema), spark.createDataFrame([(1, 1, 1, 0, 0), (1, 1, 0, 0, 0)], schema))) == [("totals differ", "2")]


def test_records(spark, tmp_path):
    folder = tmp_path / "parties"
    folder.mkdir()
    for n in ("a", "b"):
        (folder / f"{n}.json").write_text(json.dumps({"id": n, "name": n.upper()}, indent=2))
    df = records.load_records(spark, str(folder), "parties")
    assert sorted((r.id, r.name, r.color) for r in df.collect()) == [("a", "A", None), ("b", "B", None)]
    assert rows(records.unknown_fields(spark, str(folder), "parties")) == []
    (folder / "c.json").write_text('{"id": "c", "extra": 1}')
    assert rows(records.unknown_fields(spark, str(folder), "parties")) == [("unknown field", "extra")]
    (folder / "d.json").write_text('{"id": ')
    with pytest.raises(Exception):
        records.load_records(spark, str(folder), "parties").collect()
    table = str(tmp_path / "t")
    assert records.save_new(df.where("id = 'a'"), table) == 1 and records.save_new(df.where("id in ('a', 'b')"), table) == 1 and spark.read.parquet(table).count() == 2
    assert set(records.schemas_json()) == set(records.SCHEMAS)
    a, b = spark.createDataFrame([(1, "x"), (2, "x")], "k int, v string"), spark.createDataFrame([(2, "y")], "k int, v string")
    assert sorted(rows(records.later_wins(a, b, key="k"))) == [(1, "x"), (2, "y")]
    tree = json.dumps({"id": "r", "title": "R", "children": [{"id": "a", "title": "A"}, {"id": "b", "title": "B", "children": [{"id": "c", "title": "C"}]}]})
    got = records.flatten_tree(spark, spark.createDataFrame([(1, tree)], "program_id long, tree string"))
    assert sorted((r.node_id, r.parent_id, r.ordinal) for r in got.collect()) == [("a", "r", 0), ("b", "r", 1), ("c", "b", 0), ("r", None, 0)]


def test_editions(spark):
    schema = "document_id string, text string, pages array<struct<number:int,markdown:string,warnings:array<string>>>"
    df = spark.createDataFrame([("a", "x\n\ny", [(1, "x", []), (2, "y", ["w"])]), ("b", "x", [(2, "x", [])]), ("c", "z", [(1, "x", [])])], schema).withColumn("sha256", F.sha2("text", 256))
    assert sorted(rows(records.edition_problems(df))) == [("page order", "b"), ("text differs", "c")]
    assert [r.warned_pages for r in records.readings_index(df).orderBy("document_id").collect()] == [[2], [], []]
    old = spark.createDataFrame([("a", 1, "x", True), ("a", 2, "y", False), ("a", 3, "z", True)], "document_id string, number int, markdown string, flagged boolean")
    new = spark.createDataFrame([("a", 1, "X"), ("a", 2, "Y")], "document_id string, number int, markdown string")
    assert sorted(rows(records.repaired_edition(old, new))) == [("a", 1, "X", False), ("a", 2, "y", False), ("a", 3, "z", True)]


def test_cursor(spark, tmp_path):
    write = lambda name, **page: (tmp_path / f"{name}.json").write_text(json.dumps(page))
    write("start", numFound=3, documents=[{"id": 1}, {"id": 2}], cursor="c1")
    write("c1", numFound=3, documents=[{"id": 3}], cursor="c1")
    spark.dataSource.register(cursor.CursorDataSource)
    read = lambda: sorted((r.id, r.page) for r in spark.read.format("cursor").option("path", str(tmp_path)).load().collect())
    assert read() == [("1", 0), ("2", 0), ("3", 1)]
    for page in ({"numFound": 4}, {"numFound": "3"}, {"documents": [{"id": 1}]}, {"documents": [{}]}, {"documents": [], "cursor": "c2"}, {"cursor": "start"}):
        write("c1", **({"numFound": 3, "documents": [{"id": 3}], "cursor": "c1"} | page))
        with pytest.raises(Exception):
            read()
    write("c1", numFound=3, documents=[{"id": 3}])
    with pytest.raises(Exception, match="more than 1 pages"):
        spark.read.format("cursor").option("path", str(tmp_path)).option("max_pages", 1).load().collect()


def test_judge(spark):
    tasks = spark.createDataFrame([(i, i % 2, "a b c", "a b x" if i % 3 else "y") for i in range(20)], "key long, law long, quote string, text string")
    answers = state.judged(tasks, state.overlap_judge("quote", "text"), "key long, supported boolean, confidence double", batch=4, by="law")
    good, bad = state.validated(tasks, answers)
    assert {r.key: r.supported for r in good.collect()} == {i: bool(i % 3) for i in range(20)} and bad.count() == 0

    def careless(frame):
        return pd.DataFrame({"key": [*frame["key"][1:], 99], "supported": True, "confidence": 1.0})

    good, bad = state.validated(tasks, state.judged(tasks, careless, "key long, supported boolean, confidence double", batch=10, by="law"))
    assert sorted((r.rule, r.entity_id) for r in bad.collect()) == [("unanswered", "0"), ("unanswered", "1"), ("unasked", "99")] and good.count() == 18
    hit, miss = state.cached_or(spark.createDataFrame([("a",), ("b",)], "request_sha string"), spark.createDataFrame([("a", "x", True), ("b", "y", False)], "request_sha string, answer string, valid boolean"))
    assert rows(hit) == [("a", "x")] and rows(miss) == [("b",)]


def test_streams(spark, tmp_path):
    """A resumed stream repeats nothing, changed content comes again, and windows agree with the batch."""
    source, out, check = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "check")
    first = state.signature(spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "1")], "key string, text string"), "text").select("key", "signature")
    first.coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema("key string, signature string").parquet(source)
    total = lambda: spark.read.parquet(out).count()
    state.stream_signatures(spark, stream(), out, check)
    assert total() == 2
    state.stream_signatures(spark, stream(), out, check)
    assert total() == 2
    more = state.signature(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1")], "key string, text string"), "text").select("key", "signature")
    more.coalesce(1).write.mode("append").parquet(source)
    state.stream_signatures(spark, stream(), out, check)
    assert total() == 4 and state.pending(more, spark.read.parquet(out)).count() == 0
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    live = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001")
    query = state.event_windows(live).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(repr, spark.table("w").collect())) == sorted(map(repr, state.event_windows(events).collect()))


def test_splitting(spark):
    """A failing batch is halved until its sound rows are answered."""
    tasks = spark.createDataFrame([(i, 0) for i in range(9)], "key long, law long")

    def weak(frame):
        if 5 in set(frame["key"]):
            raise ValueError("refused")
        return pd.DataFrame({"key": frame["key"], "supported": True})

    answers = state.judged(tasks, state.splitting(weak, state.answers_all), "key long, supported boolean", batch=9, by="law")
    good, bad = state.validated(tasks, answers)
    assert sorted(r.key for r in good.collect()) == [0, 1, 2, 3, 4, 6, 7, 8] and rows(bad) == [("unanswered", "5")]


SECOND = "Der Ausschuss empfiehlt, den Gesetzentwurf auf Drucksache 20/7 anzunehmen. Zweite und dritte Beratung. Ich bitte diejenigen, die dem zustimmen, um das Handzeichen. Der Gesetzentwurf ist in zweiter Beratung angenommen. "
THIRD = "Wir kommen zur Schlussabstimmung. Ich bitte diejenigen, die zustimmen wollen, sich zu erheben. Der Gesetzentwurf ist angenommen."


PARTIAL = "Der Ausschuss empfiehlt, den Gesetzentwurf auf Drucksache 20/7 anzunehmen. Zweite und dritte Beratung. Wer stimmt für die übrigen Teile des Gesetzentwurfs? – Die SPD. Die übrigen Teile des Gesetzentwurfs sind angenommen. Alle Teile des Gesetzentwurfs sind damit in zweiter Beratung angenommen. "


def test_decision_passages(spark):
    """One decision of the stage on all numbers; its final vote takes the second reading's references, but no other motion's."""
    cases = [
        (SECOND + THIRD, ["20/7"], "final_passage", "Schlussabstimmung"), (SECOND + THIRD, ["20/7"], "second_reading", "Ich bitte"), (SECOND + THIRD, ["20/8"], "final_passage", None), (SECOND + THIRD, [], "final_passage", None),
        (SECOND + "Tagesordnungspunkt 9. " + THIRD, ["20/7"], "final_passage", None), (SECOND + THIRD + SECOND + THIRD, ["20/7"], "final_passage", None), (PARTIAL + THIRD, ["20/7"], "final_passage", "Schlussabstimmung"),
        ((SECOND + THIRD).replace(" ", "\n "), ["20/7"], "final_passage", "Schlussabstimmung"), (None, ["20/7"], "final_passage", None), ("", None, None, None),
    ]
    df = spark.createDataFrame([(i, t, n, s) for i, (t, n, s, _) in enumerate(cases)], "block_id long, text string, numbers array<string>, stage string")
    got = {r.block_id: r for r in transcripts.decision_passages(df).collect()}
    assert set(got) == {i for i, c in enumerate(cases) if c[3]}
    for i, r in got.items():
        text, _, _, begin = cases[i]
        assert r.quote == text[r.start : r.end] and r.quote.startswith(begin) and r.quote.endswith("angenommen.")
    assert [(r.stage, r.carried) for r in sorted(transcripts.decisions(df.where("block_id = 6")).collect(), key=lambda r: r.i)] == [(None, False), ("second_reading", True), ("final_passage", True)]


def test_decisions_stay_in_their_blocks_rows(spark):
    """No text is cut into rows that are joined and ordered again; of a block that comes twice one is kept."""
    df = spark.createDataFrame([(n, SECOND + "😀 " + THIRD, ["20/7"], "final_passage") for n in (1, 2, 2)], "block_id long, text string, numbers array<string>, stage string")
    for found in (transcripts.decisions(df), transcripts.decision_passages(df)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan
    assert sorted((r.block_id, r.stage, r.refs, r.carried) for r in transcripts.decisions(df).collect()) == [(n, *d) for n in (1, 2) for d in (("final_passage", ["20/7"], True), ("second_reading", ["20/7"], False))]
    assert sorted(r.block_id for r in transcripts.decision_passages(df).collect()) == [1, 2]


class Answer(io.BytesIO):
    def __init__(self, content, url):
        super().__init__(content)
        self.url = url

    def geturl(self):
        return self.url


def test_download():
    import urllib.error

    hosts, waits, tries = {"x.de"}, [], []

    def fetch(url):
        tries.append(url)
        if len(tries) < 3:
            raise urllib.error.HTTPError(url, 503, "", {}, None)
        return Answer(b"abc", url)

    assert download.download("https://x.de/a#b", hosts, fetch=fetch, sleep=waits.append) == b"abc" and waits == [1.0, 2.0] and tries[0] == "https://x.de/a"
    for url in ("http://x.de/", "https://y.de/", "https://u@x.de/", "https://x.de:8443/", "https://x.de/?token=1"):
        with pytest.raises(download.Refused):
            download.download(url, hosts, fetch=fetch)
    with pytest.raises(download.Refused):
        download.download("https://x.de/", hosts, fetch=lambda u: Answer(b"", "https://evil.de/"))
    with pytest.raises(download.Refused):
        download.download("https://x.de/", hosts, limit=2, fetch=lambda u: Answer(b"abc", u))


def test_redirects():
    import urllib.request

    handler, request = download.SameHosts({"x.de"}), urllib.request.Request("https://x.de/a")
    assert handler.redirect_request(request, None, 302, "", {}, "https://x.de/b").full_url == "https://x.de/b"
    for target in ("https://evil.de/", "http://x.de/b", "https://x.de/b?token=1"):
        with pytest.raises(download.Refused):
            handler.redirect_request(request, None, 302, "", {}, target)


def test_protocol_index(spark):
    row = lambda *hrefs: "<tr><td>" + "".join(f'<a href="{h}">XML</a>' for h in hrefs) + "</td></tr>"
    page = lambda *rows_: f'<template data-js-document-results="table">{"".join(rows_)}</template><template data-js-document-results="list">{row("/x/20999.xml")}</template>'
    pages = [
        (20, 0, page(row("/b/20001.xml"), row("https://www.p.de/b/20002.xml"), row("/b/a.pdf"), row("/b/20003.xml", "/b/20004.xml"))),
        (20, 4, page(row("/b/20002.xml"), row("https://evil.de/20005.xml"), row("/b/19006.xml"), row("/b/20.xml"))),
        (20, 8, page()), (20, 12, "<html>"), (21, 0, page(row("/b/21001.xml"))), (21, 4, None),
    ]
    got = feeds.protocol_index(spark.createDataFrame(pages, "term int, place int, html string"), "www.p.de").collect()
    assert sorted((r.term, r.sitting, r.url) for r in got if r.problem is None) == [(20, 1, "https://www.p.de/b/20001.xml"), (21, 1, "https://www.p.de/b/21001.xml")]
    assert sorted((r.term, r.place, r.problem) for r in got if r.problem) == [
        (20, 0, "not one XML link"), (20, 0, "not one XML link"), (20, 0, "sitting twice"), (20, 4, "another term"), (20, 4, "link leaves the host"), (20, 4, "no term and sitting in the name"), (20, 4, "sitting twice"), (20, 12, "no table of protocols"), (21, 4, "no table of protocols"),
    ]


def test_slice():
    now, work = [0.0], {"a": [3, 2, 0, 0], "b": [1, 0, 0, 0]}

    def step(name):
        now[0] += 1
        return work[name].pop(0)

    steps = [(n, lambda n=n: step(n)) for n in work]
    assert state.run_slice(steps, seconds=100, clock=lambda: now[0]) == {"a": 5, "b": 1}
    now[0], work["a"], work["b"] = 0, [1] * 9, [1] * 9
    assert state.run_slice(steps, seconds=3, clock=lambda: now[0]) == {"a": 2, "b": 1}


def test_html(spark):
    got = python_text.safe_html("# T\n\n- a\n- **b**\n\n<script>x</script> [l](https://x.de) [j](javascript:1) ![i](http://i)")
    assert got == '<h6>T</h6><ul><li>a</li><li><strong>b</strong></li></ul><p>&lt;script&gt;x&lt;/script&gt; <a href="https://x.de" rel="noopener">l</a> [j](javascript:1) </p>'


def test_schemas(spark):
    from pyspark.sql import types as T

    kind = T._parse_datatype_string("a int, b array<struct<c:boolean>>")
    assert records.strict_json_schema(kind)["additionalProperties"] is False
    assert records.schema_faults({"a": 1, "b": [{"c": True}]}, kind) == [] and records.schema_faults({"a": True, "b": [{"c": 1, "d": 2}]}, kind) == ["$.a: wrong type", "$.b[0]: unknown field", "$.b[0].c: wrong type"]
    assert list(records.api_description({"x": spark.range(1)})["paths"]) == ["/x.json"]
