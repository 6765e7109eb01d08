"""Gazette feeds, archive pages and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

ITEM = "title string, link string, pubDate string, typ string, fundstelle string"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Law entries of RSS files (law_id, title, url, published_at), newest first within Spark's order of use.

    Items of other kinds are left out; an item without a readable reference or date, or a feed without items, is an error.
    """
    raw = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, pubDate string, `meta:typ` string, `meta:fundstelle` string").load(path)
    if raw.isEmpty():
        raise ValueError("the feed has no items")
    return parse_items(raw.select("title", "link", "pubDate", F.col("`meta:typ`").alias("typ"), F.col("`meta:fundstelle`").alias("fundstelle")))


def parse_items(items: DataFrame) -> DataFrame:
    """Feed items (title, link, pubDate, typ, fundstelle) as law entries."""
    laws = items.where(F.trim("typ") == "Gesetz")
    ref = F.regexp_extract(F.col("link"), r"eli/bund/bgbl-([12])/(\d{4})/(\d+[a-z]?)", 0)
    part, year, number = (F.regexp_extract(F.col("link"), r"eli/bund/bgbl-([12])/(\d{4})/(\d+[a-z]?)", i) for i in (1, 2, 3))
    day = T.feed_date(F.trim("pubDate"))
    checked = F.when((ref == "") | day.isNull(), F.raise_error(F.concat(F.lit("unreadable feed item: "), F.coalesce("link", F.lit("")))).cast("date")).otherwise(day)
    citation = F.coalesce("fundstelle", F.concat(F.lit("BGBl. "), F.when(part == "2", "II").otherwise("I"), F.lit(" "), year, F.lit(" Nr. "), number))
    return laws.select(F.concat_ws("-", F.lit("bgbl"), part, year, number).alias("law_id"), T.collapsed(F.col("title")).alias("title"), F.col("link").alias("url"), citation.alias("citation"), checked.alias("published_at"))


def new_entries(entries: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """Entries whose id is not known, newest first, with status: `imported` for the first `limit`, else `deferred`.

    The order is found by Spark's ordered limit; the rest is not ranked.
    """
    fresh = entries.join(known.select("law_id"), "law_id", "left_anti")
    first = fresh.orderBy(F.desc("published_at"), "law_id").limit(limit).select("law_id", F.lit("imported").alias("status"))
    return fresh.join(first, "law_id", "left").withColumn("status", F.coalesce("status", F.lit("deferred")))


def pdf_links(pages: DataFrame) -> DataFrame:
    """(page_id, href, n): links that end in .pdf and lie below the page's own address, counted."""
    each = pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))).alias("href"))
    target = F.when(F.col("href").rlike("^https?://"), F.col("href")).otherwise(F.concat(F.regexp_extract("url", r"^(https?://[^/]+)", 1), F.col("href")))
    own = F.startswith(target, F.regexp_replace("url", r"[^/]*$", "")) & target.rlike(r"(?i)\.pdf(?:\?|$)")
    return each.where(own).groupBy("page_id", "href").agg(F.count("*").alias("n"))


# The archive's markup, and how it cites a law.
RESULT_SECTION = r"""(?is)<section\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?searchresult(?:\s[^"']*)?["'][^>]*>(.*?)</section\s*>"""
NEXT_ITEM = r"""(?is)<li\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?c-nav-index__item--next(?:\s[^"']*)?["'][^>]*>(.*?)</li\s*>"""
FORWARD = r"""(?is)<a\b(?=[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?forward(?:\s[^"']*)?["'])[^>]*>"""
HREF = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
TOTAL = r"Suchergebnisse:\s*([\d.]+)"
LAW_PATH = r"^/bgbl/([12])/(\d{4})/(\d+[a-z]?)/VO\.html$"
CITATION = r"^BGBl\. (\d{4}) (II|I) Nr\. (\d+[a-z]?) vom (\d{2}\.\d{2}\.\d{4})$"

ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def _shown(markup: Column) -> Column:
    """What a reader sees of markup, with single spaces."""
    text = F.regexp_replace(markup, r"(?s)<!--.*?-->|<[^>]*>", "")
    for entity, sign in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def archive_results(pages: DataFrame, hosts: list[str]) -> DataFrame:
    """(page_id, total, next, pos, law_id, title, url, citation, published_at, problem) of archive pages (page_id, html).

    A law is a link below a result section's heading, which must cite that law; a section may hold several. A page
    without laws has one row. A page that can't be trusted has one row with a problem and no law.
    """
    html = F.coalesce("html", F.lit(""))
    links = F.concat(F.flatten(F.transform(F.regexp_extract_all(html, F.lit(NEXT_ITEM), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit(HREF), F.lit(1)))), F.transform(F.regexp_extract_all(html, F.lit(FORWARD), F.lit(0)), lambda x: F.regexp_extract(x, HREF, 1)))
    total = F.replace(F.nullif(F.regexp_extract(_shown(html), TOTAL, 1), F.lit("")), F.lit("."), F.lit("")).cast("long")
    # Each section is cut at its headings; the part before the first one has no citation.
    sections = F.regexp_extract_all(html, F.lit(RESULT_SECTION), F.lit(1))
    parts = F.flatten(F.transform(sections, lambda s: F.transform(F.split(s, r"(?i)<h3\b[^>]*>"), lambda x, k: F.struct(F.when(k > 0, F.element_at(F.split(x, r"(?i)</h3\s*>", 2), 1)).alias("heading"), F.when(k > 0, F.get(F.split(x, r"(?i)</h3\s*>", 2), F.lit(1))).otherwise(x).alias("body")))))
    anchors = lambda p: F.transform(F.regexp_extract_all(p["body"], F.lit(r"(?is)<a\b[^>]*>.*?</a\s*>"), F.lit(0)), lambda a: F.struct(p["heading"].alias("heading"), F.regexp_extract(a, HREF, 1).alias("href"), a.alias("anchor")))
    laws = F.filter(F.flatten(F.transform(parts, anchors)), lambda a: F.coalesce(F.try_parse_url(a["href"], F.lit("PATH")), a["href"]).rlike(LAW_PATH))
    each = pages.select("page_id", total.alias("total"), F.array_distinct(links).alias("links"), F.posexplode_outer(laws).alias("pos", "law"))
    path, heading = F.try_parse_url("law.href", F.lit("PATH")), _shown(F.col("law.heading"))
    part, year, number = (F.regexp_extract(path, LAW_PATH, i) for i in (1, 2, 3))
    cited_year, roman, cited, day = (F.regexp_extract(heading, CITATION, i) for i in (1, 2, 3, 4))
    title, found = _shown(F.col("law.anchor")), F.col("law").isNotNull()
    official = (F.try_parse_url("law.href", F.lit("PROTOCOL")) == "https") & F.try_parse_url("law.href", F.lit("HOST")).isin(hosts) & heading.rlike(CITATION)
    same = (year == cited_year) & (number == cited) & (part == F.when(roman == "I", "1").otherwise("2"))
    problem = F.when(F.col("total").isNull(), "no result count").when(F.size("links") > 1, "conflicting next links").when(found & ~F.coalesce(official, F.lit(False)), "no official law or citation").when(found & ~same, "citation of another law").when(found & (title == ""), "no title")
    each = each.select(
        "page_id", "total", F.get("links", F.lit(0)).alias("next"), F.col("pos").cast("long").alias("pos"), F.when(found, F.concat_ws("-", F.lit("bgbl"), part, year, number)).alias("law_id"), title.alias("title"),
        F.when(found, F.concat(F.lit("https://www.recht.bund.de/eli/bund/bgbl-"), F.concat_ws("/", part, year, number))).alias("url"), F.when(found, F.concat(F.lit("BGBl. "), year, F.lit(" "), roman, F.lit(" Nr. "), number)).alias("citation"),
        F.try_to_date(day, "dd.MM.yyyy").alias("published_at"), problem.alias("problem"),
    )
    first = F.min(F.when(F.col("problem").isNotNull(), F.coalesce("pos", F.lit(0)))).over(Window.partitionBy("page_id"))
    each = each.withColumn("fault", first).where("fault is null or fault = coalesce(pos, 0)")
    ofsound = lambda c: F.when(F.col("fault").isNull(), F.col(c)).alias(c)
    return each.select("page_id", *[ofsound(c) for c in ("total", "next", "pos", "law_id", "title", "url", "citation", "published_at")], "problem")


def archive_problems(results: DataFrame) -> DataFrame:
    """(rule, entity_id): totals that differ between pages, entries met twice, pages met again, and a wrong sum."""
    rows = results.where("pos is not null")
    total = results.agg(F.count_distinct("total").alias("n"), F.max("total").alias("total"))
    drift = total.where("n > 1").select(F.lit("total drifts").alias("rule"), F.col("total").cast("string").alias("entity_id"))
    twice = rows.groupBy("law_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("entry twice"), "law_id")
    loop = results.select("page_id", "next").distinct().groupBy("next").agg(F.count("*").alias("n")).where("n > 1 and next is not null").select(F.lit("page loop"), "next")
    short = total.join(rows.agg(F.count("*").alias("found")), F.lit(True)).where("found <> total").select(F.lit("total differs"), F.col("found").cast("string"))
    return drift.union(twice).union(loop).union(short)


def first_sound(candidates: DataFrame) -> DataFrame:
    """Per id the first of its mirrors, by position, whose digest fits: (id, url, pos)."""
    w = Window.partitionBy("id").orderBy("pos")
    return candidates.where("sha = expected").withColumn("nth", F.row_number().over(w)).where("nth = 1").select("id", "url", "pos")


def fresh_cache(cache: DataFrame, now: int, ttl: int, negative_ttl: int) -> DataFrame:
    """Usable rows of a cache (url_sha, content, sha, retrieved_at): young enough, and with content that fits its digest."""
    age = F.lit(now) - F.col("retrieved_at")
    negative = F.col("content").isNull()
    return cache.where(F.when(negative, age < negative_ttl).otherwise((age < ttl) & (F.sha2("content", 256) == F.col("sha"))))


def protocol_index(pages: DataFrame, host: str) -> DataFrame:
    """(term, place, sitting, url, problem) of pages (term, place, html) of a listing of protocols: one row a table row.

    Only the template of the table counts, as the same rows stand in one for a list too. A row names one XML file on the
    host, by term and sitting; what doesn't is a problem, as is a sitting on two places, which a listing that stalls gives.
    A page without that template is one row with a problem; a table without rows ends the listing and gives none.
    """
    table = F.regexp_extract("html", r'(?s)<template[^>]*data-js-document-results="table"[^>]*>(.*?)</template>', 1)
    has = F.coalesce(F.col("html").rlike(r'<template[^>]*data-js-document-results="table"'), F.lit(False))
    missing = pages.where(~has).select("term", "place", F.lit(None).cast("int").alias("sitting"), F.lit(None).cast("string").alias("url"), F.lit("no table of protocols").alias("problem"))
    rows = pages.where(has).select("term", "place", F.explode(F.regexp_extract_all(table, F.lit(r"(?s)<tr[ >].*?</tr>"), F.lit(0))).alias("row"))
    links = rows.select("term", "place", F.regexp_extract_all("row", F.lit(r'href="([^"]*\.xml)"'), F.lit(1)).alias("links"))
    path = F.get("links", F.lit(0))
    url = F.when(path.startswith("/"), F.concat(F.lit(f"https://{host}"), path)).otherwise(path)
    name = F.regexp_extract("url", r"/(\d{2})(\d{3})\.xml$", 0)
    each = links.withColumn("url", url).withColumn("name", name)
    number = lambda g: F.regexp_extract("url", r"/(\d{2})(\d{3})\.xml$", g).try_cast("int")
    problem = F.when(F.size("links") != 1, "not one XML link").when(~F.startswith("url", F.lit(f"https://{host}/")), "link leaves the host").when(F.col("name") == "", "no term and sitting in the name").when(number(1) != F.col("term"), "another term")
    each = each.select("term", "place", F.when(problem.isNull(), number(2)).alias("sitting"), "url", problem.alias("problem"))
    again = F.count("*").over(Window.partitionBy("term", "sitting"))
    each = each.withColumn("again", again).withColumn("problem", F.when(F.col("sitting").isNotNull() & (F.col("again") > 1), "sitting twice").otherwise(F.col("problem")))
    return each.drop("again").unionByName(missing)
