"""Text expressions. All run inside the JVM; null texts give null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# German function words that never index, tag synonyms, and group names.
STOPWORDS = (
    "der die das ein eine einer eines und oder ist sind wird werden mit für von im in an auf zu des den dem "
    "als nach über durch zum zur sich bei auch nicht nur sowie es wir soll sollen mehr diesem diese"
).split()
ALIASES = {
    "arbeit": "Mindestlohn Lohn Tarifvertrag Beschäftigung Arbeitszeit Arbeitnehmer",
    "wirtschaft": "Unternehmen Wirtschaft Investition Bürokratie Wettbewerb",
    "steuern": "Steuer Einkommensteuer Körperschaftsteuer Umsatzsteuer Abgabe",
    "soziales": "Rente Bürgergeld Grundsicherung Sozialleistung Armut",
    "klima": "Klimaschutz Emission CO2 Treibhausgas Klimaneutralität",
    "energie": "Strom Energie erneuerbar Netzentgelt Stromsteuer Heizung",
    "mobilitaet": "Bahn ÖPNV Verkehr Deutschlandticket Straße Schiene Tempolimit",
    "wohnen": "Miete Wohnung Mietpreisbremse Wohnungsbau Wohngeld",
    "bildung": "Schule Bildung Hochschule BAföG Ausbildung",
    "gesundheit": "Pflege Krankenhaus Gesundheit Krankenkasse",
    "migration": "Asyl Einwanderung Migration Staatsangehörigkeit Aufenthalt",
    "digitales": "Digitalisierung Internet Breitband Datenschutz Verwaltung",
    "demokratie": "Wahl Transparenz Demokratie Bundestag Lobbyregister",
    "sicherheit": "Bundeswehr Polizei Sicherheit Verteidigung Strafrecht",
    "europa": "Europäische Union Europarecht Binnenmarkt",
}
GROUPS = {
    "cducsu": "cdu-csu", "spd": "spd", "afd": "afd", "fdp": "fdp", "bündnis90diegrünen": "gruene", "bü90gr": "gruene", "b90grüne": "gruene",
    "dielinke": "linke", "bsw": "bsw", "ssw": "ssw", "fraktionslos": "independent", "fraktionslose": "independent",
}

# Titles that are no part of a name, and what scanned Markdown holds that is no text (image links keep their label).
TITLES = ["Prof.", "Dr.", "h.c.", "h. c."]
NO_TEXT = {r"!\[([^\]]*)\]\([^\n)]*\)": "$1", r"(?m)^[ \t]*img-\d+\.(?:jpeg|jpg|png)[ \t]*$": "", r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]": "", "\u00ad\n?": "", r"\n{3,}": "\n\n"}

WORD = r"[\p{L}\p{N}_]+"


def folded(c: Column) -> Column:
    """Lower case with ß as ss."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def collapsed(c: Column) -> Column:
    """White-space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def terms(c: Column) -> Column:
    """Index terms before stemming: folded words of three characters or more that are no function words; null has none."""
    found = F.filter(words(folded(c)), lambda w: (F.char_length(w) > 2) & ~w.isin(STOPWORDS))  # a hash lookup for each word
    return F.coalesce(found, F.array().cast("array<string>"))


def criterion_text(title: Column, test: Column, quote: Column, keywords: Column, tags: Column) -> Column:
    """A criterion's text for retrieval, with the synonyms of its tags."""
    table = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.concat_ws(" ", title, test, quote, F.array_join(keywords, " "), F.array_join(F.transform(tags, lambda t: table[t]), " "))


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0))


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def stable_id(prefix: str, c: Column) -> Column:
    """prefix and 16 hex digits of the collapsed, folded text's SHA-256."""
    return F.concat(F.lit(prefix + "-"), F.left(digest(folded(collapsed(c))), F.lit(16)))


def bound(value: Column, use) -> Column:
    """use(value), with the value computed once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def document_numbers(c: Column) -> Column:
    """Sorted distinct references such as 20/1234."""
    found = F.regexp_extract_all(c, F.lit(r"(?=\d)\b\d{1,2}/\s*\d{1,6}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"\s", ""))))


def group_key(c: Column) -> Column:
    """A group's key from any of its spellings; an unknown group keeps its squeezed name."""
    squeezed = F.regexp_replace(folded(c), r"[^\p{L}\p{N}_]", "")
    return F.coalesce(F.create_map(*[F.lit(x) for pair in GROUPS.items() for x in pair])[squeezed], squeezed)


def name_key(c: Column) -> Column:
    """A person's name without parentheses, titles, case and punctuation."""
    plain = F.regexp_replace(c, r"(?U)\s*\([^)]*\)", "")
    titles = "|".join(t.replace(".", r"\.").replace(" ", r"\s*") for t in TITLES)
    return F.regexp_replace(folded(F.regexp_replace(plain, rf"(?iU)\b(?:{titles})\s*", "")), r"[^\p{L}\p{N}_]", "")


def clean_markdown(c: Column) -> Column:
    """Without images, image placeholders, control characters, soft hyphens and runs of blank lines."""
    for pattern, instead in NO_TEXT.items():
        c = F.regexp_replace(c, pattern, instead)
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def expand_tables(c: Column, tables: Column) -> Column:
    """Table links [id](id) replaced by the content of tables (array of id, content), each set apart by blank lines."""
    return clean_markdown(F.aggregate(tables, c, lambda acc, t: F.replace(acc, F.concat(F.lit("["), t["id"], F.lit("]("), t["id"], F.lit(")")), F.concat(F.lit("\n\n"), t["content"], F.lit("\n\n")))))


def tables_placed(c: Column, tables: Column) -> Column:
    """Whether table ids are distinct and each table is linked or already quoted."""
    ids = F.transform(tables, lambda t: t["id"])
    return (F.size(F.array_distinct(ids)) == F.size(ids)) & F.forall(tables, lambda t: F.contains(c, F.concat(F.lit("]("), t["id"], F.lit(")"))) | F.contains(c, t["content"]))


def _long_words(c: Column) -> Column:
    joined = F.regexp_replace(c, r"(?U)(\w)[-­]\s*\n\s*(\w)", "$1$2")
    return F.array_distinct(F.regexp_extract_all(folded(joined), F.lit(r"\p{L}{4,}"), F.lit(0)))


def native_recall(native: Column, text: Column) -> Column:
    """Share of native's distinct longer words that text has, to three digits; null if there are under eight."""
    expected = _long_words(native)
    share = F.size(F.array_intersect(expected, _long_words(text))) / F.size(expected)
    return F.when(F.size(expected) >= 8, F.bround(share, 3))


def repeats_hyphenated(c: Column) -> Column:
    """Whether a word before a hyphen and line break stands again after it."""
    return c.rlike(r"(?iU)(\w{3,})-\s*\n+\s*\1")


def without_comments(c: Column, spans: Column) -> Column:
    """Spans (array of start, end) blanked out, lengths kept."""
    return F.aggregate(spans, c, lambda acc, s: F.overlay(acc, F.repeat(F.lit(" "), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))


def text_windows(c: Column, width: int = 8000, stride: int = 6000) -> Column:
    """array of (offset, part): windows from 0 by stride while they begin inside the text; an empty text has none."""
    starts = F.when(F.length(c) > 0, F.sequence(F.lit(0), F.length(c) - 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda o: F.struct(o.alias("offset"), F.substring(c, o + 1, F.lit(width)).alias("part")))


def first_heading(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?m)^#{1,4}\s+(.+)$", 1), F.lit(""))


def citation(c: Column) -> Column:
    """(part, year, number) of a gazette reference; null if it is none."""
    pattern = r"bgbl-([12])-(\d{4})-(\d+[a-z]?)"
    parts = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
    return F.when(c.rlike(pattern), F.struct(*[p.alias(n) for p, n in zip(parts, ("part", "year", "number"))]))


def feed_date(c: Column) -> Column:
    """ISO date, or the day, month and year of an RFC 2822 date; null if neither."""
    return F.coalesce(F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.regexp_extract(c, r"(\d{1,2} [A-Za-z]{3} \d{4})", 1), "d MMM yyyy"))


def format_percentage(c: Column) -> Column:
    """One decimal with a comma; a dash for unknown and '<0,1 %' for what is above zero but would round to it."""
    return F.when(c.isNull(), "—").when((c > 0) & (c < 0.1), "<0,1 %").otherwise(F.concat(F.translate(F.format_number(c, 1), ",.", ".,"), F.lit(" %")))


def format_date(c: Column) -> Column:
    return F.date_format(c, "d.M.yyyy")


def percentage(count: Column, total: Column) -> Column:
    """Exact percent; null on a zero total."""
    return F.try_divide(count.cast("double"), total.cast("double")) * 100


def is_official_url(c: Column, hosts: list[str]) -> Column:
    """https, a listed host, no user or other port, and no credentials in the query; null is not official."""
    host = F.lower(F.try_parse_url(c, F.lit("HOST")))
    authority = F.coalesce(F.try_parse_url(c, F.lit("AUTHORITY")), F.lit(""))
    plain = (F.try_parse_url(c, F.lit("PROTOCOL")) == "https") & host.isin(hosts) & ~authority.contains("@") & (~authority.contains(":") | authority.endswith(":443"))
    return F.coalesce(plain & ~F.coalesce(F.try_parse_url(c, F.lit("QUERY")), F.lit("")).rlike("(?i)(apikey|token|authorization)"), F.lit(False))


def is_safe_path(c: Column, root: str) -> Column:
    """A Markdown path below root without steps upwards."""
    return F.coalesce(F.startswith(c, F.lit(root.rstrip("/") + "/")) & ~c.rlike(r"(^|/)\.\.(/|$)") & F.endswith(c, F.lit(".md")), F.lit(False))


def page_href(collection: Column, doc_id: Column, page: Column) -> Column:
    return F.format_string("/%s/%s/text/#page-%s", collection, doc_id.cast("string"), page.cast("string"))


def quote_status(quote: Column, source: Column) -> Column:
    """exact, restored (unique after white space is collapsed), ambiguous, absent, or short (under ten characters)."""
    q = collapsed(quote)
    s = F.regexp_replace(source, r"(?U)\s+", " ")
    at = F.instr(s, q)
    return (
        F.when(F.coalesce(F.length(q), F.lit(0)) < 10, "short")
        .when(F.contains(source, quote), "exact")
        .when(F.coalesce(at, F.lit(0)) == 0, "absent")
        .when(F.contains(F.substring(s, at + 1, F.length(s)), q), "ambiguous")
        .otherwise("restored")
    )


def matches_all(search: Column, query: str) -> Column:
    """Whether every word of the query is part of the search text."""
    found = F.lit(True)
    for word in query.lower().split():
        found = found & F.contains(search, F.lit(word))
    return found
