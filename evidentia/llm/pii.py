"""Information-theoretic removal of personal data, in DataFrame operations only.

Protected entities are e-mail addresses, IP addresses, card numbers and phone numbers, at four levels: an entity itself,
its group (mail domain, network, issuer, area), its kind, and any kind. Counted in distinct texts, a term t reveals e as far as the
pointwise mutual information PMI(t, e) = log2(N n(t, e) / (n(t) n(e))) covers the information IC(e) = log2(N / n(e)).

* An entity or a group: t stands within `near` words of it, in at least `support` texts.
* A kind, or any: t stands anywhere in texts that hold one. Single entities are mostly in one text only, which shows no
  association; their kind is in many.

For groups and kinds, which stand beside many words by chance, n(t, e) is taken at the lower bound of its confidence
interval, n - z sqrt(n). A term whose share PMI / IC reaches the threshold is a span wherever it stands (for an entity or
group: in the texts where it stands near it). Sanitising removes it if it reveals nearly wholly, else generalises it.

A null text is empty and has no spans. Spans depend on the text alone, so equal texts have equal spans and count once in
the statistics. Positions are code points, ends exclusive. An empty table gives no rows. Further columns are kept aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_or_shuffled

#: Each kind's pattern, written with possessive loops so that no text makes it backtrack, and what a text must hold for it.
#: They find what the plain patterns find: an e-mail's or IP's later starts in a run fail as its first start fails.
KINDS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?+[0-9]){11,}+", r"[0-9][0-9\x20-]{10,22}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
ORDER = [*KINDS, "term"]
LEVELS = [*KINDS, "any"]
WORD = r"[^\x20\x09-\x0D]+"
EDGES = r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$"
NAME = r"^[^@\p{N}]*\p{L}[^@\p{N}]*$"  # a term may be a word, not a number or an entity of its own


def _luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is divisible by 10."""
    at = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 1, at(i)).otherwise(at(i) * 2 - F.when(at(i) > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    parts = F.split(match, r"\.")
    small = F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= F.when(F.regexp_replace(p, "^0+", "") > "255", 2).otherwise(3))
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", F.length(digits).between(12, 19) & _luhn(F.when(F.length(digits).between(12, 19), digits).otherwise(F.lit("0"))))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(True))
    )


def _located(rows: DataFrame, kind: Column, pattern: Column) -> DataFrame:
    """(row, kind, start, end, match) of all matches in rows (row, text): what stands between matches gives their places."""
    cut = rows.select("row", kind.alias("kind"), F.split("text", pattern, -1).alias("between"), F.regexp_extract_all("text", pattern, F.lit(0)).alias("matches"))
    gaps = F.transform("between", lambda b: F.length(b))
    each = cut.select("row", "kind", F.posexplode(F.arrays_zip(gaps.alias("gap"), F.col("matches").alias("match"))).alias("i", "m")).where(F.col("m.match").isNotNull())
    each = each.select("row", "kind", "i", "m.gap", "m.match").dropDuplicates(["row", "kind", "i"])
    upto = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    return each.select("row", "kind", (end - F.length("match")).cast("long").alias("start"), end.cast("long").alias("end"), "match")


def _content() -> Column:
    return F.xxhash64(F.col("text").isNull(), F.col("text")).alias("row")


def base_spans(docs: DataFrame) -> DataFrame:
    """(row, kind, start, end, match) of the four kinds; what fails a kind's check is dropped and not tried again.

    Here and below, row is a text's hash: it stands for all rows of that text.
    """
    rows = docs.select(_content(), "text")
    found = None
    for kind, (pattern, sign) in KINDS.items():
        may = F.col("text").contains(sign) if len(sign) == 1 else F.col("text").rlike(sign)
        one = _located(rows.where(may), F.lit(kind), F.lit(pattern))
        found = one if found is None else found.unionByName(one)
    return found.where(_valid(F.col("kind"), F.col("match")))


def _entity(kind: Column, match: Column) -> Column:
    """One spelling of an entity: lower case, and digits only for numbers."""
    return F.concat_ws(":", kind, F.when(kind == "email", F.lower(match)).when(kind == "ip", match).otherwise(F.regexp_replace(match, "[^0-9]", "")))


def _group(kind: Column, match: Column) -> Column:
    """What entities have in common: a mail domain, the first two parts of an address, the first six digits of a card, four of a phone number."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    part = F.when(kind == "email", F.lower(F.substring_index(match, "@", -1))).when(kind == "ip", F.substring_index(match, ".", 2)).otherwise(F.substring(digits, F.lit(1), F.when(kind == "card", 6).otherwise(4)))
    return F.concat_ws(" of ", kind, part)


def _terms(part: Column) -> Column:
    return F.transform(F.regexp_extract_all(part, F.lit(WORD), F.lit(0)), lambda w: F.regexp_replace(w, EDGES, ""))


def _beside(near: int, step: int = 400) -> Column:
    """The terms within `near` words before start and after end of text.

    They are first looked for in `step` characters; only if these hold no more than `near` words, and so may cut one of
    them, in all of the text before or after.
    """
    part = lambda begin, length: F.substring(F.col("text"), (begin + 1).cast("int"), length.cast("int"))
    words_at = lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))
    start, end, size = F.col("start"), F.col("end"), F.length("text")
    left = words_at(part(F.greatest(start - step, F.lit(0)), F.least(start, F.lit(step))))
    right = words_at(part(end, F.lit(step)))
    left = F.when((start <= step) | (F.size(left) > near), left).otherwise(words_at(part(F.lit(0), start)))
    right = F.when((end + step >= size) | (F.size(right) > near), right).otherwise(words_at(part(end, size)))
    both = F.concat(F.slice(F.reverse(left), 1, near), F.slice(right, 1, near))
    return F.array_distinct(F.filter(F.transform(both, lambda w: F.regexp_replace(w, EDGES, "")), _may_reveal))


def _may_reveal(w: Column) -> Column:
    return (F.length(w) > 2) & w.rlike(NAME)


def revealing_terms(docs: DataFrame, spans: DataFrame, *, near: int, share: float, support: int, z: float) -> DataFrame:
    """(row, term, share): in which texts which terms reveal at least that share of an entity, a group or a kind."""
    rows = docs.select(_content(), "text")
    marks = F.array(F.struct(_entity(F.col("kind"), F.col("match")).alias("entity"), F.lit(0.0).alias("z")), F.struct(_group(F.col("kind"), F.col("match")).alias("entity"), F.lit(z).alias("z")))
    entities = spans.select("row", "start", "end", F.explode(marks).alias("e")).select("row", "start", "end", "e.*")
    known = entities.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    known = saved(known, "entities")
    beside = saved(entities.join(small_or_shuffled(known), "entity"), "repeated-entities")
    pairs = rows.join(small_or_shuffled(beside), "row").select("row", "entity", "n_e", "z", F.explode(_beside(near)).alias("term"))
    pairs = saved(pairs.distinct(), "terms-near")
    both = pairs.groupBy("entity", "n_e", "z", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= support)
    both = saved(both, "pairs")

    # One row of each text counts, and all its words are summed up before any meets the wanted ones, so that a word
    # which stands in most texts costs no more than one row of each task.
    same = rows.groupBy("row").agg(F.count("*").alias("same"))
    repeated = saved(same.where("same > 1"), "copies")
    total = docs.count() - (repeated.agg(F.sum(F.col("same") - 1)).first()[0] or 0)
    holds = spans.groupBy("row").agg(*[F.max((F.col("kind") == k).cast("int")).alias(k) for k in KINDS], F.lit(1).alias("any"))
    holds = saved(holds, "kinds-by-row")
    texts = rows.join(small_or_shuffled(repeated), "row", "left").join(small_or_shuffled(holds), "row", "left")
    texts = texts.select((1.0 / F.coalesce("same", F.lit(1))).alias("weight"), *[F.coalesce(k, F.lit(0)).alias(k) for k in LEVELS], F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    sums = texts.groupBy("term").agg(F.sum("weight").alias("n_t"), *[F.sum(F.col("weight") * F.col(k)).alias(k) for k in LEVELS])
    # Sums of weights like 1/3 are whole but for rounding.
    n_t = sums.select("term", F.round("n_t").alias("n_t"), *[F.round(k).alias(k) for k in LEVELS])
    wanted = both.select("term").distinct().withColumn("near", F.lit(True))
    n_t = saved(n_t.join(small_or_shuffled(saved(wanted, "wanted")), "term", "left").where(F.col("near") | (F.col("any") >= support)), "terms")

    n = F.lit(float(total))
    of_kind = holds.agg(*[F.sum(k).alias(k) for k in LEVELS]).first()

    def covered(n_te: Column, n_e: Column, z: Column) -> Column:
        low = F.greatest(n_te - z * F.sqrt(n_te), F.lit(0.0))
        return F.when(low > 0, F.log2(n * low / (F.col("n_t") * n_e)) / F.log2(F.greatest(n / n_e, F.lit(1.0 + 1e-9))))

    strong = both.join(n_t.select("term", "n_t"), "term").select("entity", "term", covered(F.col("n_te"), F.col("n_e"), F.col("z")).alias("share")).where(F.col("share") >= share)
    beside = pairs.join(small_or_shuffled(saved(strong, "revealing")), ["entity", "term"]).select("row", "term", "share")
    shares = [F.when(F.col(k) >= support, covered(F.col(k), F.lit(float(of_kind[k])), F.lit(z))) for k in LEVELS if of_kind[k]]
    if not shares:
        return beside.groupBy("row", "term").agg(F.max("share").alias("share"))
    general = n_t.where(_may_reveal(F.col("term"))).select("term", F.greatest(*shares, F.lit(0.0)).alias("share")).where(F.col("share") >= share)
    general = saved(general, "revealing-kinds")
    anywhere = rows.select("row", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).join(small_or_shuffled(general), "term").select("row", "term", "share")
    return beside.unionByName(anywhere).groupBy("row", "term").agg(F.max("share").alias("share"))


def all_spans(docs: DataFrame, *, near: int = 3, share: float = 0.8, support: int = 3, z: float = 2.0) -> DataFrame:
    """(row, kind, start, end, match, share) of the entities and of the terms that reveal them, written as a table."""
    base = saved(base_spans(docs), "base-spans")
    terms = saved(revealing_terms(docs, base, near=near, share=share, support=support, z=z), "terms-by-row")
    quoted = F.transform(F.array_sort(F.collect_list("term")), lambda t: F.regexp_replace(t, r"([^\p{L}\p{N}])", r"\\$1"))
    by_row = terms.groupBy("row").agg(F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}])")).alias("pattern"))
    by_row = saved(by_row, "patterns")
    rows = docs.select(_content(), "text").join(small_or_shuffled(by_row), "row")
    places = _located(rows.select("row", "text", "pattern"), F.lit("term"), F.col("pattern"))
    places = places.join(small_or_shuffled(terms.withColumnRenamed("term", "match")), ["row", "match"]).select("row", "kind", "start", "end", "match", "share")
    return saved(base.withColumn("share", F.lit(1.0)).unionByName(places), "spans")


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row: doc_id, counts by kind, base_sha256 and spans (all spans by start, then kind)."""
    place = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ORDER]
    listed = F.array_sort(F.collect_set(F.struct("start", place.alias("place"), "kind", "end")))
    by_row = spans.groupBy("row").agg(*counts, listed.alias("listed"))
    by_row = saved(by_row, "spans-by-row")
    base = F.filter("listed", lambda s: s["kind"] != "term")
    out = docs.select("doc_id", _content()).join(small_or_shuffled(by_row), "row", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(_digest(base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_digest(F.col("listed")), F.lit("")).alias("spans"),
        F.coalesce("n_term", F.lit(0)).cast("long").alias("n_term"),
    )


def detect(docs: DataFrame, **settings) -> DataFrame:
    return report(docs, all_spans(docs, **settings))


def sanitise(docs: DataFrame, *, wholly: float = 0.95, **settings) -> DataFrame:
    """The rows with every span replaced: entities by [KIND], generalised terms by [TERM], terms that reveal wholly by nothing.

    Overlapping spans are replaced as one, by the first one's kind. n_chars, where there is one, is counted anew.
    """
    spans = all_spans(docs, **settings)
    place = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    earlier = F.max("end").over(Window.partitionBy("row").orderBy("start", "place", "end").rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("place", place).withColumn("new", F.when(F.col("start") >= F.coalesce(earlier, F.lit(0)), 1).otherwise(0))
    marked = marked.withColumn("group", F.sum("new").over(Window.partitionBy("row").orderBy("start", "place", "end")))
    instead = F.when(F.col("kind") != "term", F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).when(F.col("share") >= wholly, F.lit("")).otherwise(F.lit("[TERM]"))
    merged = marked.groupBy("row", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(instead, F.struct("start", "place", "end")).alias("instead"))
    before = F.coalesce(F.lag("end").over(Window.partitionBy("row").orderBy("start")), F.lit(0))
    cuts = saved(merged.withColumn("from", before).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "from", "instead"))).alias("cuts")), "cuts")
    kept = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("doc")
    rows = docs.select(_content(), "text", kept).join(small_or_shuffled(cuts, 100_000), "row", "left")
    part = lambda c: F.concat(F.substring(F.col("text"), (c["from"] + 1).cast("int"), (c["start"] - c["from"]).cast("int")), c["instead"])
    rest = F.substring(F.col("text"), (F.element_at("cuts", -1)["end"] + 1).cast("int"), F.length("text"))
    clean = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform("cuts", part), ""), rest))
    out = rows.select("doc", clean.alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[new.get(c, F.col("doc.`" + c.replace("`", "``") + "`")).alias(c) for c in docs.columns])
