"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds a posting (term, row, position) for each training word that occurs in the test set; other words can
never be part of a match. A row's end has a posting too, whose position is the row's number of words. For each test window the two rarest of its words, by their counts in the index, look up their
postings; positions less the word's offset in the window give starts, and starts on both lists are candidates. A
candidate is confirmed by comparing the whole window with the row's words.

Nulls and texts without words have no words and no hits. Repeated rows each get the same result. An item without words
has no windows. Empty tables give empty results or rows without hits. Further columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_hash, saved, small_or_shuffled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "\x00"  # the term of a row's end; no word has this character
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other letters stay as they are."""
    plain = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def test_windows(benchmark: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(window_id, terms) of the distinct windows, and (window_id, item_id)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, length))).alias("terms"))
    each = saved(each.select("item_id", "terms", F.sha2(F.array_join("terms", " "), 256).alias("window_id")), "windows")
    return each.groupBy("window_id").agg(F.first("terms").alias("terms")), each.select("window_id", "item_id").distinct()


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, doc_id, row, pos) of the given terms, written to the shared folder; pos counts from 0."""
    ended = F.concat(words(F.col("text")), F.array(F.lit(END)))
    each = docs.select("doc_id", row_hash("doc_id", "text").alias("row"), F.posexplode(ended).alias("pos", "term"))
    return saved(each.join(small_or_shuffled(terms), "term").select("term_id", "doc_id", "row", "pos"), "postings")


def _terms_of(windows: DataFrame) -> DataFrame:
    distinct = windows.select(F.explode(F.array_append("terms", F.lit(END))).alias("term")).distinct()
    if windows.isEmpty():
        distinct = windows.sparkSession.createDataFrame([(END,)], "term string")
    return saved(distinct.select("term", F.xxhash64("term").alias("term_id")), "terms")


def phrase_matches(docs: DataFrame, windows: DataFrame, index: DataFrame | None = None, *, anchors: int = 2) -> DataFrame:
    """(doc_id, row, found): found is array<struct<start, end, window_id>> of confirmed occurrences, by start."""
    index = build_index(docs, _terms_of(windows)) if index is None else index
    # One row a term of the test set; a common one, which most windows hold, is in no task's way if these are broadcast.
    counts = small_or_shuffled(saved(index.groupBy("term_id").agg(F.count("*").alias("n")), "counts"))
    # Windows go by short numbers, as many postings carry them; they are numbered in a written table, so that they stay.
    windows = saved(windows.select(F.monotonically_increasing_id().alias("window"), "window_id", "terms"), "numbered-windows")
    places = windows.select("window", F.posexplode("terms").alias("offset", "term"))
    places = places.select("window", "offset", F.xxhash64("term").alias("term_id")).join(counts, "term_id")
    complete = places.groupBy("window").agg(F.count("*").alias("known"), F.min("n").alias("least"))
    rank = F.row_number().over(Window.partitionBy("window").orderBy("n", "term_id", "offset"))
    sizes = windows.select("window", F.size("terms").alias("length"))
    lookups = places.withColumn("rank", rank).where(F.col("rank") <= anchors)
    lookups = lookups.join(complete, "window").join(sizes, "window").where(F.col("known") == F.col("length"))
    lookups = saved(lookups.select("term_id", "window", "offset", F.least("length", F.lit(anchors)).alias("need")), "lookups")
    starts = index.join(small_or_shuffled(lookups), "term_id").select("row", "window", "need", (F.col("pos") - F.col("offset")).alias("start"))
    starts = starts.where("start >= 0").groupBy("row", "window", "start", "need").agg(F.count("*").alias("n")).where("n >= need")
    starts = saved(starts.select("row", "window", "start"), "starts")
    # Only texts with a candidate are shuffled to their candidates; which ones have any is a list of numbers.
    some = small_or_shuffled(saved(starts.select("row").distinct(), "candidate-rows"))
    held = docs.select("doc_id", "text", row_hash("doc_id", "text").alias("row")).join(some, "row", "left_semi")
    per_row = starts.join(small_or_shuffled(windows), "window").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.size("terms")).alias("end"), "window_id", "terms"))).alias("candidates"))
    texts = held.join(per_row, "row")
    # The words are bound as a lambda's variable, so that they are made once for each row and not once for each candidate.
    confirmed = F.transform(F.array(words(F.col("text"))), lambda w: F.filter("candidates", lambda c: F.slice(w, c["start"] + 1, F.size(c["terms"])) == c["terms"]))[0]
    return texts.select("doc_id", "row", F.transform(confirmed, lambda c: F.struct(c["start"], c["end"], c["window_id"])).alias("found")).where(F.size("found") > 0)


def proximity_matches(docs: DataFrame, benchmark: DataFrame, *, terms: int = 4, span: int = 20) -> DataFrame:
    """(doc_id, item_id, n): places where the item's rarest distinct terms all start within `span` words of each other.

    Terms that the documents lack don't count. Items with fewer distinct terms need all of those they have; an item
    whose terms the documents lack altogether has no match.
    """
    items = saved(benchmark.select("item_id", F.explode(F.array_distinct(words(F.col("text")))).alias("term")), "item-terms")
    index = build_index(docs, _terms_of(items.select(F.array("term").alias("terms"))))
    counts = small_or_shuffled(saved(index.groupBy("term_id").agg(F.count("*").alias("n")), "counts"))
    ranked = items.withColumn("term_id", F.xxhash64("term")).join(counts, "term_id")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("n", "term_id"))).where(F.col("rank") <= terms)
    ranked = saved(ranked.withColumn("need", F.count("*").over(Window.partitionBy("item_id"))).select("item_id", "term_id", "need"), "rare-terms")
    near = Window.partitionBy("doc_id", "row", "item_id").orderBy("pos").rangeBetween(0, span - 1)
    placed = index.join(small_or_shuffled(ranked), "term_id").withColumn("together", F.size(F.collect_set("term_id").over(near)))
    return placed.where(F.col("together") == F.col("need")).groupBy("doc_id", "item_id").agg(F.count_distinct("pos").alias("n"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, length: int = 10) -> DataFrame:
    """Per row: doc_id, n_words, n_hit (words inside an occurrence of a window), n_items, items_sha256, contaminated."""
    windows, owners = test_windows(benchmark, length)
    windows = saved(windows, "distinct-windows")
    index = build_index(docs, _terms_of(windows))
    found = saved(phrase_matches(docs, windows, index), "found")
    step = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("found", step, lambda a, m: F.struct((a["n"] + F.greatest(F.lit(0), m["end"] - F.greatest(a["end"], m["start"]))).alias("n"), F.greatest(a["end"], m["end"]).alias("end")))["n"]
    hits = found.select("row", covered.alias("n_hit")).dropDuplicates(["row"])
    pairs = found.select("row", F.explode(F.array_distinct(F.transform("found", lambda m: m["window_id"]))).alias("window_id")).distinct()
    items = pairs.join(saved(owners, "owners"), "window_id").select("row", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    verdict = saved(hits.join(items, "row", "left"), "hits")
    rows = index.where(F.col("term_id") == F.xxhash64(F.lit(END))).select("doc_id", "row", F.col("pos").cast("long").alias("n_words"))
    out = rows.join(small_or_shuffled(verdict), "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
