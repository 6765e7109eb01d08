"""BM25 retrieval by joins on an inverted index, candidate sets, and near-equal pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrow import list_rows, packed
from ..functions.domain import in_window
from ..session import small_or_shuffled, spread, stored


WHOLE = "\x00"  # the term of a document as such, which stands in its postings once; no term has this character


def postings(docs: DataFrame, id_col: str, text: Column, terms=T.terms, wanted: DataFrame | None = None) -> DataFrame:
    """(id, term, tf, length) of each document, and one row with the term WHOLE, for documents without terms too.

    A document's length is taken before its terms are exploded, so no window over documents is needed. With `wanted`
    (term), only postings of those terms are kept; lengths still count all terms.
    """
    listed = docs.select(F.col(id_col).alias("id"), terms(text).alias("terms"))
    each = listed.select("id", F.size("terms").alias("length"), F.explode(F.array_append("terms", F.lit(WHOLE))).alias("term"))
    if wanted is not None:
        listed = stored(wanted.union(wanted.sparkSession.range(1).select(F.lit(WHOLE).alias("term"))), "wanted")
        each = each.join(small_or_shuffled(listed), "term", "left_semi")
    return each.groupBy("id", "length", "term").agg(F.count("*").alias("tf")).select("id", "term", "tf", "length")


def weights(index: DataFrame, n_docs: int, mean_length: float) -> DataFrame:
    """(id, term, weight): each posting's BM25 share, k1 = 1.5, b = 0.75; the mean length is at least 1.

    n_docs counts documents without terms too, and mean_length is over all of them.
    """
    mean = max(1.0, mean_length)
    df = index.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.ln(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * 2.5 / (F.col("tf") + 1.5 * (0.25 + 0.75 * F.col("length") / mean))
    return index.join(small_or_shuffled(stored(df, "df")), "term").select("id", "term", weight.alias("weight"))


def query_terms(queries: DataFrame, id_col: str, text: Column, terms=T.terms) -> DataFrame:
    """(query_id, term): a query's terms count once each."""
    return queries.select(F.col(id_col).alias("query_id"), F.explode(F.array_distinct(terms(text))).alias("term"))


def telling_terms(asked: DataFrame, most: int) -> DataFrame:
    """Rows of asked (id, term) whose term has at most `most` rows, to be joined with many texts' terms: broadcast if few.

    Texts' side is hot on some terms, so it must not be shuffled by them.
    """
    few = asked.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") <= most)
    return small_or_shuffled(stored(asked.join(few, "term", "left_semi"), "telling"))


def scores(asked: DataFrame, index: DataFrame) -> DataFrame:
    """(query_id, id, score) of all documents that share a term with a query, from query_terms (a stored table) and weights.

    The side that is small is broadcast, as terms are hot and must not be shuffled by. The other is dealt by its own id, so
    that what is summed, many times its rows, is not shuffled.
    """
    few = small_or_shuffled(asked)
    if few is not asked:
        pairs = few.join(spread(index, "id"), "term")
    else:
        index = stored(index, "weights")
        few = small_or_shuffled(index)
        pairs = (spread(asked, "query_id") if few is not index else asked).join(few, "term")
    return pairs.groupBy("query_id", "id").agg(F.round(F.sum("weight"), 6).alias("score")).where("score > 0")


def rank(queries: DataFrame, query_id: str, docs: DataFrame, doc_id: str, text: str = "text", terms=T.terms) -> DataFrame:
    """(query_id, id, score) of queries against documents; only terms that both have are written, if one of both has few."""
    asked = query_terms(queries, query_id, F.col(text), terms)
    if queries.count() < docs.count():
        asked = stored(asked, "asked")
        index = stored(postings(docs, doc_id, F.col(text), terms, asked.select("term").distinct()), "index")  # the texts are read once
    else:
        index = stored(postings(docs, doc_id, F.col(text), terms), "index")
        known = stored(index.select("term").distinct(), "known")
        few = small_or_shuffled(known)
        asked = stored(asked.join(few, "term", "left_semi").select(*asked.columns) if few is not known else asked, "asked")
    counted = index.where(F.col("term") == WHOLE).agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("n"), F.sum(F.col("length") * F.col("tf")).alias("length")).first()
    return scores(asked, weights(index.where(F.col("term") != WHOLE), counted.n, (counted.length or 0) / max(1, counted.n)))


def top(ranked: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best of each group by score, then id, with their rank from 1."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return ranked.withColumn("rank", rank).where(F.col("rank") <= k)


def eligible_only(pairs: DataFrame, laws: DataFrame, criteria: DataFrame, programs: DataFrame) -> DataFrame:
    """Those rows of pairs (law_id, criterion_id, ...) whose law falls into the window of the criterion's programme.

    Neither law, criterion nor programme may be rejected. Pairs that exist are looked up, so the product of laws and
    criteria is never made; programmes are few (parties times elections) and are broadcast.
    """
    p = programs.where("review <> 'rejected'").select("program_id", "period_start", "period_end")
    c = criteria.where("review <> 'rejected'").select("criterion_id", "program_id").join(F.broadcast(p), "program_id")
    v = laws.where("review <> 'rejected'").select("law_id", F.col("published_at").alias("__day"))
    rows = pairs.join(v, "law_id").join(c, "criterion_id").where(in_window(F.col("__day"), F.col("period_start"), F.col("period_end")))
    return rows.select(*pairs.columns)


def candidates(laws: DataFrame, criteria: DataFrame, *, whole: int = 12, per_window: int = 2, reverse: int = 3, width: int = 8000, stride: int = 6000) -> DataFrame:
    """(law_id, criterion_id): the union of three rankings, each cut to its best; what is eligible is looked up afterwards.

    A law's text (law_id, title, text) asks the index of criteria (criterion_id, text), and so does each window of it with
    the title before; each criterion asks the index of laws.
    """
    titled = laws.select("law_id", F.concat_ws(" ", "title", "text").alias("text"), "title", F.col("text").alias("body"))
    parts = titled.select("law_id", "title", F.explode(T.text_windows(F.col("body"), width, stride)).alias("w"))
    parts = parts.select("law_id", F.col("w.offset").alias("offset"), F.concat_ws(" ", "title", "w.part").alias("text"))
    by_law = top(rank(titled, "law_id", criteria, "criterion_id"), whole, "query_id").select(F.col("query_id").alias("law_id"), F.col("id").alias("criterion_id"))
    keyed = parts.select(F.struct("law_id", "offset").alias("window"), "text")
    by_window = top(rank(keyed, "window", criteria, "criterion_id"), per_window, "query_id").select(F.col("query_id.law_id").alias("law_id"), F.col("id").alias("criterion_id"))
    by_criterion = top(rank(criteria, "criterion_id", titled, "law_id"), reverse, "query_id").select(F.col("id").alias("law_id"), F.col("query_id").alias("criterion_id"))
    return by_law.union(by_window).union(by_criterion).distinct()


def numbers(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\d+(?:[.,]\d+)?"), F.lit(0))))


def equal_pairs(items: DataFrame, id_col: str, text: Column, by: list[str], index_scores: DataFrame, *, neighbours: int = 7, share: float = 0.25) -> DataFrame:
    """(left_id, right_id, jaccard) of near-equal items: among the first `neighbours` by score, equal in `by` and numbers."""
    near = top(index_scores, neighbours, "query_id").where("query_id <> id").select(F.least("query_id", "id").alias("left_id"), F.greatest("query_id", "id").alias("right_id")).distinct()
    side = items.select(F.col(id_col).alias("id"), *by, T.terms(text).alias("terms"), numbers(text).alias("numbers"))
    left = side.select(*[F.col(c).alias(f"left_{c}") for c in side.columns])
    right = side.select(*[F.col(c).alias(f"right_{c}") for c in side.columns])
    both = near.join(left, "left_id").join(right, "right_id")
    for c in [*by, "numbers"]:
        both = both.where(F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")))
    jaccard = F.size(F.array_intersect("left_terms", "right_terms")) / F.greatest(F.lit(1), F.size(F.array_union("left_terms", "right_terms")))
    return both.select("left_id", "right_id", F.round(jaccard, 6).alias("jaccard")).where(F.col("jaccard") >= share)


def chosen(batches, budget: int, reach: int):
    """(doc_id, ordinal) of what is taken of each document in Arrow batches (doc_id, parts, order), see `budget_context`."""
    for doc, (ordinals, lengths), (ranking,) in list_rows(batches, "doc_id", parts=("ordinal", "length"), order=("ordinal",)):
        length = dict(zip(ordinals, lengths))
        if sum(length.values()) <= budget:
            taken = set(length)
        else:
            taken, used = set(), 0
            for r in ranking:
                for o in range(r - reach, r + reach + 1):
                    if o in length and o not in taken and used + length[o] <= budget:
                        taken.add(o)
                        used += length[o]
        for o in sorted(taken):
            yield doc, o


def budget_context(passages: DataFrame, ranked: DataFrame, *, budget: int, reach: int) -> DataFrame:
    """(doc_id, ordinal): passages of a document within a budget of characters, best-ranked first, with neighbours.

    passages (doc_id, ordinal, length); ranked (doc_id, ordinal, position): a passage that no longer fits is left out
    while later ones may still fit, so the choice is sequential within a document. Python holds one document at a time.
    """
    lists = passages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "length"))).alias("parts"))
    order = ranked.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("position", "ordinal"))).alias("order"))

    def choose(batches):
        import pyarrow as pa

        return packed(chosen(batches, budget, reach), ["doc_id", "ordinal"], [pa.int64(), pa.int32()])

    return lists.join(order, "doc_id", "left").mapInArrow(choose, "doc_id long, ordinal int")


def anchored(quotes: DataFrame, keys: list[str], docs: DataFrame, doc_id: str) -> DataFrame:
    """(keys, doc_id, quote, source, status) of quotes (keys, quote) and docs (doc_id, source) that hold them, white space aside.

    A quote's inner words stand in such a document as words of their own, so the rarest of them, by postings of quoted
    words, leads to all candidates; only these are searched. Quotes of fewer than three words have no inner word.
    """
    words = lambda c: F.split(T.collapsed(F.col(c)), " ")
    inner = quotes.select(*keys, "quote", words("quote").alias("words")).where(F.size("words") >= 3)
    inner = inner.select(*keys, "quote", F.explode(F.array_distinct(F.slice("words", 2, F.size("words") - 2))).alias("term"))
    postings = docs.select(doc_id, F.explode(F.array_distinct(words("source"))).alias("term")).join(inner.select("term").distinct(), "term")
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    rarest = inner.join(counts, "term", "left").groupBy(*keys, "quote").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "term")).getField("term").alias("term"))
    found = postings.join(rarest, "term").join(docs, doc_id).where(F.contains(T.collapsed(F.col("source")), T.collapsed(F.col("quote"))))
    return found.select(*keys, doc_id, "quote", "source", T.quote_status(F.col("quote"), F.col("source")).alias("status"))
