"""Quality rules with thresholds that adapt to each language and source, in DataFrame operations only.

Beside the fixed base rule, five measures of a row are held against limits of its (lang, source) group, which come from a
mergeable sketch: a measure falls into the bucket of its logarithm, and a bucket keeps its rows and sums. Sketches of
parts add up exactly, in any order, and quantiles err by at most `error` of their value. No cutoff of theirs is fixed.

Shares (symbols, repeated lines, repeated words) are counts over a length. The group's rate is that of its rows up to the
`bulk` quantile of the share, its language's counting as `prior` rows. A row goes if its count is beyond what that rate
gives in its length: the Poisson deviance n ln(n / m) - n + m from the expected m, which bounds the logarithm of the
chance of such a count, exceeds ln(1 / `chance`) times the dispersion. Counts that come in runs, as the words of a repeated
line do, have a greater dispersion: the mean squared deviation over m of rows up to the `calm` quantile, as the median of
the language's groups, as one group may be full of junk. So limits differ by group, by language and by a row's length.

Lengths (of words and lines) have fences at `spread` interquartile ranges beyond the quartiles on both sides, averaged
with the language's by rows, the language's counting as `prior` rows.

A null text has no words and fails the base rule. Null lang and null source are groups of their own. Equal rows have
equal results. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_or_shuffled

WORD, GAP = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"

#: Counts over a length, and means: what the rules measure.
SHARES = {"symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words")}
LENGTHS = {"word_length": ("word_chars", "n_words"), "line_length": ("n_words", "n_lines")}
MEASURES = SHARES | LENGTHS

#: The interquartile range is taken to be at least this share of the upper quartile, as the sketch rounds values.
LEAST_WIDTH = 0.05


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that are found twice or more, first included."""
    n = F.size(words)

    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.struct(F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("h"), i.alias("i")))

        def starts(s: Column) -> Column:
            same = lambda k, j: F.get(s, k)["h"] == F.get(s, j)["h"]
            twice = F.filter(F.sequence(F.lit(0), n - 3), lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)))
            return F.array_sort(F.transform(twice, lambda k: F.get(s, k)["i"]))

        covered = lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")))["n"]
        sort_and_count = F.transform(F.transform(F.array(F.array_sort(grams)), starts), covered)[0]
        hashes = F.transform(F.array(F.transform(grams, lambda g: g["h"])), lambda h: F.size(F.array_distinct(h)) == F.size(h))[0]
        return F.when(hashes, F.lit(0)).otherwise(sort_and_count)

    return F.when(n < 3, F.lit(0)).otherwise(F.transform(F.array(words), of)[0])


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source and the counts that the rules use."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    each = docs.select("doc_id", "lang", "source", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), lines.alias("lines"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"), F.length(F.regexp_replace(text, GAP, "")).alias("word_chars"))
    return each.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"), F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
    )


def sketch(rows: DataFrame, *, error: float) -> DataFrame:
    """(lang, source, measure, bucket, rows, n, d, squares): bucket k holds values n / d up to gamma^k, and is null for zero."""
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(a).cast("double").alias("n"), F.col(b).cast("double").alias("d")) for k, (a, b) in MEASURES.items()])
    each = rows.select("lang", "source", F.explode(pairs).alias("p")).select("lang", "source", "p.*").where("d > 0")
    bucket = F.when(F.col("n") > 0, F.ceil(F.log(F.col("n") / F.col("d")) / F.log(F.lit((1 + error) / (1 - error)))).cast("int"))
    sums = [F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum("d").alias("d"), F.sum(F.col("n") * F.col("n") / F.col("d")).alias("squares")]
    return each.groupBy("lang", "source", "measure", bucket.alias("bucket")).agg(*sums)


def _ranked(counts: DataFrame, by: list[str]) -> DataFrame:
    """counts with `before`, the rows in smaller buckets of the same `by` and measure, and `whole`, all of them."""
    group = Window.partitionBy(*by, "measure")
    upto = F.sum("rows").over(group.orderBy(F.col("bucket").asc_nulls_first()))
    return counts.withColumn("before", upto - F.col("rows")).withColumn("whole", F.sum("rows").over(group))


def _fences(counts: DataFrame, by: list[str], error: float, spread: float) -> DataFrame:
    """(by, measure, whole, low, high): fences beyond the quartiles."""
    gamma = (1 + error) / (1 - error)
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(gamma), F.col("bucket")) * (2 / (gamma + 1)))
    ranked = _ranked(counts, by).withColumn("value", value)
    quartile = lambda q: F.min(F.when(F.col("before") + F.col("rows") >= F.ceil(F.col("whole") * q), F.col("value")))
    q = ranked.groupBy(*by, "measure").agg(F.max("whole").cast("double").alias("whole"), quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    width = spread * F.greatest(F.col("q3") - F.col("q1"), LEAST_WIDTH * F.col("q3"))
    return q.select(*by, "measure", "whole", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))


def fences(counts: DataFrame, *, error: float, spread: float, prior: float) -> DataFrame:
    """(lang, source, measure, first, second): low and high fence of lengths, from a sketch."""
    counts = counts.where(F.col("measure").isin(list(LENGTHS)))
    common = _fences(counts.groupBy("lang", "measure", "bucket").agg(F.sum("rows").alias("rows")), ["lang"], error, spread)
    common = common.select(F.col("lang").alias("lang_"), F.col("measure").alias("measure_"), F.col("low").alias("low_"), F.col("high").alias("high_"))
    both = _fences(counts, ["lang", "source"], error, spread).join(common, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("measure_")))
    mean = lambda side: (F.col("whole") * F.col(side) + prior * F.col(f"{side}_")) / (F.col("whole") + prior)
    return both.select("lang", "source", "measure", mean("low").alias("first"), mean("high").alias("second"))


def rates(counts: DataFrame, *, bulk: float, calm: float, prior: float) -> DataFrame:
    """(lang, source, measure, first, second): rate and dispersion of shares, from a sketch."""
    ranked = _ranked(counts.where(F.col("measure").isin(list(SHARES))), ["lang", "source"])
    within = lambda q, c: F.sum(F.when(F.col("before") < F.ceil(F.col("whole") * q), F.col(c)))
    own = ranked.groupBy("lang", "source", "measure").agg(*[within(bulk, c).alias(c) for c in ("rows", "n", "d")], *[within(calm, c).alias(f"calm_{c}") for c in ("rows", "n", "d", "squares")])
    rate = (F.col("calm_n") + 0.5) / F.col("calm_d")
    own = own.withColumn("dispersion", (F.col("calm_squares") / rate - 2 * F.col("calm_n") + rate * F.col("calm_d")) / F.col("calm_rows"))
    common = own.groupBy("lang", "measure").agg(((F.sum("n") + 0.5) / F.sum("d")).alias("rate"), F.greatest(F.median("dispersion"), F.lit(1.0)).alias("second"))
    common = common.select(F.col("lang").alias("lang_"), F.col("measure").alias("measure_"), "rate", "second")
    both = own.join(common, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("measure_")))
    more = prior * F.col("d") / F.col("rows")  # the length of `prior` more rows
    return both.select("lang", "source", "measure", ((F.col("n") + more * F.col("rate")) / (F.col("d") + more)).alias("first"), "second")


def _beyond(measure: str, chance: float) -> Column:
    """Whether a row is beyond its group's limit of the measure, which the row has as a struct (first, second)."""
    limit = F.col(measure)
    a, b = (F.col(c).cast("double") for c in MEASURES[measure])
    if measure in LENGTHS:
        value = F.try_divide(a, b)
        return (value < limit["first"]) | (value > limit["second"])
    expected = limit["first"] * b
    deviance = a * F.log(a / expected) - a + expected
    return (a > expected) & (deviance > -math.log(chance) * limit["second"])


def judge(docs: DataFrame, *, error: float = 0.01, spread: float = 6.0, prior: float = 100.0, bulk: float = 0.95, calm: float = 0.9, chance: float = 1e-9) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, and failed, the measures beyond their limits."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = saved(measured(docs).withColumn("base_failed", base), "measured")
    counts = saved(sketch(rows.where(~F.col("base_failed")), error=error), "sketch")
    limits = fences(counts, error=error, spread=spread, prior=prior).unionByName(rates(counts, bulk=bulk, calm=calm, prior=prior))
    limits = limits.groupBy(F.col("lang").alias("lang_"), F.col("source").alias("source_")).pivot("measure", list(MEASURES)).agg(F.first(F.struct("first", "second")))
    held = rows.join(small_or_shuffled(saved(limits, "limits")), F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    beyond = F.array_compact(F.array(*[F.when(_beyond(k, chance), F.lit(k)) for k in MEASURES]))
    held = held.withColumn("failed", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(beyond))
    return held.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"), F.array_join("failed", ",").alias("failed"))
