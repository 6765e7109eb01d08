"""Repairing editions page by page, with an append-only log whose entries are chained by digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG = "document_id, revision, previous_sha256, sha256, pages, reason".split(", ")


def joined(number: str, text: str) -> Column:
    """The text of an edition: its pages in order, a null page being empty."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(number, F.coalesce(text, F.lit("")).alias("t")))), lambda p: p["t"]), "\n\n")


def digests(pages: DataFrame) -> DataFrame:
    """(document_id, sha256) of editions given as pages (document_id, number, markdown)."""
    return pages.groupBy("document_id").agg(F.sha2(joined("number", "markdown"), 256).alias("sha256"))


def repaired(pages: DataFrame, redone: DataFrame) -> DataFrame:
    """pages (document_id, number, markdown, flagged) with flagged ones replaced by redone (document_id, number, markdown).

    A page that isn't flagged stays as it is, whatever was redone. A flagged page that wasn't redone stays too, flagged
    still. Of several redone texts of a page the least counts; a null one counts as not redone.
    """
    new = redone.where("markdown is not null").groupBy("document_id", "number").agg(F.min("markdown").alias("__new"))
    both = pages.join(new, ["document_id", "number"], "left").withColumn("__use", F.coalesce("flagged", F.lit(False)) & F.col("__new").isNotNull())
    text = F.when(F.col("__use"), F.col("__new")).otherwise(F.col("markdown"))
    return both.select("document_id", "number", text.alias("markdown"), (F.coalesce("flagged", F.lit(False)) & ~F.col("__use")).alias("flagged"), F.col("__use").alias("replaced"))


def next_revisions(log: DataFrame, before: DataFrame, after: DataFrame, reason: str) -> DataFrame:
    """Log entries (LOG) for the documents of which `after`, from `repaired`, replaced a page; nothing else gets one.

    before holds the pages that were repaired. The entry names the digest that it replaces and the pages that it redid,
    and is numbered after the document's last one.
    """
    changed = after.where("replaced").groupBy("document_id").agg(F.array_sort(F.collect_list("number")).alias("pages"))
    last = log.groupBy("document_id").agg(F.max("revision").alias("last"))
    rows = changed.join(digests(before).withColumnRenamed("sha256", "previous_sha256"), "document_id").join(digests(after), "document_id").join(last, "document_id", "left")
    return rows.select("document_id", (F.coalesce("last", F.lit(0)) + 1).cast("int").alias("revision"), "previous_sha256", "sha256", "pages", F.lit(reason).alias("reason"))


def chain_faults(log: DataFrame, editions: DataFrame) -> DataFrame:
    """(rule, entity_id) where the log (LOG) doesn't lead, link by link, to the editions (document_id, sha256) as they are.

    Rules: revisions count from 1 without a gap; each names the digest of the one before; none is empty or changes
    nothing; the last one's digest is the edition's. A document that was never revised has no entries and no fault.
    """
    order = Window.partitionBy("document_id").orderBy("revision", "sha256")
    e = log.withColumn("due", F.row_number().over(order)).withColumn("before", F.lag("sha256").over(order)).withColumn("following", F.lead("sha256").over(order))
    e = e.join(editions.select("document_id", F.col("sha256").alias("present"), F.lit(True).alias("known")), "document_id", "left")
    rules = {
        "revisions count up": F.col("revision") != F.col("due"),
        "names the one before": (F.col("due") > 1) & ~F.col("previous_sha256").eqNullSafe(F.col("before")),
        "changes something": F.col("previous_sha256").eqNullSafe(F.col("sha256")) | (F.coalesce(F.size("pages"), F.lit(0)) == 0),
        "leads to the edition": F.col("following").isNull() & ~F.col("sha256").eqNullSafe(F.col("present")),
    }
    found = F.filter(F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()]), lambda x: x.isNotNull())
    return e.select(F.explode(found).alias("rule"), F.concat_ws(":", F.col("document_id").cast("string"), F.col("revision").cast("string")).alias("entity_id"))
