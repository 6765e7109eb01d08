"""A training-data pipeline of five stages: toxicity, near duplicates, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents. Nulls, empty tables and repeated
rows are treated as the operators say; of repeated rows one stays, as of any group of duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import bpe, decontaminate, near_copies, pii, toxicity
from evidentia.llm.common import packed, saved, small_or_shuffled, table, unpacked
from evidentia.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return unpacked(scored.where("predicted = 0"), docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that of the smallest id, or of none, with the least hash of id and text.

    Near copies share 0.8 of their 5-word shingles (Jaccard similarity), or are joined by others that do; SimHash tiles
    find them. A row counts by id and text: rows of one id, or of none, are apart unless their texts are near copies.
    """
    marked = packed(docs)
    rows = marked.select("row", "doc.doc_id", "doc.text")
    found = near_copies.near_copies(rows.select("row", "text"))
    found = saved(found.distinct().join(rows.select("row", "doc_id").distinct(), "row"), "near-copies")
    best = found.groupBy("component").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    best = saved(best.where("n > 1").select("component", F.col("best.row").alias("best")), "best")
    gone = saved(found.join(small_or_shuffled(best), "component").where("row <> best").select("row"), "gone")
    kept = marked.join(small_or_shuffled(gone), "row", "left_anti")
    again = saved(rows.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row"), "repeated-rows")
    if again.isEmpty():
        return unpacked(kept, docs)
    one = kept.join(small_or_shuffled(again), "row", "left_semi").dropDuplicates(["row"])
    return unpacked(kept.join(small_or_shuffled(again), "row", "left_anti").unionByName(one), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    windows, _ = decontaminate.test_windows(table(spark, sf_dir, "benchmark"), 10)
    found = saved(decontaminate.phrase_matches(docs, windows).select("row").distinct(), "contaminated")
    return unpacked(packed(docs).join(small_or_shuffled(found), "row", "left_anti"), docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are replaced in the texts."""
    return pii.sanitise(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and digests of ids and of the decoded bytes."""
    import public_tokenizers

    # Smaller tables than the operator's own: the executors' heaps have grown in the stages before.
    return bpe.encode_and_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, max_states=50_000, max_pieces=60_000)


STAGES = [("toxicity", drop_toxic), ("near duplicates", one_of_near_copies), ("decontamination", drop_contaminated), ("personal data", sanitise), ("tokens", tokenise)]

#: The models, components and merges of the stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
