"""Sharding by proportional stratified interleaving, in DataFrame operations only.

Rows of each source are put in a seeded random order; a row's fractional rank is its place there, plus an offset between
0 and 1 that the seed gives its source, over the source's rows. All rows, sorted by fractional rank, are cut into shards
of equal counts, so that each shard holds every source in the mixture's proportion, to within two rows or so, and sources
of few rows are spread over all shards. Places are found without sorting a source or the whole in one task: rows fall
into cells by seeded hash, and then by fractional rank; a place is the rows of earlier cells plus the rank in its own
cell, and the rows of earlier cells are summed up in blocks of cells.

Law: `rows`, the shards' counts are at most one apart. A null text has no bytes. A null source is a source of its own.
Repeated rows are ranked apart; which of equal rows comes first makes no difference. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_or_shuffled

CELL_ROWS, BLOCK = 20_000, 1_000  # rows of a cell on average, and cells of a block


def _placed(rows: DataFrame, by: list[str], cell: str, order: list, place: str) -> DataFrame:
    """rows with `place` from 0 in the order of (cell, order) within `by`."""
    counts = saved(rows.groupBy(*by, cell, F.floor(F.col(cell) / BLOCK).alias("block")).agg(F.count("*").alias("n")), "cells")
    earlier = lambda part, order: F.coalesce(F.sum("n").over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.groupBy(*by, "block").agg(F.sum("n").alias("n"))
    blocks = blocks.select(*by, "block", earlier(by, "block").alias("base"))
    before = counts.select(*by, cell, "block", earlier([*by, "block"], cell).alias("inside")).join(blocks, [*by, "block"])
    before = saved(before.select(*by, cell, (F.col("base") + F.col("inside")).alias("before")), "places")
    rank = F.row_number().over(Window.partitionBy(*by, cell).orderBy(*order)) - 1
    return rows.withColumn(place, rank).join(small_or_shuffled(before), [*by, cell]).withColumn(place, F.col(place) + F.col("before")).drop("before")


def shard(docs: DataFrame, *, shards: int = 40, seed: int = 7, overhead: int = 16) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot (from 0 within the shard), grown_shard (null under this law)."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("no_source"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = saved(rows.withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")), "sizes")
    total = rows.count()
    cells = max(64, -(-total // CELL_ROWS))
    by = ["source", "no_source"]
    rows = rows.withColumn("cell", F.pmod(F.shiftright("shuffle", 20), cells))
    sums = rows.groupBy(*by).agg(F.count("*").alias("in_source"))
    # A source's rows are spread over the cells by hash, so a source that holds most rows fills no cell more than others.
    rows = _placed(rows, by, "cell", ["shuffle", "doc_id"], "place").join(small_or_shuffled(saved(sums, "sources")), by)
    offset = F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 30)) / (1 << 30)
    rows = saved(rows.withColumn("rank", (F.col("place") + offset) / F.col("in_source")), "ranked")
    rows = rows.withColumn("cell", F.floor(F.col("rank") * cells)).withColumn("all", F.lit(0))
    rows = _placed(rows, ["all"], "cell", ["rank", "source", "no_source", "shuffle", "doc_id"], "position")
    number = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return rows.withColumn("shard", number).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("position") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
