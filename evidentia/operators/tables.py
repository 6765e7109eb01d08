"""Merging, differences, pages, hierarchies, products and digests of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def insert_only(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """target and those incoming rows whose key it lacks; a key that comes in twice keeps one row."""
    return target.unionByName(incoming.join(target, key, "left_anti").dropDuplicates([key]))


def merge_upsert(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, action): a generated row replaces only what it was generated from; edits are preserved.

    old has `value` and `generated` (what was last generated); a difference between them is an edit.
    """
    o = old.select(key, F.col(value).alias("old"), F.col("generated"))
    both = o.join(new.select(key, F.col(value).alias("new")), key, "full")
    edited = ~F.col("old").eqNullSafe(F.col("generated"))
    known = F.col("old").isNotNull() | F.col("generated").isNotNull()
    action = F.when(F.col("new").isNull(), "kept").when(~known, "inserted").when(edited, "preserved").when(F.col("old").eqNullSafe(F.col("new")), "unchanged").otherwise("written")
    both = both.withColumn("action", action)
    return both.select(key, F.when(F.col("action").isin("inserted", "written"), F.col("new")).otherwise(F.col("old")).alias(value), "action")


def union_first(archive: DataFrame, feed: DataFrame, key: str, day: str) -> DataFrame:
    """(key, day, origin, conflict): the archive's row wins; differing days are a conflict."""
    rows = archive.select(key, day, F.lit(0).alias("p")).unionByName(feed.select(key, day, F.lit(1).alias("p")))
    out = rows.groupBy(key).agg(F.min_by(day, F.struct("p", day)).alias(day), F.when(F.min("p") == 0, "archive").otherwise("feed").alias("origin"), (F.count_distinct(day) > 1).alias("conflict"))
    return out


def signature_diff(before: DataFrame, after: DataFrame, key: str, signature: str = "signature") -> DataFrame:
    """(key, change) of keys that are new, changed or gone; what is unchanged has no row."""
    b, a = before.select(key, F.col(signature).alias("was")), after.select(key, F.col(signature).alias("now"))
    both = b.join(a, key, "full")
    change = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("was") != F.col("now"), "changed")
    return both.select(key, change.alias("change")).where("change is not null")


def paginate(rows: DataFrame, page: int, size: int, *order: Column | str) -> DataFrame:
    """A page with its numbers: sizes are 20, 50 or 100, else 20; pages beyond the last show the last.

    Rows before the page are skipped by Spark's ordered limit; the whole is never ranked in one task.
    """
    size = size if size in (20, 50, 100) else 20
    total = rows.count()
    pages = max(1, -(-total // size))
    page = max(1, min(page, pages))
    shown = rows.orderBy(*order).offset((page - 1) * size).limit(size)
    return shown.withColumn("page", F.lit(page)).withColumn("pages", F.lit(pages)).withColumn("total", F.lit(total))


def envelope(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """A collection as (dataset, total, items): items in order as JSON; only for collections that are one document."""
    item = F.struct(*[F.col(c) for c in [*order, *[c for c in rows.columns if c not in order]]])
    return rows.agg(F.lit(name).alias("dataset"), F.count("*").alias("total"), F.to_json(F.array_sort(F.collect_list(item))).alias("items"))


def snapshot_digest(tables: dict[str, DataFrame], buckets: int = 256) -> DataFrame:
    """(dataset, total, digest): a digest of each table's rows, whatever their order.

    Row digests are gathered by their first byte and each bucket's sorted list is hashed; the table's digest is over the
    256 bucket digests, so no task holds a table's rows.
    """
    out = None
    for name, rows in tables.items():
        row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(rows.columns)]), 256)
        part = rows.select(row.alias("h")).groupBy(F.substring("h", 1, 2).alias("b")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("d"))
        part = part.agg(F.lit(name).alias("dataset"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("b", "d"))), ""), 256).alias("digest"))
        out = part if out is None else out.unionByName(part)
    return out


def tree_paths(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """(node_id, depth, path) of a forest (node_id, parent_id, title), roots first, by a recursive query."""
    return spark.sql(
        """WITH RECURSIVE walk (node_id, depth, path) AS (
             SELECT node_id, 0, title FROM {nodes} WHERE parent_id IS NULL
             UNION ALL SELECT n.node_id, w.depth + 1, concat(w.path, ' > ', n.title) FROM {nodes} n JOIN walk w ON n.parent_id = w.node_id)
           SELECT node_id, depth, path FROM walk""",
        nodes=nodes,
    )


def batches(rows: DataFrame, size: int, by: list[str], *order: str) -> DataFrame:
    """rows with batch, from 0, of `size` rows each within `by`."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size))


def integrity(children: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(rule, entity_id): child keys that no parent has, for each named rule (child, key, parent, key); null keys pass."""
    out = None
    for rule, (child, key, parent, parent_key) in children.items():
        missing = child.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("entity_id")).join(parent.select(F.col(parent_key).cast("string").alias("entity_id")), "entity_id", "left_anti").distinct()
        missing = missing.select(F.lit(rule).alias("rule"), "entity_id")
        out = missing if out is None else out.unionByName(missing)
    return out


def duplicates(rows: DataFrame, rule: str, *key: str) -> DataFrame:
    """(rule, entity_id) of keys with more than one row."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(rule).alias("rule"), F.concat_ws(":", *key).alias("entity_id"))


def violations(rows: DataFrame, rule: str, key: str, broken: Column) -> DataFrame:
    """(rule, entity_id) of rows for which `broken` holds."""
    return rows.where(broken).select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("entity_id"))


def assert_valid(found: DataFrame) -> None:
    """Raises on the first violations found."""
    some = found.limit(20).collect()
    if some:
        raise ValueError("; ".join(f"{r.rule}: {r.entity_id}" for r in some))


def exact_ids(requested: DataFrame, answered: DataFrame, key: str) -> DataFrame:
    """(rule, entity_id): ids that were not answered, answered twice, or never asked for."""
    n = answered.groupBy(key).agg(F.count("*").alias("n"))
    both = requested.select(key).distinct().withColumn("asked", F.lit(1)).join(n, key, "full")
    rule = F.when(F.col("asked").isNull(), "unasked").when(F.col("n").isNull(), "unanswered").when(F.col("n") > 1, "repeated")
    return both.select(rule.alias("rule"), F.col(key).cast("string").alias("entity_id")).where("rule is not null")
