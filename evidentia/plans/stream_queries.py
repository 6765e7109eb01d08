"""Listings by pages, streams that resume, a queue with timers, and products put in place at once, over the input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import stored, work_folder
from ..sources import paged, product
from ..streaming import queue as Q
from ..streaming.state import run_available
from ..tables import load
from .registry import query

PAGE = 100
ENTRIES = f"""e AS (SELECT *, month || '-' || lpad((n // {PAGE})::VARCHAR, 6, '0') AS page FROM
    (SELECT o_orderkey::VARCHAR AS id, o_orderdate::DATE AS day, strftime(o_orderdate, '%Y-%m') AS month, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderdate::DATE, o_orderkey::VARCHAR) - 1 AS n FROM orders))"""


def _listing(spark, sf_dir) -> str:
    """Orders as a listing of packed pages in the work folder."""
    path = f"{work_folder(spark)}/listing-{uuid.uuid4().hex}"
    paged.register(spark)
    paged.write_listing(load(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("date").alias("published_at"), "o_orderstatus"), path, size=PAGE, packed=True)
    return path


@query(f"WITH {ENTRIES} SELECT id, page, day AS published_at FROM e WHERE day >= DATE '1995-03-10' AND day < DATE '1995-06-02'")
def listing_window(spark, sf_dir):
    """SRC-07, SRC-26: entries of a window, from the pages of its months only."""
    rows = spark.read.format("paged").option("path", _listing(spark, sf_dir)).load()
    return rows.where((F.col("published_at") >= F.lit("1995-03-10").cast("date")) & (F.col("published_at") < F.lit("1995-06-02").cast("date"))).select("id", "page", "published_at")


@query(f"""WITH {ENTRIES}, names AS (SELECT page, lead(page) OVER (ORDER BY page) AS next FROM (SELECT DISTINCT page FROM e)), p AS (SELECT page, next, (SELECT count(*) FROM e) + (page LIKE '1995-05-%')::INT AS total FROM names WHERE page NOT LIKE '1996-02-%'),
  r AS (SELECT id FROM e WHERE page NOT LIKE '1996-02-%' UNION ALL SELECT id FROM e WHERE page NOT LIKE '1996-02-%' AND id::BIGINT % 1009 = 0), led AS (SELECT next, count(*) AS n FROM p WHERE next IS NOT NULL GROUP BY 1)
  SELECT 'total drifts' AS rule, total::VARCHAR AS entity_id FROM p GROUP BY total HAVING (SELECT count(DISTINCT total) FROM p) > 1
  UNION ALL SELECT 'entries came as stated', (SELECT count(*) FROM r) || ' of ' || max(total) FROM p HAVING max(total) <> (SELECT count(*) FROM r)
  UNION ALL SELECT 'entry comes twice', id FROM r GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT 'next page is there', next FROM led ANTI JOIN p ON led.next = p.page
  UNION ALL SELECT 'page is led to once', page FROM p LEFT JOIN led ON led.next = page WHERE (page = (SELECT min(page) FROM p)) = (n IS NOT NULL) OR n > 1""")
def listing_faults(spark, sf_dir):
    """SRC-07, VAL-19, VAL-20: faults of a listing of which pages are missing, totals drift and entries are repeated."""
    rows = stored(spark.read.format("paged").option("path", _listing(spark, sf_dir)).load(), "listing-rows")
    rows = rows.where(~F.col("page").startswith("1996-02-")).withColumn("total", F.col("total") + F.col("page").startswith("1995-05-").cast("int"))
    return paged.listing_faults(rows.unionByName(rows.where("cast(id as long) % 1009 = 0")))


@query(f"WITH {ENTRIES} SELECT id, page, 1 AS times FROM e")
def listing_stream(spark, sf_dir):
    """SRC-18, SRC-25: entries of a listing read by a stream in two runs, of which the second goes on behind the first."""
    path, folder = _listing(spark, sf_dir), f"{work_folder(spark)}/listing-stream-{uuid.uuid4().hex}"

    def step(batch, epoch):
        batch.where("id is not null").select("id", "page").write.mode("overwrite").parquet(f"{folder}/rows/epoch={epoch}")

    for _ in range(2):
        run_available(spark.readStream.format("paged").option("path", path).load(), f"{folder}/checkpoint", step, "listing")
    return spark.read.schema("id string, page string").parquet(f"{folder}/rows").groupBy("id", "page").agg(F.count("*").cast("int").alias("times"))


@query("""WITH a AS (SELECT user_id AS task, epoch(date_trunc('second', ts))::BIGINT AS moment, CASE WHEN event_type = 'purchase' THEN 'done' WHEN event_type = 'signup' THEN 'fatal' ELSE 'failed' END AS outcome FROM events),
  t AS (SELECT task, count(*)::INT AS attempts, arg_max(outcome, moment * 10 + CASE outcome WHEN 'done' THEN 1 WHEN 'failed' THEN 2 ELSE 3 END) AS last, max(moment) AS last_at, bool_or(outcome = 'done') AS done FROM a GROUP BY task)
  SELECT task, attempts, last, last_at, done, CASE WHEN NOT done THEN last_at + 60 * (2 ** least(attempts, 40))::BIGINT END AS next_retry_at FROM t""")
def queue_stream(spark, sf_dir):
    """INC-02, INC-03, INC-04: the queue's state after a stream of all events in four slices of time, with backoff timers."""
    events = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    outcome = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "signup", "fatal").otherwise("failed")
    attempts = events.select(F.col("user_id").alias("task"), "ts", outcome.alias("outcome"))
    bounds = attempts.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    folder, width = f"{work_folder(spark)}/queue-{uuid.uuid4().hex}", (bounds.high - bounds.low) / 4
    for k in range(4):  # a slice is written after the one before, so that the stream takes them in order of time
        low, high = bounds.low + k * width, bounds.low + (k + 1) * width
        part = attempts.where((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high) if k < 3 else F.lit(True)))
        part.write.parquet(f"{folder}/in/slice={k}")
        source = spark.readStream.schema("task long, ts timestamp, outcome string").parquet(f"{folder}/in/*")
        Q.run_queue(source, f"{folder}/out", f"{folder}/checkpoint", late="1 day")
    return Q.latest(spark, f"{folder}/out").select("task", "attempts", "last", "last_at", "done", "next_retry_at")


@query("SELECT c_custkey AS id, c_name AS name, round(c_acctbal, 2)::DOUBLE AS balance, c_mktsegment AS segment FROM customer")
def product_rows(spark, sf_dir):
    """SNK-01, SNK-09: customers as a published product, read back after a second version took the first one's place."""
    path = f"{work_folder(spark)}/product-{uuid.uuid4().hex}"
    c = load(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.round("c_acctbal", 2).cast("double").alias("balance"), F.col("c_mktsegment").alias("segment"))
    product.publish(rows.where("balance > 0"), path, license="open")
    product.publish(rows, path, license="open")
    return product.current(spark, path, "id long, name string, balance double, segment string")
