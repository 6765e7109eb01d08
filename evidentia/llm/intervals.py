"""Interval overlap join: sales with the click sessions of the same client, by Allen's relations of their slots.

Sessions are found without a window over a client's clicks: clicks are first aggregated to cells as wide as the gap (two
clicks of one cell are never further apart, so no session ends inside one), cells are chained within a client's day, and
days within a client. A client has at most as many cells a day, and days, as time has, however many clicks it has.

Only slots are compared, so intervals of one client with equal slots are one shape, aggregated before any shuffle. Shapes
are replicated into buckets of some slots each, open ends clipped to the client's horizon (its latest start). Sides meet
on client and bucket, and a pair counts only in the bucket of the later start, which both sides reach if they overlap.
Sums for each shape and relation then go back to the sales of that shape. All joins are sort-merge joins by request:
nothing is broadcast, and adaptive execution may split a hot client.

Null client_id, sold_at or ts: the row is ignored. A line without sale_id or shipped_at has no effect. A sale ends at its
start if no line was shipped later; a null status or kind isn't open. Several clicks at a session's last ts: open if any is
of kind click. Repeated clicks change nothing; repeated lines neither. Sales of one sale_id (null included) are summed.
Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_US, SLOT_US, BUCKET_SLOTS = 300 * 10**6, 24 * 3600 * 10**6, 8
OPEN = 2**31 - 1  # the slot of an open end, later than any other


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column; one without a zone counts as UTC, whatever the session's zone is."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        seconds = (F.col(name) - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("decimal(18,6)")
        return (seconds * 1_000_000).cast("long")
    return F.unix_micros(name)


def cell(us: str, width: int) -> Column:
    return F.expr(f"({us} - pmod({us}, {width}L)) div {width}L")


def sessions(clicks: DataFrame, *, gap_us: int = GAP_US, day_us: int = SLOT_US) -> DataFrame:
    """(client_id, first_us, last_us, open) of each session: a click over `gap_us` after the previous one begins another."""
    rows = clicks.select("client_id", micros(clicks, "ts").alias("us"), F.coalesce(F.col("kind") == "click", F.lit(False)).alias("open"))
    rows = rows.where("client_id is not null and us is not null")
    cells = rows.groupBy("client_id", cell("us", gap_us).alias("cell")).agg(F.min("us").alias("first_us"), F.max(F.struct("us", "open")).alias("last"))
    cells = cells.withColumn("day", cell("first_us", day_us))
    in_day = Window.partitionBy("client_id", "day").orderBy("first_us")
    apart = lambda over: F.coalesce(F.col("first_us") - F.lag("last.us").over(over) > gap_us, F.lit(True))
    runs = cells.withColumn("begins", F.when(apart(in_day), F.col("first_us")))
    runs = runs.withColumn("run_us", F.last("begins", ignorenulls=True).over(in_day.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("client_id", "day", "run_us").agg(F.max("last").alias("last"))
    # A day's first run may go on from the last run of an earlier day: that run's start is the session's.
    days = runs.groupBy("client_id", "day").agg(F.min("run_us").alias("first_us"), F.max(F.struct("run_us", "last")).alias("end"))
    days = days.select("client_id", "day", "first_us", F.col("end.last").alias("last"), F.col("end.run_us").alias("run_us"))
    by_day = Window.partitionBy("client_id").orderBy("day")
    days = days.withColumn("apart", apart(by_day))
    carried = F.last(F.when(F.col("apart") | (F.col("run_us") > F.col("first_us")), F.col("run_us")), ignorenulls=True)
    days = days.select("client_id", "day", F.col("first_us").alias("run_us"), F.when(~F.col("apart"), carried.over(by_day.rowsBetween(Window.unboundedPreceding, -1))).alias("from_us"))
    joined = runs.join(days.where("from_us is not null").hint("merge"), ["client_id", "day", "run_us"], "left")
    out = joined.groupBy("client_id", F.coalesce("from_us", "run_us").alias("first_us")).agg(F.max("last").alias("last"))
    return out.select("client_id", "first_us", F.col("last.us").alias("last_us"), F.col("last.open").alias("open"))


def sale_intervals(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """(sale_id, client_id, first_us, last_us, open) of each sale, through its latest shipment."""
    rows = sales.select("sale_id", "client_id", micros(sales, "sold_at").alias("first_us"), F.coalesce(F.col("status") == "held", F.lit(False)).alias("open"))
    shipped = lines.select(F.col("sale_id").alias("line_of"), micros(lines, "shipped_at").alias("us")).where("line_of is not null and us is not null").groupBy("line_of").agg(F.max("us").alias("us"))
    rows = rows.where("client_id is not null and first_us is not null").join(shipped.hint("merge"), F.col("sale_id") == F.col("line_of"), "left")
    return rows.select("sale_id", "client_id", "first_us", F.greatest("first_us", "us").alias("last_us"), "open")


def in_slots(intervals: DataFrame, *, slot_us: int = SLOT_US) -> DataFrame:
    """first_us, last_us and open as inclusive slots (s, e)."""
    e = F.when(F.col("open"), F.lit(OPEN)).otherwise(cell("last_us", slot_us).cast("int"))
    kept = [c for c in intervals.columns if c not in ("last_us", "open")]
    return intervals.select(*kept, cell("first_us", slot_us).cast("int").alias("s"), e.alias("e"))


def relation() -> Column:
    """Allen's relation of the interval (s, e) to (t, u), of two that share a slot."""
    by_end = lambda before, same, after: F.when(F.col("e") < F.col("u"), before).when(F.col("e") == F.col("u"), same).otherwise(after)
    return (
        F.when(F.col("s") < F.col("t"), by_end("overlaps", "finished_by", "contains"))
        .when(F.col("s") == F.col("t"), by_end("starts", "equals", "started_by"))
        .otherwise(by_end("during", "finishes", "overlapped_by"))
    )


def shape_pairs(left: DataFrame, right: DataFrame, key: str, *, bucket: int = BUCKET_SLOTS) -> DataFrame:
    """Pairs that share a slot, of left (key, s, e, ...) and right (key, t, u, ...), each once. No other names may clash."""
    starts = left.select(key, "s").unionByName(right.select(key, F.col("t").alias("s")))
    horizon = starts.groupBy(key).agg(F.max("s").alias("horizon")).hint("merge")

    def replicated(side: DataFrame, start: str, end: str) -> DataFrame:
        clipped = F.greatest(F.col(start), F.least(F.col(end), F.col("horizon")))
        return side.join(horizon, key).withColumn("bucket", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(clipped / bucket)))).drop("horizon")

    both = replicated(left, "s", "e").join(replicated(right, "t", "u").hint("merge"), [key, "bucket"])
    return both.where((F.col("s") <= F.col("u")) & (F.col("t") <= F.col("e")) & (F.col("bucket") == F.floor(F.greatest("s", "t") / bucket))).drop("bucket")


def relate(sales: DataFrame, lines: DataFrame, clicks: DataFrame, *, slot_us: int = SLOT_US, gap_us: int = GAP_US, bucket: int = BUCKET_SLOTS) -> DataFrame:
    """Per sale and relation: n_pairs, overlap_slots (null if both are open) and sessions_crc."""
    crc = F.crc32(F.col("first_us").cast("string").cast("binary"))
    right = in_slots(sessions(clicks, gap_us=gap_us), slot_us=slot_us).groupBy("client_id", F.col("s").alias("t"), F.col("e").alias("u")).agg(F.count("*").alias("n"), F.sum(crc).alias("crc"))
    sale = in_slots(sale_intervals(sales, lines), slot_us=slot_us).select("sale_id", "client_id", "s", "e")
    pairs = shape_pairs(sale.select("client_id", "s", "e").distinct(), right, "client_id", bucket=bucket)
    shared = F.least("e", "u") - F.greatest("s", "t") + 1
    shared = F.when((F.col("e") < OPEN) | (F.col("u") < OPEN), shared.cast("long") * F.col("n"))
    sums = pairs.groupBy("client_id", "s", "e", relation().alias("relation")).agg(F.sum("n").alias("n_pairs"), F.sum(shared).alias("overlap_slots"), F.sum("crc").alias("sessions_crc"))
    totals = [F.sum(c).alias(c) for c in ("n_pairs", "overlap_slots", "sessions_crc")]
    return sale.join(sums.hint("merge"), ["client_id", "s", "e"]).groupBy("sale_id", "relation").agg(*totals)
