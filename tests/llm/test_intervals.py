"""The interval overlap join against brute force, over nulls, repeats, long sessions, ties and clashing names."""

import datetime
import random
import zlib
from collections import defaultdict

import pytest

from evidentia.llm import intervals

EPOCH = datetime.datetime(1970, 1, 1)
DAY, GAP = 86_400_000_000, 300_000_000
CLICKS = "click_id long, ts timestamp_ntz, client_id long, kind string, s int, e int, bucket int"
LINES = "sale_id long, shipped_at timestamp_ntz, us long, client_id long"


def at(us):
    return None if us is None else EPOCH + datetime.timedelta(microseconds=us)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(13)
    start = 19_700 * DAY
    clicks = [(1, start + k * 299_000_000, "view") for k in range(1_000)]  # one session over several days
    clicks += [(1, clicks[-1][1], "click"), (1, clicks[-1][1], "view")]  # open by a tie at its end
    clicks += [(2, start + DAY - 1, "click"), (2, start + DAY - 1 + GAP, "view"), (2, start + DAY + 2 * GAP, "view")]  # just and just not together
    clicks += [(3, -5, "view"), (3, 5, None), (3, -DAY - 1, "click")]  # before 1970
    clicks += [(None, start, "click"), (1, None, "click")]
    clicks += [(r.choice([4, 5]), start + r.randrange(40 * DAY), r.choice(["click", "view", None])) for _ in range(300)]
    clicks += clicks[-5:]
    sales, lines = [], []
    for i in range(250):
        begin = r.choice([None, -3, start - DAY, start + r.randrange(40 * DAY), start + r.randrange(40) * DAY])
        sales.append((i if i % 50 else None, r.choice([1, 2, 3, 4, 5, 6, None]), r.choice(["held", "open", None]), begin))
        lines += [(i, None if begin is None or r.random() < 0.2 else begin + r.randrange(-DAY, 20 * DAY)) for _ in range(r.randrange(4))]
    return clicks, sales + sales[7:9], lines + [(None, start + 30 * DAY), *lines[:5]]


def brute(clicks, sales, lines, slot):
    by_client, out = defaultdict(list), {}
    for c, us, kind in clicks:
        if c is not None and us is not None:
            by_client[c].append((us, kind == "click"))
    found = defaultdict(list)
    for c, all_ in by_client.items():
        all_.sort()
        groups = [[all_[0]]]
        for x in all_[1:]:
            if x[0] - groups[-1][-1][0] > GAP:
                groups.append([])
            groups[-1].append(x)
        for g in groups:
            found[c].append((g[0][0], g[-1][0], any(o for us, o in g if us == g[-1][0])))
    shipped = defaultdict(list)
    for i, us in lines:
        if i is not None and us is not None:
            shipped[i].append(us)
    for i, c, status, begin in sales:
        if c is None or begin is None:
            continue
        s, e = begin // slot, float("inf") if status == "held" else max([begin, *(shipped[i] if i is not None else [])]) // slot
        for first, last, open_ in found[c]:
            t, u = first // slot, float("inf") if open_ else last // slot
            if s > u or t > e:
                continue
            k = 3 * ((s > t) - (s < t) + 1) + (e > u) - (e < u) + 1
            name = ["overlaps", "finished_by", "contains", "starts", "equals", "started_by", "during", "finishes", "overlapped_by"][k]
            n, shared, crc = out.get((i, name), (0, None, 0))
            now = min(e, u) - max(s, t) + 1
            out[i, name] = (n + 1, shared if now == float("inf") else (shared or 0) + now, crc + zlib.crc32(str(first).encode()))
    return out


def tables(spark, rows):
    clicks, sales, lines = rows
    return (
        spark.createDataFrame([(i, c, status, at(us)) for i, c, status, us in sales], "sale_id long, client_id long, status string, sold_at timestamp_ntz").selectExpr("*", "true as open", "1 as horizon", "2 as n"),
        spark.createDataFrame([(i, at(us), 7, 8) for i, us in lines], LINES),
        spark.createDataFrame([(k, at(us), c, kind, 1, 2, 3) for k, (c, us, kind) in enumerate(clicks)], CLICKS),
    )


@pytest.mark.parametrize("bucket,slot,zone", [(8, DAY, "America/New_York"), (3, DAY // 5, "UTC"), (10_000, DAY, "UTC")])
def test_relations(spark, rows, bucket, slot, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = intervals.relate(*tables(spark, rows), bucket=bucket, slot_us=slot).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {(r.sale_id, r.relation): (r.n_pairs, r.overlap_slots, r.sessions_crc) for r in got} == brute(*rows, slot)
    assert len(got) == len(brute(*rows, slot))


def test_zoned_timestamps(spark, rows):
    sales, lines, clicks = tables(spark, rows)
    zoned = [sales.withColumn("sold_at", sales.sold_at.cast("timestamp")), lines.withColumn("shipped_at", lines.shipped_at.cast("timestamp")), clicks.withColumn("ts", clicks.ts.cast("timestamp"))]
    got = intervals.relate(*zoned).collect()
    assert {(r.sale_id, r.relation): (r.n_pairs, r.overlap_slots, r.sessions_crc) for r in got} == brute(*rows, DAY)


def test_nothing_is_broadcast(spark, rows):
    plan = intervals.relate(*tables(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_empty(spark, rows):
    sales, lines, clicks = tables(spark, rows)
    assert intervals.relate(sales, lines, clicks.limit(0)).count() == 0
    assert intervals.relate(sales.limit(0), lines, clicks).count() == 0
    assert intervals.relate(sales, lines.limit(0), clicks).count() > 0
