"""Listings by pages with a pushed window, their faults, the stream over them, and products put in place by a rename."""

import datetime
import json
import threading

import pytest
from pyspark.sql import functions as F

from evidentia.sources import paged, product

DAY = datetime.date


@pytest.fixture
def listing(spark, tmp_path):
    paged.register(spark)
    rows = [(f"law{i}", DAY(2023, 1, 1) + datetime.timedelta(days=i), None if i % 5 else "ä\n") for i in range(100)]
    paged.write_listing(spark.createDataFrame(rows, "id string, published_at date, title string"), f"{tmp_path}/pages", size=12)
    return f"{tmp_path}/pages"


def faults(spark, path, *window):
    return sorted(map(tuple, paged.listing_faults(spark.read.format("paged").option("path", path).load(), *window).collect()))


def edit(path, name, change):
    from pathlib import Path

    (file,) = Path(path, f"page={name}").glob("*.txt")
    body = json.loads(file.read_text())
    change(body)
    file.write_text(json.dumps(body))
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()


def test_pages_and_window(spark, listing):
    df = spark.read.format("paged").option("path", listing).load()
    assert df.where("id is not null").count() == 100
    assert df.rdd.getNumPartitions() == len({r.page for r in df.select("page").collect()}) == 10
    window = df.where((F.col("published_at") >= DAY(2023, 2, 10)) & (F.col("published_at") < DAY(2023, 3, 5)) & F.col("id").isNotNull())
    assert sorted(r.id for r in window.collect()) == sorted(f"law{i}" for i in range(100) if DAY(2023, 2, 10) <= DAY(2023, 1, 1) + datetime.timedelta(days=i) < DAY(2023, 3, 5))
    assert window.rdd.getNumPartitions() == 6  # of the two months only
    assert json.loads(df.where("id = 'law5'").first().document)["title"] == "ä\n"
    assert faults(spark, listing) == []
    assert len(faults(spark, listing, DAY(2023, 1, 2), DAY(2023, 4, 8))) == 3
    with pytest.raises(Exception, match="over the limit"):
        spark.read.format("paged").option("path", listing).option("max_pages", 9).load().count()


def test_faults(spark, listing):
    edit(listing, "2023-01-000001", lambda b: b["results"].append({"id": "law0", "published_at": "2023-01-01"}))
    edit(listing, "2023-02-000000", lambda b: b.update(total=99))
    edit(listing, "2023-02-000001", lambda b: b.update(next="2023-09-000000"))
    edit(listing, "2023-03-000000", lambda b: b["results"][2].update(published_at="soon"))
    edit(listing, "2023-04-000000", lambda b: b.pop("total"))
    got = faults(spark, listing)
    assert ("entry comes twice", "law0") in got and ("total drifts", "99") in got and ("total drifts", "100") in got
    assert ("next page is there", "2023-09-000000") in got and ("page is led to once", "2023-02-000002") in got
    assert ("entry is malformed", "2023-03-000000") in got and ("page is malformed", "2023-04-000000") in got
    assert {r for r, _ in got} >= {"entries came as stated"}


def test_stream_gives_each_record_once(spark, listing, tmp_path):
    from pathlib import Path

    out, check, later = (str(tmp_path / x) for x in ("out", "check", "later"))
    held = sorted(Path(listing).glob("page=2023-0[34]*"))
    Path(later).mkdir()
    for folder in held:
        folder.rename(Path(later, folder.name))

    def run():
        stream = spark.readStream.format("paged").option("path", listing).load().where("id is not null").select("id", "page")
        q = stream.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out)
        q.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    first = run()
    assert 0 < len(first) < 100 and run() == first
    for folder in held:
        Path(later, folder.name).rename(folder)
    assert run() == sorted(f"law{i}" for i in range(100))


def test_product_is_never_seen_in_part(spark, tmp_path):
    path = f"{tmp_path}/product"
    versions = [spark.range(n).select("id", F.lit(n).alias("of"), F.when(F.col("id") % 2 == 0, "q\"ü\n").alias("text")).repartition(3) for n in (50, 80)]
    product.publish(versions[0], path, license="open")
    seen, stop, failed = set(), threading.Event(), []

    def watch():
        while not stop.is_set():
            try:
                items = json.loads(b"".join(product.body(path)))["items"]
                seen.add((len(items), len({x["of"] for x in items})))
            except Exception as e:  # noqa: BLE001  any failure of a reader fails the test
                failed.append(e)

    reader = threading.Thread(target=watch)
    reader.start()
    for df in (versions[1], versions[0], versions[1]):
        product.publish(df, path, license="open")
    stop.set()
    reader.join()
    assert not failed and seen <= {(50, 1), (80, 1)} and len(seen) == 2
    whole = json.loads(b"".join(product.body(path, size=7)))
    assert whole["license"] == "open" and sorted(x["id"] for x in whole["items"]) == list(range(80))
    assert product.current(spark, path, "id long, of long, text string").where("text like '%ü%'").count() == 40
    assert product.damage(path) == []


def test_failed_product_leaves_the_last(spark, tmp_path):
    from pathlib import Path

    path = f"{tmp_path}/product"
    product.publish(spark.range(3), path)
    before = product.manifest(path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|Division"):
        product.publish(spark.range(20).repartition(2).select(F.expr("raise_error('Division') as id")), path)
    assert product.manifest(path) == before
    assert [p.name for p in Path(path).iterdir() if p.is_dir()] == [before["version"]]
    product.publish(spark.range(0), path)
    assert json.loads(b"".join(product.body(path))) == {"items": []}
    assert product.current(spark, path, "id long").count() == 0
    with pytest.raises(Exception, match="never overwritten"):
        spark.range(1).write.format("product").mode("overwrite").option("path", path).save()


def test_packs_of_pages(spark, tmp_path):
    """Pages in packs read like pages of their own, in few files, by windows too, and count against max_pages as pages."""
    from pathlib import Path

    paged.register(spark)
    rows = spark.range(3_000).selectExpr("cast(id as string) as id", "date_add(date'2023-01-01', cast(id % 100 as int)) as published_at")
    path = f"{tmp_path}/packs"
    paged.write_listing(rows, path, size=4, packed=True)
    pages = sum(-(-n // 4) for n in (930, 840, 930, 300))
    assert len([*Path(path).glob("pages=*/*.txt")]) == 2 + 2 + 2 + 1
    df = spark.read.format("paged").option("path", path).option("max_pages", pages).load()
    assert df.select("page").distinct().count() == pages and df.where("id is not null").count() == 3_000 and faults(spark, path) == []
    window = df.where((F.col("published_at") >= DAY(2023, 2, 1)) & (F.col("published_at") < DAY(2023, 3, 1)) & F.col("id").isNotNull())
    assert window.count() == 840 and window.rdd.getNumPartitions() == 4  # the last day may be of the month after
    with pytest.raises(Exception, match="over the limit"):
        spark.read.format("paged").option("path", path).option("max_pages", pages - 1).load().count()


def test_pages_come_as_record_batches(tmp_path):
    """A pack is read in batches of columns, not row by row, broken pages and entries included."""
    import pyarrow as pa

    entries = [{"id": f"ä{i}", "published_at": "2023-01-05"} for i in range(paged.BATCH)] + [{"id": 1, "published_at": "soon"}]
    lines = [json.dumps({"page": f"2023-01-00000{k}", "total": 9, "next": None, "results": entries}) for k in range(2)] + ["{", '{"page": "2023-01-000003"}']
    file = tmp_path / "pages=2023-01-000000+4" / "part.txt"
    file.parent.mkdir()
    file.write_text("\n".join(lines))
    (found,) = paged.page_files(str(tmp_path))
    batches = [*paged.read_pages(str(tmp_path), found)]
    assert all(isinstance(b, pa.RecordBatch) and b.num_rows <= paged.BATCH for b in batches) and len(batches) == 3
    rows = pa.Table.from_batches(batches).to_pylist()
    assert len(rows) == 2 * (1 + len(entries)) + 2 and rows[1]["id"] == "ä0" and rows[1]["published_at"] == DAY(2023, 1, 5)
    assert [(r["page"], r["problem"]) for r in rows if r["problem"]] == [
        ("2023-01-000000", "entry is malformed"), ("2023-01-000001", "entry is malformed"), ("2023-01-000000", "page is malformed"), ("2023-01-000003", "page is malformed"),
    ]
