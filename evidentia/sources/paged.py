"""Listings kept as page files: a batch source that plans pages and takes a date window, and a stream source with offsets.

A listing is a folder of pages, `page=<name>/<file>` as Spark's own writers lay them out; a page's JSON text has total,
next (the following page's name, null on the last) and results with id and published_at. The name of a page begins with
the month of its entries, so a window leaves pages out by name. Large listings are kept in packs instead,
`pages=<first name>+<how many>/<file>`: a file of one page's JSON text a line, each with its name as page, of one month
and in the order of names; a pack is never added to. Paths may be local ones or URIs of any store that
pyarrow's file systems open; nothing is read through local files.
"""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..session import stored

SCHEMA = "page string, total long, next string, id string, published_at date, document string, problem string"
NAME = re.compile(r"(?:page=(\d{4}-\d{2}(?:-[^/]+)?)|pages=(\d{4}-\d{2}(?:-[^/+]+)?)\+(\d+))/")
PACK = 200  # pages of a pack
BATCH = 10_000  # rows of a record batch

as_json = json.JSONEncoder(ensure_ascii=False, sort_keys=True).encode


class File(NamedTuple):
    name: str  # of its page, or of the first one
    path: str
    pages: int  # how many it may hold
    packed: bool


class Pages(InputPartition):
    def __init__(self, files: list[File]):
        self.files = files


def page_files(path: str) -> list[File]:
    """The files of a listing, by name; other files, and hidden ones, are no pages."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(base, recursive=True))
    named = ((NAME.search(f.path), f) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")
    return sorted(File(m[1] or m[2], f.path, int(m[3] or 1), m[2] is not None) for m, f in named if m)


def read_pages(path: str, file: File) -> Iterator:
    """The rows of a file's pages, as record batches; what is broken is named, not raised."""
    import pyarrow as pa
    from pyarrow import fs

    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.date32(), pa.string(), pa.string())
    schema = pa.schema([(field.split()[0], kind) for field, kind in zip(SCHEMA.split(", "), kinds)])
    store, _ = fs.FileSystem.from_uri(path)
    with store.open_input_stream(file.path) as f:
        content = f.read()
    rows = chain.from_iterable(page_rows(file, text) for text in (content.splitlines() if file.packed else [content]))
    while part := [*islice(rows, BATCH)]:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], schema=schema)


def page_rows(file: File, text: bytes) -> Iterator[tuple]:
    """The rows of a page: one without id for the page itself, and one for each entry."""
    name = file.name
    try:
        body = json.loads(text)
        name = body["page"] if file.packed else name
        total, following, results = body["total"], body.get("next"), body["results"]
        if isinstance(total, bool) or not isinstance(total, int) or not isinstance(results, list) or not isinstance(name, str):
            raise ValueError("no page")
    except (ValueError, KeyError, TypeError, AttributeError):
        yield name if isinstance(name, str) else file.name, None, None, None, None, None, "page is malformed"
        return
    yield name, total, following, None, None, None, None if results or following is None else "page is empty"
    for r in results:
        try:
            day = datetime.date.fromisoformat(r["published_at"])
            yield name, total, following, str(r["id"]), day, as_json(r), None
        except (ValueError, KeyError, TypeError):
            yield name, total, following, None, None, as_json(r), "entry is malformed"


class PagedSource(DataSource):
    """`spark.read.format("paged")` and `spark.readStream.format("paged")`; options: path, and max_pages (none).

    More pages than max_pages are an error: a listing that is cut would look complete.
    """

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PagedReader(self.options)

    def streamReader(self, schema):  # noqa: N802  Spark's name
        return PagedStream(self.options)


def _listed(options) -> list[File]:
    files, most = page_files(options["path"]), int(options.get("max_pages", 0))
    pages = sum(f.pages for f in files)
    if most and pages > most:
        raise ValueError(f"the listing has {pages} pages, over the limit of {most}")
    return files


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.path = options, options["path"]
        self.since, self.until = datetime.date.min, datetime.date.max

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  Spark's name
        """Bounds of published_at leave out pages; Spark still applies them to the rows, as a page's month may reach beyond."""
        for f in filters:
            if getattr(f, "attribute", None) == ("published_at",) and isinstance(getattr(f, "value", None), datetime.date):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.since = max(self.since, f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.until = min(self.until, f.value)
            yield f

    def partitions(self):
        low, high = (self.since.year, self.since.month), (self.until.year, self.until.month)
        return [Pages([f]) for f in _listed(self.options) if low <= tuple(map(int, f.name.split("-")[:2])) <= high]

    def read(self, partition):
        for file in partition.files:
            yield from read_pages(self.path, file)


class PagedStream(DataSourceStreamReader):
    """Each page once, in the order of names: an offset is the last page or pack taken, so a resumed stream goes on behind it."""

    def __init__(self, options):
        self.options, self.path = options, options["path"]

    def initialOffset(self):  # noqa: N802
        return {"after": ""}

    def latestOffset(self):  # noqa: N802
        return {"after": max((f.name for f in _listed(self.options)), default="")}

    def partitions(self, start, end):
        return [Pages([f]) for f in page_files(self.path) if start["after"] < f.name <= end["after"]]

    def read(self, partition):
        for file in partition.files:
            yield from read_pages(self.path, file)

    def commit(self, end):
        pass


def register(spark: SparkSession) -> None:
    """Make the format known, and let it see filters."""
    spark.dataSource.register(PagedSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_listing(entries: DataFrame, path: str, *, size: int = 500, packed: bool = False) -> None:
    """Write entries (id, published_at, ...) as a listing of pages of at most `size` entries of one month, or as packs of them."""
    place = F.row_number().over(Window.partitionBy("__month").orderBy("published_at", "id")) - 1
    rows = entries.withColumn("__month", F.date_format("published_at", "yyyy-MM")).withColumn("__n", place)
    # Months are few. A page's follower is the next of its month, or the first of the month after.
    months = rows.groupBy("__month").agg(F.ceil(F.count("*") / size).alias("__pages"), F.count("*").alias("__entries"))
    months = months.withColumn("__after", F.lead("__month").over(Window.orderBy("__month")))
    named = lambda month, n: F.concat_ws("-", month, F.lpad(n.cast("string"), 6, "0"))
    nth = F.floor(F.col("__n") / size)
    rows = rows.select(F.floor(nth / PACK).alias("__pack"), nth.alias("__nth"), "__n", "__month", F.struct(*[F.col(c) for c in entries.columns]).alias("r"))
    if packed:
        rows = rows.repartition("__month", "__pack")  # a pack is one file
    pages = rows.groupBy("__month", "__pack", "__nth").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "r"))), lambda x: x["r"]).alias("results"))
    pages = pages.join(F.broadcast(months), "__month")
    follower = F.when(F.col("__nth") + 1 < F.col("__pages"), named(F.col("__month"), F.col("__nth") + 1)).when(F.col("__after").isNotNull(), named(F.col("__after"), F.lit(0)))
    page = named(F.col("__month"), F.col("__nth"))
    whole = F.lit(entries.count()).alias("total")
    body = F.to_json(F.struct(*([page.alias("page")] if packed else []), whole, follower.alias("next"), "results"), {"ignoreNullFields": "false"}).alias("value")
    if packed:
        first = F.col("__pack") * PACK
        pack = F.concat_ws("+", named(F.col("__month"), first), F.least(F.lit(PACK), F.col("__pages") - first).cast("string"))
        pages.select(pack.alias("pages"), body).write.partitionBy("pages").text(path)
    else:
        pages.select(page.alias("page"), body).write.partitionBy("page").text(path)


def listing_faults(rows: DataFrame, since=None, until=None) -> DataFrame:
    """(rule, entity_id) of what is wrong with a listing's rows (SCHEMA), across all its pages.

    Rules: pages and entries are sound; all pages state one total, and as many entries came; no id comes twice; every page
    but the last leads to one that is there, and each page but the first is led to once; entries lie within the window.
    A listing read through a window has fewer entries than its total, so its rows are checked before a filter. Pages are
    few beside entries; they are stored, so that the rules on them don't read all rows again.
    """
    pages = stored(rows.where("id is null and document is null").select("page", "total", "next"), "listing-pages")
    entries = rows.where("id is not null")
    totals = pages.where("total is not null").groupBy("total").agg(F.count("*").alias("pages")).select(F.col("total").cast("string").alias("entity_id"), F.count("*").over(Window.partitionBy(F.lit(1))).alias("kinds"))
    came = entries.agg(F.count("*").alias("n"))
    stated = pages.agg(F.max("total").alias("total")).join(came, F.lit(True)).where("total <> n")
    led = pages.where("next is not null").groupBy("next").agg(F.count("*").alias("n"))
    names = pages.select("page").distinct()
    first = names.agg(F.min("page").alias("first"))
    unled = names.join(led, F.col("page") == F.col("next"), "left").join(first, F.lit(True)).where("(page = first) = (n is not null) or n > 1")
    outside = entries.where((F.col("published_at") < F.lit(since)) | (F.col("published_at") > F.lit(until))) if since is not None else entries.limit(0)
    parts = [
        rows.where("problem is not null").select(F.col("problem").alias("rule"), F.col("page").alias("entity_id")),
        totals.where("kinds > 1").select(F.lit("total drifts").alias("rule"), "entity_id"),
        stated.select(F.lit("entries came as stated").alias("rule"), F.concat_ws(" of ", F.col("n").cast("string"), F.col("total").cast("string")).alias("entity_id")),
        entries.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("entry comes twice").alias("rule"), F.col("id").alias("entity_id")),
        led.join(names, F.col("next") == F.col("page"), "left_anti").select(F.lit("next page is there").alias("rule"), F.col("next").alias("entity_id")),
        unled.select(F.lit("page is led to once").alias("rule"), F.col("page").alias("entity_id")),
        outside.select(F.lit("entry in the window").alias("rule"), F.col("id").alias("entity_id")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
