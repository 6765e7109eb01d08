"""A Spark data source for listings that are read page by page with a cursor."""

from __future__ import annotations

import json

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class CursorDataSource(DataSource):
    """`spark.read.format("cursor")` over page files {documents, cursor, numFound}; options: path, id_field (id), max_pages (100).

    Pages follow each other by cursor, from the file `start.json` to where the cursor no longer changes or all records
    came. A page met again, an empty page before the end, a total that isn't a number or drifts, a record without id or
    met twice, a sum that differs from the total, and more than max_pages pages are errors. Path may be a URI of any store
    that pyarrow's file systems open; `fetch` may be replaced to read from a service.
    """

    @classmethod
    def name(cls):
        return "cursor"

    def schema(self):
        return "id string, page int, document string"

    def reader(self, schema):
        return CursorReader(self.options)


class CursorReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.id_field, self.max_pages = options["path"], options.get("id_field", "id"), int(options.get("max_pages", 100))

    def fetch(self, cursor: str) -> dict:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.path)
        with store.open_input_stream(f"{base}/{cursor}.json") as f:
            return json.loads(f.read())

    def partitions(self):
        return [InputPartition(0)]  # each page names the next, so a listing is read in order

    def read(self, partition):
        cursor, seen, ids, total = "start", set(), set(), None
        for page in range(self.max_pages):
            seen.add(cursor)
            found = self.fetch(cursor)
            if isinstance(found["numFound"], bool) or not isinstance(found["numFound"], int):
                raise ValueError("the total is no number")
            if total not in (None, found["numFound"]):
                raise ValueError("the total drifts between pages")
            total = found["numFound"]
            for d in found["documents"]:
                if d.get(self.id_field) is None:
                    raise ValueError("a record has no id")
                if d[self.id_field] in ids:
                    raise ValueError("a record comes twice")
                ids.add(d[self.id_field])
                yield str(d[self.id_field]), page, json.dumps(d, ensure_ascii=False, sort_keys=True)
            following = found.get("cursor")
            if following not in (None, cursor) and following in seen:
                raise ValueError("the cursor loops")
            if len(ids) >= total or following in (None, cursor):
                break
            if not found["documents"]:
                raise ValueError("a page before the end is empty")
            cursor = following
        else:
            raise ValueError(f"more than {self.max_pages} pages")
        if len(ids) != total:
            raise ValueError(f"{len(ids)} of {total} records came")
