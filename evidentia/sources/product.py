"""Products as JSON that readers never see in part: a writer whose commit puts one manifest in place by a rename.

A version's rows are written by partition, as the text of items, into files of its own; the manifest names them with
their rows, bytes and digests. Until the rename, readers have the version before, whose files stay.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

MANIFEST = "current.json"


@dataclass
class Part(WriterCommitMessage):
    name: str
    partition: int
    rows: int
    bytes: int
    sha256: str


class ProductSource(DataSource):
    """`df.write.format("product").mode("append").option("path", folder).save()`; further options are the body's metadata.

    Path may be local or a URI of any store that pyarrow's file systems open. Append means a further version here; earlier
    ones stay until they are removed by hand. A task that fails or is tried again leaves files that no manifest names.
    """

    @classmethod
    def name(cls):
        return "product"

    def writer(self, schema, overwrite):
        return ProductWriter(self.options, overwrite)


class ProductWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        if overwrite:
            raise ValueError("a product's versions are added, never overwritten: use mode append")
        self.path, self.version = options["path"], uuid.uuid4().hex
        self.metadata = {k: v for k, v in options.items() if k != "path"}

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> Part:
        """One partition's items, joined by commas, written as they come."""
        from pyspark import TaskContext

        store, base = self._store()
        partition = TaskContext.get().partitionId()
        folder = f"{base}/{self.version}"
        store.create_dir(folder, recursive=True)
        name, n, size, digest = f"{partition:06}-{uuid.uuid4().hex}.items", 0, 0, hashlib.sha256()
        with store.open_output_stream(f"{folder}/{name}") as f:
            for row in iterator:
                item = ((",\n" if n else "") + json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str)).encode()
                f.write(item)
                digest.update(item)
                n, size = n + 1, size + len(item)
        return Part(name, partition, n, size, digest.hexdigest())

    def commit(self, messages: list[Part | None]) -> None:
        """Name the parts of all partitions, and only now show the version to readers."""
        store, base = self._store()
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        body = {"version": self.version, "metadata": self.metadata, "rows": sum(m.rows for m in parts), "parts": [vars(m) for m in parts if m.rows]}
        waiting = f"{base}/{self.version}.manifest"
        store.create_dir(base, recursive=True)
        with store.open_output_stream(waiting) as f:
            f.write(json.dumps(body).encode())
        store.move(waiting, f"{base}/{MANIFEST}")

    def abort(self, messages: list[Part | None]) -> None:
        """Remove what the tasks that did finish have written; the version before stays in place."""
        from pyarrow import fs

        store, base = self._store()
        folder = f"{base}/{self.version}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ProductSource)


def publish(df: DataFrame, path: str, **metadata: str) -> None:
    """Write df as a product's next version."""
    register(df.sparkSession)
    df.write.format("product").mode("append").option("path", path).options(**metadata).save()


def manifest(path: str) -> dict:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())


def body(path: str, size: int = 1 << 16) -> Iterator[bytes]:
    """The JSON text of a product's present version, {metadata..., "items": [...]}, in pieces of bounded size."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    now = manifest(path)
    head = json.dumps(now["metadata"], ensure_ascii=False)[:-1]
    yield (head + (", " if now["metadata"] else "") + '"items": [\n').encode()
    for k, part in enumerate(now["parts"]):
        if k:
            yield b",\n"
        with store.open_input_stream(f"{base}/{now['version']}/{part['name']}") as f:
            while piece := f.read(size):
                yield piece
    yield b"\n]}\n"


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a product's present version; later versions don't change what was begun."""
    from pyspark.sql import functions as F

    now = manifest(path)
    files = [f"{path}/{now['version']}/{part['name']}" for part in now["parts"]]
    if not files:
        return spark.createDataFrame([], schema)
    lines = spark.read.text(files).where("value <> ''").select(F.from_json(F.regexp_replace("value", ",$", ""), schema).alias("r"))
    return lines.select("r.*")


def damage(path: str) -> list[str]:
    """Names of the present version's parts that aren't as the manifest says."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    now, bad = manifest(path), []
    for part in now["parts"]:
        digest = hashlib.sha256()
        file = f"{base}/{now['version']}/{part['name']}"
        if store.get_file_info(file).type == fs.FileType.File:
            with store.open_input_stream(file) as f:
                while piece := f.read(1 << 16):
                    digest.update(piece)
        if digest.hexdigest() != part["sha256"]:
            bad.append(part["name"])
    return bad
