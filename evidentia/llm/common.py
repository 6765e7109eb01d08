"""Pieces shared by the operators: tables, the shared work folder, checked broadcasts and row keys."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A written side of at most this many rows and bytes of its files may be broadcast; a larger one is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 4 << 20

_OWN_FOLDERS: dict[str, str] = {}

#: Bytes of a batch that goes to Python at once. Spark's own bound is 10,000 rows, whatever their texts' lengths.
BATCH_BYTES, _BATCH_KEY = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

#: What operators keep in a Python worker between tasks, by operator; workers are shared, so the next operator drops it.
CACHES: dict[str, dict] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode, where none is configured."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="work-")
        atexit.register(shutil.rmtree, _OWN_FOLDERS[app], ignore_errors=True)
    return _OWN_FOLDERS[app]


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table of the shared folder and read it: cuts lineage and survives lost executors."""
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a saved table for broadcast if its counted rows and its bytes stay within bounds, else leaves it to a shuffle join."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= BROADCAST_BYTES and df.count() <= rows else df


def row_hash(id_col: str, text_col: str) -> Column:
    """Identity of a row by id and text. Rows equal in both have equal results, so they may share it."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc): each row's identity, and its columns as a struct, where no name of theirs can clash with another."""
    return docs.select(row_hash(id_col, text_col).alias("row"), F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("doc"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs from packed rows, in their order."""
    return rows.select(*[F.col(f"doc.{_quoted(c)}") for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0. A null id is held out: nothing is learned from it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose batches for Python are bounded by bytes; a lower bound that is set already stays."""
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_KEY, str(BATCH_BYTES + 1))) > BATCH_BYTES:
        conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df


def _give_back() -> None:
    """Return memory that earlier tasks of this worker have freed to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_batches(batches, text: str, limit: int = 2 << 20, keep: str = ""):
    """Cut record batches into slices of about `limit` bytes of text (always whole rows); drops others' caches first."""
    for name, cache in CACHES.items():
        if name != keep:
            cache.clear()
    _give_back()
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows == 0:
            continue
        import numpy as np
        import pyarrow.compute as pc

        ends = np.cumsum(pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            base = int(ends[stop - 1])
            start = stop
