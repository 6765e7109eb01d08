"""Sessions, and the package on the executors."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def session(app: str = "evidentia", **conf: str) -> SparkSession:
    """A session with the settings that results rest on: UTC, and adaptive plans."""
    builder = SparkSession.builder.appName(app)
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(), "evidentia.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(spark.sparkContext.applicationId)


def shipped(f):
    """A query that ships the package before it runs."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str):
        ship(spark)
        return f(spark, sf_dir)

    return run


_OWN_FOLDERS: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a temporary one in local mode without it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="evidentia-")
        atexit.register(shutil.rmtree, _OWN_FOLDERS[app], ignore_errors=True)
    return _OWN_FOLDERS[app]


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a table of the work folder, read again: what is used twice is made once, and a lost executor costs its tasks."""
    path = f"{work_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A stored table of at most this many rows, and of this size as Spark states it, may be broadcast.
SMALL_ROWS, SMALL_BYTES = 200_000, 8 << 20


def small_or_shuffled(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Marks a stored table for broadcast if its bytes and its counted rows stay within bounds, else leaves it to a shuffle join."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= SMALL_BYTES and df.count() <= rows else df


#: Rows of an input that one task takes, and the least that make a task worth while.
TASK_ROWS, LEAST_ROWS = 200_000, 10_000


def task_count(table: DataFrame) -> int:
    """How many tasks of some TASK_ROWS rows a table is worth; its rows are counted."""
    rows = table.count()
    return max(1, -(-rows // TASK_ROWS), min(table.sparkSession.sparkContext.defaultParallelism, rows // LEAST_ROWS))


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """df dealt by keys to so many tasks; unchanged, and left to Spark's own shuffles, without a number.

    Adaptive plans join small partitions by bytes, up to one for each core, so a task's sorts and hash maps would grow with
    the input. What is joined, grouped or ordered by keys next needs no other shuffle.
    """
    return df if tasks is None else df.repartition(tasks, *keys)


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """An input table dealt by keys into partitions of some TASK_ROWS rows, so that more rows are more tasks, not larger ones."""
    return dealt(table, task_count(table), *keys)
