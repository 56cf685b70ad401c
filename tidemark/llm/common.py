"""Shared folders, written intermediate tables and batch cutting for the operators here."""

from __future__ import annotations

import functools
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import local_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Most rows and bytes of a table that may be broadcast; each use counts them first.
BROADCAST_ROWS = 100_000


_SHIPPED: set[str] = set()
#: Intermediate tables of each application.
_WRITTEN: dict[str, list[str]] = {}


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the application's executors, once, as `--py-files` would."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    if context.applicationId in _SHIPPED or not (root / "tidemark").is_dir():
        return
    _SHIPPED.add(context.applicationId)
    name = f"{tempfile.mkdtemp(prefix='tidemark-')}/tidemark-{uuid.uuid4().hex}"
    context.addPyFile(shutil.make_archive(name, "zip", root, "tidemark"))


def ships_package(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage, its session first, that runs wherever its workers were started."""

    @functools.wraps(query)
    def shipped(spark: SparkSession, *rest) -> DataFrame:
        ship_package(spark)
        return query(spark, *rest)

    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below `spark.checkpoint.dir`, which all executors and the driver see.

    A local session may name none and gets a temporary folder; any other must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or local_folder(spark)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written once as a table in the shared folder and read back.

    Later plans read the table, so that a lost executor costs no recomputation. It stays until
    `remove_written`, as the result that is made of it may be read at any time.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, label)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remove_written(spark: SparkSession) -> int:
    """Removes the application's intermediate tables, once the results made of them are saved;
    returns how many there were."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder given as a path or URI, and the path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), folder
    return pyarrow.fs.FileSystem.from_uri(folder)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished steps now: its cleaner waits for
    the driver's garbage to be collected, Python's and then the JVM's."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has no more rows than that, counted here."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def by_bytes(
    batches: Iterable[pa.RecordBatch], column: str, most: int
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column has about `most` bytes in each, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first = total = 0
        for row, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(first, row - first)
                first, total = row, 0
            total += size
        if first < batch.num_rows:
            yield batch.slice(first)
