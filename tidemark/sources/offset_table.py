"""Committed offsets as an append-only table: one row per topic partition and commit."""

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.offsets import END, committed_offsets, local_offsets


def read_state(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(n.OFFSET_STATE_DDL).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], n.OFFSET_STATE_DDL).limit(0)


def find_offsets(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Last committed offsets of one topic; no rows if it has none."""
    return committed_offsets(read_state(spark, path), topic)


class CommitConflict(RuntimeError):
    """Another run is at this batch, or has committed it."""


# A claim older than this belongs to a run that was lost; the next one takes it over.
LOST_AFTER_SECONDS = 3 * 3600


def _claim_file(path: str, topic: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/_claims/{topic}/{batch_id}"  # readers of the table pass it over


@contextmanager
def claimed(
    spark: SparkSession,
    path: str,
    topic: str,
    batch_id: int,
    lost_after: float = LOST_AFTER_SECONDS,
) -> Iterator[None]:
    """Holds a batch for one run, from before its stores are written until it is committed.

    A claim is a file that only one run can create. It stays once the batch is committed, so
    that a second run planned from the same offsets raises `CommitConflict` before it stores
    anything. A run that fails gives its claim up; that of one that vanished is taken over
    after `lost_after` seconds, if the batch was not committed.
    """
    context = spark.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(_claim_file(path, topic, batch_id))
    files = file.getFileSystem(context._jsc.hadoopConfiguration())

    def take() -> bool:
        try:
            files.create(file, False).close()
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    if not take():
        committed = find_offsets(spark, path, topic).agg(F.max("batch_id")).first()[0]
        if committed is not None and committed >= batch_id:
            raise CommitConflict(f"{topic}: batch {batch_id} is committed already")
        age = time.time() - files.getFileStatus(file).getModificationTime() / 1000
        if age < lost_after:
            raise CommitConflict(f"{topic}: another run is at batch {batch_id}")
        files.delete(file, False)
        if not take():
            raise CommitConflict(f"{topic}: another run is at batch {batch_id}")
    try:
        yield
    except BaseException:
        files.delete(file, False)
        raise


# Files of commits that are kept for each topic. Every commit holds the offsets of all
# partitions, so the last one would do; the others are there to look back at.
KEPT_COMMITS = 96


def commit_offsets(
    spark: SparkSession, plan: list[Row], path: str, batch_id: int, known: Sequence[Row] = ()
) -> None:
    """End offsets of a plan as the latest commit, with the `known` offsets of the
    partitions it leaves alone; a repeated commit changes nothing.

    With `known`, the last commits suffice, and older files are removed, so that reading
    the offsets opens no more files after years of runs.
    """
    planned = {(row[n.TOPIC], row[n.PARTITION]) for row in plan}
    rest = [row for row in known if (row[n.TOPIC], row[n.PARTITION]) not in planned]
    rows = local_offsets(spark, plan, END).unionByName(local_offsets(spark, rest))
    rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).coalesce(1)
    rows.write.mode("append").partitionBy(n.TOPIC).parquet(path)
    if known:
        for topic in {row[n.TOPIC] for row in plan}:
            _remove_old(spark, path, topic, batch_id)


def _remove_old(spark: SparkSession, path: str, topic: str, batch_id: int) -> None:
    """Remove files that hold only commits older than the `KEPT_COMMITS` last batches."""
    state = read_state(spark, path).filter(F.col(n.TOPIC) == topic)
    files = [file for file in state.inputFiles()]
    if len(files) <= 2 * KEPT_COMMITS:
        return
    newest = state.groupBy(F.input_file_name().alias("file")).agg(F.max("batch_id").alias("batch"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for row in newest.filter(F.col("batch") <= batch_id - KEPT_COMMITS).collect():
        claim = _claim_file(path, topic, row["batch"])
        for file in (jvm.java.net.URI(row["file"]), claim):
            file = jvm.org.apache.hadoop.fs.Path(file)
            file.getFileSystem(conf).delete(file, False)


def compact(spark: SparkSession, path: str, new_path: str) -> None:
    """The last commits of a table as a new one of one file per topic, for when years
    of runs have left many small files. The old table stays as it is."""
    last = committed_offsets(read_state(spark, path))
    last.repartition(n.TOPIC).write.partitionBy(n.TOPIC).parquet(new_path)
