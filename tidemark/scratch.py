"""Folders for intermediate tables, where every executor can reach them."""

import re
import tempfile
import uuid
from collections.abc import Iterable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def local_folder(spark: SparkSession) -> str:
    """A new temporary folder, if all of the session's tasks run on this machine; on a cluster,
    be it one of processes, the session must name a folder instead."""
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def run_folder(spark: SparkSession, label: str, below: str | None = None) -> str:
    """A new folder below the one the session names in `spark.checkpoint.dir`, else below
    `below`. Only a local session that has neither gets a temporary folder: on a cluster
    other executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or below
    if not base:
        base = local_folder(spark)
    return f"{base.rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex}"


def write_once(rows: DataFrame, path: str) -> DataFrame:
    """The rows as a table at `path`, read back: nothing is computed again after this."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def observed(observation: Observation, names: Iterable[str]) -> dict[str, Any]:
    """What was observed while a table was written. Adaptive execution takes the observation
    of rows that turn out to be none out of the plan; then everything is None."""
    try:
        found = observation.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        found = {}
    return {name: found.get(name) for name in names}


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that `run_folder` named and everything in it."""
    if "/tidemark-" not in path:
        raise ValueError(f"not a folder of this library: {path}")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
