"""Compaction of a store: small files of a week become few, under the eyes of readers.

A scheduled job leaves several files a batch. Their rows are written anew to hidden files, and
one rename of a marker swaps them in:

    _pending-<id>    names new files that do not count yet, and old ones that still do
    _replaced-<id>   the same file renamed: the new files count, the old ones do not

Readers (`readable_files`) take the files of a directory less those that its markers rule out,
so they see every row once at any time. Old files stay until `vacuum` removes them, for
readers that have listed them already. A compaction that dies leaves a pending marker, which
`vacuum` removes with its files.
"""

import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark import names as n

PENDING, REPLACED = "_pending-", "_replaced-"

#: Files of at least half this size are left alone; a new file has about this many bytes.
TARGET_BYTES = 128 << 20

#: Old files stay this long for readers that have listed them.
GRACE_SECONDS = 24 * 3600

# Listings that changed while they were read are read again, this often at most.
_TRIES = 20


class _Files:
    """The file system of a folder, by the session's own client."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.system = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def glob(self, pattern: str) -> list:
        return list(self.system.globStatus(self.path(pattern)) or [])

    def read(self, path) -> str:
        stream = self.system.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> None:
        if not self.system.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _data_files(files: _Files, folder: str) -> dict[str, int]:
    """Name and size of the data files of a directory."""
    found = ((status.getPath().getName(), status.getLen()) for status in files.glob(f"{folder}/*"))
    return {name: size for name, size in found if not name.startswith(("_", "."))}


def _ruled_out(files: _Files, folder: str) -> dict[str, list[str]]:
    """Markers of a directory and the files that each of them rules out."""
    found = {}
    for status in files.glob(f"{folder}/{{{PENDING},{REPLACED}}}*"):
        name = status.getPath().getName()
        try:
            told = json.loads(files.read(status.getPath()))
        except Exception as error:  # renamed or removed since it was listed
            if "FileNotFound" not in str(error):
                raise
            return _ruled_out(files, folder)
        found[name] = told["new"] if name.startswith(PENDING) else told["old"]
    return found


def _any_of(folders: Iterable[str]) -> str:
    folders = list(folders)
    return f"{{{','.join(folders)}}}" if len(folders) > 1 else folders[0]


def has_any(spark: SparkSession, base: str, folders: Iterable[str]) -> bool:
    """Whether one of the directories below `base` is there."""
    return bool(_Files(spark, base).glob(f"{base}/{_any_of(folders)}"))


def is_compacted(spark: SparkSession, base: str, folders: Iterable[str]) -> bool:
    """Whether a marker lies in one of the directories below `base`."""
    markers = f"{{{PENDING},{REPLACED}}}*"
    return bool(_Files(spark, base).glob(f"{base}/{_any_of(folders)}/{markers}"))


def readable_files(spark: SparkSession, base: str, folders: Iterable[str]) -> list[str]:
    """Paths of the files that hold each row of the directories once, as of now."""
    files, found = _Files(spark, base), []
    places = sorted({str(s.getPath()) for f in folders for s in files.glob(f"{base}/{f}")})
    for place in places:
        for _ in range(_TRIES):
            markers = _ruled_out(files, place)
            names = _data_files(files, place)
            if _ruled_out(files, place).keys() == markers.keys():
                break
        else:
            raise OSError(f"{place} does not come to rest")
        out = {name for names_out in markers.values() for name in names_out}
        found += [f"{place}/{name}" for name in sorted(names) if name not in out]
    return found


def bins_of(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Small files in bins of about `target` bytes; a file alone is left as it is."""
    bins: list[list[str]] = []
    filled = target
    for name, size in sorted(sizes.items(), key=lambda item: (item[1], item[0])):
        if 2 * size >= target:
            break
        if filled + size > target:
            bins.append([])
            filled = 0
        bins[-1].append(name)
        filled += size
    return [names for names in bins if len(names) > 1]


def compact_week(
    spark: SparkSession,
    root: str,
    store: str,
    year: int,
    week: int,
    target_bytes: int = TARGET_BYTES,
    lookup: str | None = n.ID,
) -> tuple[int, int]:
    """Small files of one week as few: how many were replaced, and by how many.

    One plan for all bins, each of which one task writes; rows of a new file are sorted by
    `lookup`, with Bloom filters for it. Batches may go on appending. One compaction of a week
    at a time: a week with a pending marker is refused.
    """
    base = f"{root.rstrip('/')}/{store}"
    place = f"{base}/{n.YEAR}={year}/{n.WEEK_NUMBER}={week}"
    files = _Files(spark, base)
    markers = _ruled_out(files, place)
    if any(name.startswith(PENDING) for name in markers):
        raise RuntimeError(f"a compaction of {place} is under way or was lost; see vacuum")
    out = {name for names in markers.values() for name in names}
    sizes = {name: size for name, size in _data_files(files, place).items() if name not in out}
    bins = bins_of(sizes, target_bytes)
    if not bins:
        return 0, 0
    label = uuid.uuid4().hex
    hidden = f"{place}/_compact-{label}"
    try:
        _write_bins(spark, place, bins, hidden, lookup)
        written = sorted(str(s.getPath()) for s in files.glob(f"{hidden}/bin=*/*.parquet"))
        new = [f"compact-{label}-{k}.parquet" for k in range(len(written))]
        old = [name for names in bins for name in names]
        files.write(f"{place}/{PENDING}{label}", json.dumps({"new": new, "old": old}))
        for path, name in zip(written, new, strict=True):
            files.rename(path, f"{place}/{name}")
        files.rename(f"{place}/{PENDING}{label}", f"{place}/{REPLACED}{label}")
    finally:
        files.delete(hidden)
    return len(old), len(new)


def _write_bins(
    spark: SparkSession, place: str, bins: list[list[str]], hidden: str, lookup: str | None
) -> None:
    of_bin = [(name, k) for k, names in enumerate(bins) for name in names]
    numbers = spark.createDataFrame(of_bin, "__name STRING, bin INT")
    rows = spark.read.parquet(*[f"{place}/{name}" for name, _ in of_bin])
    named = rows.withColumn("__name", F.col("_metadata.file_name"))
    dealt = named.join(F.broadcast(numbers), "__name").drop("__name").repartition(len(bins), "bin")
    order = [lookup] if lookup in rows.columns else []
    writer = dealt.sortWithinPartitions("bin", *order).write.partitionBy("bin")
    if order:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(hidden)


def vacuum(
    spark: SparkSession, root: str, store: str, grace_seconds: float = GRACE_SECONDS
) -> int:
    """Removes files that compactions replaced or left behind, of markers older than the grace;
    returns how many. The marker goes last, so that a reader never sees a row twice."""
    base = f"{root.rstrip('/')}/{store}"
    files, removed = _Files(spark, base), 0
    for status in files.glob(f"{base}/*/*/{{{PENDING},{REPLACED}}}*"):
        if time.time() - status.getModificationTime() / 1000 < grace_seconds:
            continue
        path = status.getPath()
        told = json.loads(files.read(path))
        for name in told["new" if path.getName().startswith(PENDING) else "old"]:
            files.delete(f"{path.getParent()}/{name}")
            removed += 1
        files.delete(str(path))
    return removed

