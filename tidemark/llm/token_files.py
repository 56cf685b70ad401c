"""Token ids in shard files of independent Zstandard frames, and their readers.

A shard holds documents in ascending order of id. Its layout is the public seekable
Zstandard format: frames, a skippable frame with the document index, and at the end a
skippable frame with the seek table (sizes and checksum of each frame), so any Zstandard
reader can unpack it and a reader here unpacks only the frames of the documents asked for.

    frame        number of documents n, then n times (id, null id?, length), then all ids
    index        for each frame: first id, last id, documents, token ids
    seek table   for each frame: packed size, unpacked size, checksum; then the footer
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, open_folder, shared_folder, table
from tidemark.llm.tokens import BATCH_BYTES, VOCABULARY, Encoder

END_ID = 0
#: Bytes of text in a shard and of unpacked ids in a frame, at about; the level of packing.
SHARD_BYTES = 64 << 20
#: Shards are made larger rather than more than these.
MOST_SHARDS = 20_000
FRAME_BYTES = 256 << 10
LEVEL = 1

#: Fixed values of the public seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

_DOC = np.dtype([("doc_id", "<i8"), ("is_null", "<u4"), ("n_tokens", "<u4")])
_INDEX = np.dtype([("first", "<i8"), ("last", "<i8"), ("docs", "<u8"), ("ids", "<u8")])
_SEEK = np.dtype([("packed", "<u4"), ("unpacked", "<u4"), ("checksum", "<u4")])
#: Ids compare as signed 64-bit integers; null comes first.
_NULL_KEY = -(2**63)


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class ShardWriter:
    """Writes one shard from documents in order; holds one frame and 44 bytes for each."""

    def __init__(self, stream) -> None:
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.docs, self.ids, self.size = [], [], 0
        self.index, self.seek = [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self.ids.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self._flush()

    def _flush(self) -> None:
        if not self.docs:
            return
        head = np.array(self.docs, dtype=_DOC)
        data = struct.pack("<I", len(head)) + head.tobytes() + b"".join(self.ids)
        packed = self.packer.compress(data)
        self.stream.write(packed)
        keys = [_NULL_KEY if null else key for key, null, _ in (self.docs[0], self.docs[-1])]
        self.index.append((*keys, len(head), int(head["n_tokens"].sum(dtype="u8"))))
        self.seek.append((len(packed), len(data), _checksum(data)))
        self.docs, self.ids, self.size = [], [], 0

    def close(self) -> tuple[int, int, int]:
        """Documents, token ids and frames."""
        self._flush()
        index, seek = np.array(self.index, _INDEX), np.array(self.seek, _SEEK)
        foot = struct.pack("<IBI", len(seek), CHECKSUMS, SEEKABLE_MAGIC)
        for kind, data in (
            (SKIPPABLE_INDEX, index.tobytes()),
            (SKIPPABLE_SEEK_TABLE, seek.tobytes() + foot),
        ):
            self.stream.write(struct.pack("<II", kind, len(data)) + data)
        return int(index["docs"].sum()), int(index["ids"].sum()), len(seek)


class ShardReader:
    """Reads a shard from an open random access file: the tables first, then frames."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        frames, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a shard of token ids")
        seek_start = size - 9 - frames * _SEEK.itemsize
        self.seek = np.frombuffer(file.read_at(frames * _SEEK.itemsize, seek_start), _SEEK)
        index_start = seek_start - 8 - frames * _INDEX.itemsize
        self.index = np.frombuffer(file.read_at(frames * _INDEX.itemsize, index_start), _INDEX)
        self.starts = np.cumsum(self.seek["packed"], dtype="i8") - self.seek["packed"]
        self.id_starts = np.cumsum(self.index["ids"], dtype="i8") - self.index["ids"].astype("i8")

    def frame(self, k: int) -> Iterator[tuple[int | None, int, bytes]]:
        """Id, ids before it in the shard, and ids of each document; checks the frame."""
        packed, unpacked, checksum = (int(x) for x in self.seek[k])
        data = zstandard.ZstdDecompressor().decompress(
            self.file.read_at(packed, int(self.starts[k])), max_output_size=unpacked
        )
        if len(data) != unpacked or _checksum(data) != checksum:
            raise ValueError(f"frame {k} is damaged")
        (n,) = struct.unpack_from("<I", data)
        at, start = 4 + n * _DOC.itemsize, int(self.id_starts[k])
        for key, null, length in np.frombuffer(data, _DOC, n, 4).tolist():
            yield None if null else key, start, data[at : at + 4 * length]
            at, start = at + 4 * length, start + length

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        for k in range(len(self.seek)):
            yield from self.frame(k)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document of that id, unpacking only frames that may hold it."""
        key = _NULL_KEY if doc_id is None else doc_id
        first = int(np.searchsorted(self.index["last"], key, "left"))
        last = int(np.searchsorted(self.index["first"], key, "right"))
        return [
            np.frombuffer(ids, "<u4")
            for k in range(first, last)
            for found, _, ids in self.frame(k)
            if found == doc_id
        ]


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Writes the token ids of all rows as shards below `folder`; returns the manifest.

    Rows are in ascending order of doc_id, null first; rows of one id in the order of their
    text's hash, and equal rows next to each other. Null texts count as empty. Manifest:
    shard, file, n_docs, n_ids, n_frames. Shards are ranges of id and hash, so that an id
    with very many rows fills several; each text is shuffled once and encoded where it is
    written, frame by frame.

    A shard is written under a temporary name and then renamed, so that a task tried again,
    or twice at once, leaves one whole file. The folder must be reachable by pyarrow from
    every executor.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("doc_key", F.coalesce("doc_id", F.lit(_NULL_KEY)))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(int(size // shard_bytes) + 1, MOST_SHARDS)
    ordered = (
        keyed.withColumn("doc_hash", F.xxhash64("text"))
        .repartitionByRange(shards, "doc_key", "doc_hash")
        .sortWithinPartitions("doc_key", "doc_hash")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, (system, root) = Encoder(path), open_folder(folder)
        end = np.array([end_id], "<u4").tobytes()
        system.create_dir(root, recursive=True)
        shard = TaskContext.get().partitionId()
        writer, temporary = None, f"{root}/.{uuid.uuid4().hex}.part"
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            if writer is None:
                stream = system.open_output_stream(temporary)
                writer = ShardWriter(stream)
            found = use.encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                writer.add(doc_id, ids + end)
        if writer is None:
            return
        n_docs, n_ids, n_frames = writer.close()
        stream.close()
        name = f"shard-{shard:08d}.ids.zst"
        system.move(temporary, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()),
                "file": [f"{folder}/{name}"],
                "n_docs": [n_docs],
                "n_ids": [n_ids],
                "n_frames": [n_frames],
            }
        )

    manifest = "shard int, file string, n_docs long, n_ids long, n_frames long"
    listed = f"{folder.rstrip('/')}-manifest"  # stays with the shards
    ordered.mapInArrow(write, manifest).write.parquet(listed)
    return docs.sparkSession.read.schema(manifest).parquet(listed)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards of a manifest.

    `start` counts the ids of all documents before, over all shards: a running sum over the
    manifest, which has one row per shard, and the place inside the shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select(
        "shard", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, file = open_folder(row["file"])
                with system.open_input_file(file) as source:
                    reader = ShardReader(source)
                    for k in range(len(reader.seek)):
                        rows = [
                            (key, row["base"] + start, len(ids) // 4, zlib.crc32(ids))
                            for key, start, ids in reader.frame(k)
                        ]
                        yield pa.record_batch(
                            [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    spread = based.repartitionByRange(max(1, manifest.count()), "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, folder: str, **options) -> DataFrame:
    """Writes the documents' token ids below `folder` and returns what its files hold."""
    return read_token_files(write_token_files(docs, path, folder, **options))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(VOCABULARY),
        shared_folder(spark, "token-files"),
    )
