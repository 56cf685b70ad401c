"""Cuts a log into the batches that a capped reader makes of it, without reading it batch
by batch.

Every partition of a topic is read in slices: from the next offset there is, `batch_size`
offsets on. Where the log has gaps, a slice starts behind the gap, so starts follow from one
another. The offsets there are become bitmaps, one bit each, and a walk over the bitmaps of
a partition finds the starts: 32,768 offsets a step, however many messages there are.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.offsets import END, START

#: Fixed value: offsets in a bitmap of Spark's bitmap functions.
BITMAP_BITS = 32_768

BATCH = "batch"
SLICES_DDL = f"{n.PARTITION} INT, {BATCH} INT, {START} LONG, {END} LONG"


def offset_bitmaps(log: DataFrame) -> DataFrame:
    """partition, bucket, bitmap: which offsets there are; bucket b begins at b * 32,768."""
    place = F.col(n.OFFSET) + 1  # buckets of these functions begin at 1
    return (
        log.select(
            n.PARTITION,
            (F.bitmap_bucket_number(place) - 1).alias("bucket"),
            F.bitmap_bit_position(place).alias("bit"),
        )
        .groupBy(n.PARTITION, "bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )


class Walk:
    """The slices of one partition, from its bitmaps in ascending order."""

    def __init__(self, partition: int, batch_size: int, at_most: int) -> None:
        self.partition, self.batch_size, self.at_most = partition, batch_size, at_most
        self.starts: list[int] = []
        self.last, self.more = -1, False

    def add(self, bucket: int, bitmap: bytes) -> None:
        bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
        offsets = np.flatnonzero(bits) + bucket * BITMAP_BITS
        while len(offsets):
            if not self.starts:
                self.starts.append(int(offsets[0]))
            end = self.starts[-1] + self.batch_size
            after = int(np.searchsorted(offsets, end))
            if after:
                self.last = int(offsets[after - 1])
            offsets = offsets[after:]
            if len(offsets):
                if len(self.starts) == self.at_most:
                    self.more = True
                    return
                self.starts.append(int(offsets[0]))

    def slices(self) -> list[tuple[int, int, int, int]]:
        """partition, batch, start and end of each slice; one that nothing follows ends with
        its last offset if that is before its cap."""
        caps = [start + self.batch_size for start in self.starts]
        ends = caps if self.more else [*caps[:-1], min(caps[-1], self.last + 1)]
        return [(self.partition, k, *pair) for k, pair in enumerate(zip(self.starts, ends, strict=True))]


def batch_slices(log: DataFrame, batch_size: int, at_most: int) -> DataFrame:
    """partition, batch, start_offset, end_offset of the first `at_most` batches of a log of
    one topic; a batch takes one slice of each partition that has one left."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Walk | None = None

        def told() -> pa.RecordBatch:
            columns = list(zip(*found.slices(), strict=True))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [n.PARTITION, BATCH, START, END],
            )

        for batch in batches:
            for partition, bucket, bitmap in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if found is None or found.partition != partition:
                    if found is not None:
                        yield told()
                    found = Walk(partition, batch_size, at_most)
                found.add(bucket, bitmap)
        if found is not None:
            yield told()

    ordered = offset_bitmaps(log).repartition(n.PARTITION).sortWithinPartitions(n.PARTITION, "bucket")
    return ordered.mapInArrow(walk, SLICES_DDL)


def with_batch(log: DataFrame, slices: DataFrame, batch_size: int) -> DataFrame:
    """Messages inside a slice, with the number of their batch.

    A slice reaches into two cells of `batch_size` offsets at most, so the join is by
    partition and cell, and a cell holds at most two slices. The slices are broadcast: a
    caller bounds their number by `at_most`.
    """

    def cell(offset: str) -> Column:
        return F.expr(f"({offset}) div {batch_size}")

    known = slices.select(
        F.col(n.PARTITION).alias("__partition"),
        BATCH,
        START,
        END,
        F.explode(F.array_distinct(F.array(cell(START), cell(f"{END} - 1")))).alias("__cell"),
    )
    inside = (
        (F.col(n.PARTITION) == F.col("__partition"))
        & (cell(n.OFFSET) == F.col("__cell"))
        & (F.col(n.OFFSET) >= F.col(START))
        & (F.col(n.OFFSET) < F.col(END))
    )
    return log.join(F.broadcast(known), inside).select(*log.columns, BATCH)
