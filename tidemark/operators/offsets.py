"""Planning of bounded per-partition offset ranges over a message log.

Offset frames hold one row per topic partition, however long the log is; plans of
that length are what is collected here.
"""

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n

START = "start_offset"
END = "end_offset"
EARLIEST = "earliest_offset"
LATEST = "latest_offset"
COMMITTED = "committed_offset"

# Ranges of up to this many topic partitions are written out as literals; those of more
# are joined. Either way the same rows are found.
MAX_LITERAL_RANGES = 500


def _local(spark: SparkSession, rows: list[Row], columns: dict[str, str]) -> DataFrame:
    """Collected rows as a frame again, without a job; `columns` as name: name in the row."""
    kinds = {n.TOPIC: pa.string(), n.PARTITION: pa.int32()}
    return spark.createDataFrame(
        pa.table(
            {
                name: pa.array([r[source] for r in rows], kinds.get(name, pa.int64()))
                for name, source in columns.items()
            }
        )
    )


def local_offsets(spark: SparkSession, rows: list[Row], offset: str = n.OFFSET) -> DataFrame:
    """Collected offset rows as a frame again, without a job."""
    return _local(spark, rows, {n.TOPIC: n.TOPIC, n.PARTITION: n.PARTITION, n.OFFSET: offset})


def local_bounds(spark: SparkSession, rows: list[Row]) -> DataFrame:
    """Collected bounds as a frame again, without a job."""
    return _local(spark, rows, {c: c for c in (n.TOPIC, n.PARTITION, EARLIEST, LATEST)})


def log_bounds(log: DataFrame) -> DataFrame:
    """First offset and one past the last offset of each topic partition."""
    return log.groupBy(n.TOPIC, n.PARTITION).agg(
        F.min(n.OFFSET).alias(EARLIEST), (F.max(n.OFFSET) + 1).alias(LATEST)
    )


def earliest_offsets(log: DataFrame) -> DataFrame:
    """First available offset of each topic partition."""
    return log.groupBy(n.TOPIC, n.PARTITION).agg(F.min(n.OFFSET).alias(n.OFFSET))


def latest_offsets(log: DataFrame) -> DataFrame:
    """One past the last offset of each topic partition."""
    return log.groupBy(n.TOPIC, n.PARTITION).agg((F.max(n.OFFSET) + 1).alias(n.OFFSET))


def committed_offsets(state: DataFrame, topic: str | None = None) -> DataFrame:
    """Last committed offset of each topic partition, out of the append-only state,
    and the batch that committed it. Two commits of one batch: the higher offset."""
    if topic is not None:
        state = state.filter(F.col(n.TOPIC) == topic)
    last = F.max(F.struct("batch_id", n.OFFSET))
    return (
        state.groupBy(n.TOPIC, n.PARTITION)
        .agg(last.alias("__last"))
        .select(n.TOPIC, n.PARTITION, f"__last.{n.OFFSET}", "__last.batch_id")
    )


def upsert_offsets(state: DataFrame, new: DataFrame) -> DataFrame:
    """State after a commit: per topic partition the row of the highest batch."""
    return committed_offsets(state.unionByName(new))


def _with_committed(bounds: DataFrame, committed: DataFrame) -> DataFrame:
    known = committed.select(n.TOPIC, n.PARTITION, F.col(n.OFFSET).alias(COMMITTED))
    return bounds.join(known, [n.TOPIC, n.PARTITION], "left")


def starting_offsets(bounds: DataFrame, committed: DataFrame) -> DataFrame:
    """Where each topic partition is read from: its committed offset, else its earliest.

    A committed offset before the first one kept moves up to it. One past the end
    belongs to a topic that was created anew, which is read from its start. `moved`
    tells of both.
    """
    wanted = F.coalesce(COMMITTED, EARLIEST)
    inside = F.when(wanted.between(F.col(EARLIEST), F.col(LATEST)), wanted).otherwise(
        F.col(EARLIEST)
    )
    return _with_committed(bounds, committed).select(
        n.TOPIC,
        n.PARTITION,
        EARLIEST,
        LATEST,
        inside.alias(START),
        (inside != wanted).alias("moved"),
        COMMITTED,
    )


def ending_offsets(starts: DataFrame, batch_size: int) -> DataFrame:
    """Where each topic partition is read to, exclusive: at most `batch_size` offsets on."""
    return starts.withColumn(END, F.least(F.col(LATEST), F.col(START) + F.lit(batch_size)))


def plan_offsets(log: DataFrame, committed: DataFrame, batch_size: int) -> DataFrame:
    """Start and end of each topic partition, from one aggregation over two log columns."""
    return ending_offsets(starting_offsets(log_bounds(log), committed), batch_size)


def _any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def _places(log: DataFrame, rows: list[Row], offset: str) -> DataFrame:
    """The rows as a broadcast frame of partition and `offset`; they have been collected,
    one per topic partition."""
    return F.broadcast(_local(log.sparkSession, rows, {n.PARTITION: n.PARTITION, offset: n.OFFSET}))


def _unread(log: DataFrame, known: list[Row]) -> DataFrame:
    """Log rows at or past the committed offset of their partition, and all rows of
    partitions not seen before. Partitions, and the offsets of few of them or the least
    of many, are literals, so that a scan can leave out read ranges."""
    seen = F.col(n.PARTITION).isin([row[n.PARTITION] for row in known])
    if len(known) <= MAX_LITERAL_RANGES:
        tails = log.filter(
            seen
            & _any_of(
                (F.col(n.PARTITION) == row[n.PARTITION]) & (F.col(n.OFFSET) >= row[n.OFFSET])
                for row in known
            )
        )
    else:
        least = min(row[n.OFFSET] for row in known)
        tails = (
            log.filter(seen & (F.col(n.OFFSET) >= least))
            .join(_places(log, known, COMMITTED), n.PARTITION)
            .filter(F.col(n.OFFSET) >= F.col(COMMITTED))
            .select(*log.columns)
        )
    # Two scans: joined by OR, the second predicate would keep the first from the files.
    return tails.union(log.filter(~seen))


def _not_reaching(log: DataFrame, idle: list[Row]) -> list[int]:
    """Partitions whose last read offset is not in the log; a lookup, not a scan."""
    if len(idle) <= MAX_LITERAL_RANGES:
        last_read = log.filter(
            _any_of(
                (F.col(n.PARTITION) == row[n.PARTITION]) & (F.col(n.OFFSET) == row[n.OFFSET] - 1)
                for row in idle
            )
        )
    else:
        ends = [row[n.OFFSET] for row in idle]
        last_read = (
            log.filter(
                F.col(n.PARTITION).isin([row[n.PARTITION] for row in idle])
                & F.col(n.OFFSET).between(min(ends) - 1, max(ends) - 1)
            )
            .join(_places(log, idle, COMMITTED), n.PARTITION)
            .filter(F.col(n.OFFSET) == F.col(COMMITTED) - 1)
        )
    there = {row[0] for row in last_read.select(n.PARTITION).distinct().collect()}
    return [row[n.PARTITION] for row in idle if row[n.PARTITION] not in there]


def bounds_past(log: DataFrame, known: list[Row]) -> DataFrame:
    """Bounds that give each topic partition the start and lag that `log_bounds` gives it,
    from the rows past the committed offsets.

    Where the message read last is still there, the log reaches back to the commit, and
    EARLIEST is told as the commit itself; other partitions are looked at as a whole.
    """
    log = log.select(n.TOPIC, n.PARTITION, n.OFFSET)
    spark, topics = log.sparkSession, sorted({row[n.TOPIC] for row in known})
    parts = [log_bounds(log.filter(~F.col(n.TOPIC).isin(topics)) if topics else log)]
    for topic in topics:
        own, rows = log.filter(F.col(n.TOPIC) == topic), [r for r in known if r[n.TOPIC] == topic]
        lost = set(_not_reaching(own, rows))
        reached = [row for row in rows if row[n.PARTITION] not in lost]
        ends = _local(
            spark,
            reached,
            {
                n.TOPIC: n.TOPIC,
                n.PARTITION: n.PARTITION,
                EARLIEST: n.OFFSET,
                LATEST: n.OFFSET,
            },
        )
        past = log_bounds(_unread(own.filter(~F.col(n.PARTITION).isin(sorted(lost))), reached))
        both = ends.unionByName(past).groupBy(n.TOPIC, n.PARTITION)
        parts.append(both.agg(F.min(EARLIEST).alias(EARLIEST), F.max(LATEST).alias(LATEST)))
        parts.append(log_bounds(own.filter(F.col(n.PARTITION).isin(sorted(lost)))))
    return reduce(DataFrame.unionByName, parts)


def plan_unread(log: DataFrame, known: list[Row], batch_size: int) -> list[Row]:
    """Like `plan_offsets`, but looks only at what lies past the committed offsets, and
    is fixed: it does not change when the log grows later. `known` are the rows of
    `committed_offsets` for the topic; partitions without anything new are left out.
    The plan is the same for any number of partitions.

    A partition without anything new whose last read offset is gone is looked at as
    a whole, as its topic may have been created anew. A partition where the log
    leaves a gap after the committed offset is read from the next offset there is.
    """
    log = log.select(n.TOPIC, n.PARTITION, n.OFFSET)
    committed = local_offsets(log.sparkSession, known)

    def planned(part: DataFrame) -> list[Row]:
        starts = starting_offsets(log_bounds(part), committed)
        rows = ending_offsets(starts, batch_size).collect()
        return [row for row in rows if row[START] < row[END]]

    if not known:
        return planned(log)
    plan = planned(_unread(log, known))
    found = {row[n.PARTITION] for row in plan}
    idle = [row for row in known if row[n.PARTITION] not in found]
    lost = _not_reaching(log, idle) if idle else []
    if lost:
        plan += planned(log.filter(F.col(n.PARTITION).isin(lost)))
    return plan


def range_filter(log: DataFrame, ranges: list[Row]) -> DataFrame:
    """Rows with start <= offset < end in their partition.

    The ranges become literals, which prune partitions and row groups of the log.
    """
    wanted = _any_of(
        (F.col(n.PARTITION) == r[n.PARTITION])
        & (F.col(n.OFFSET) >= r[START])
        & (F.col(n.OFFSET) < r[END])
        for r in ranges
        if r[START] < r[END]
    )
    return log.filter(wanted)


def range_join(log: DataFrame, ranges: list[Row]) -> DataFrame:
    """The same for a topic of very many partitions, behind the outermost bounds.

    The plan, which has been collected already, is broadcast.
    """
    limits = _local(
        log.sparkSession, ranges, {n.PARTITION: n.PARTITION, START: START, END: END}
    )
    low, high = min(r[START] for r in ranges), max(r[END] for r in ranges)
    return (
        log.filter((F.col(n.OFFSET) >= low) & (F.col(n.OFFSET) < high))
        .join(F.broadcast(limits), n.PARTITION)
        .filter((F.col(n.OFFSET) >= F.col(START)) & (F.col(n.OFFSET) < F.col(END)))
        .select(*log.columns)
    )


def log_range_scan(log: DataFrame, plan: DataFrame | list[Row]) -> DataFrame:
    """Messages of one topic inside the planned ranges."""
    ranges = plan.collect() if isinstance(plan, DataFrame) else plan
    few = len(ranges) <= MAX_LITERAL_RANGES
    return range_filter(log, ranges) if few else range_join(log, ranges)
