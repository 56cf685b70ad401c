"""Counts of a run, lag of a topic, and volume of logs and stores."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators import dedup, offsets
from tidemark.operators.enrich import enrich_with_dictionary

# Committed offsets of up to this many topic partitions are broadcast.
MAX_BROADCAST_PARTITIONS = 500_000


def run_metrics(
    flat: DataFrame,
    stored: DataFrame,
    dictionary: DataFrame,
    extent: dedup.Extent | None = None,
) -> DataFrame:
    """One row: read, invalid, duplicates by kind, success and failed.

    One plan, in which the batch is read and parsed once: each survivor knows how many
    copies it stands for and whether the store has it. Rows without an id are `invalid` and
    not duplicates, although they collapse to one row that goes to a store. `extent` as in
    `dedup_incremental`.
    """
    known = dedup.known_keys(stored, extent).distinct().withColumn("__stored", F.lit(True))
    survivors = dedup.dedup_in_batch(flat, copies=n.COPIES).join(known, n.STORE_KEY, "left")
    named = enrich_with_dictionary(survivors, dictionary, keep=[n.COPIES, "__stored"])
    copies, stored_before = F.col(n.COPIES), F.col("__stored").isNotNull()
    valid, shop = F.col(n.ID).isNotNull(), F.col(n.SHOP_NAME)

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("long")

    return named.agg(
        total(copies).alias("read"),
        total(F.when(~valid, copies)).alias("invalid"),
        total(F.when(valid, copies - 1)).alias("dup_in_batch"),
        F.count_if(stored_before).alias("dup_stored"),
        F.count_if(~stored_before & shop.isNotNull()).alias("success"),
        F.count_if(~stored_before & shop.isNull()).alias("failed"),
    )


def batch_counts(flat: DataFrame, stored: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row: read, duplicates of both kinds together, success and failed.

    Here rows without an id count as copies of one another.
    """
    return run_metrics(flat, stored, dictionary).select(
        "read",
        (F.col("read") - F.col("success") - F.col("failed")).alias("duplicates"),
        "success",
        "failed",
    )


def partition_lag(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Offsets between the last commit, or the start of the log, and its end.

    Only what lies past the commits is looked at, and, in partitions where nothing does,
    the message read last. A partition whose log ends before that is looked at as a whole.
    """
    known = committed.collect()
    bounds = offsets.bounds_past(log, known)
    starts = offsets.starting_offsets(bounds, offsets.local_offsets(log.sparkSession, known))
    return starts.select(
        n.TOPIC,
        n.PARTITION,
        offsets.LATEST,
        offsets.START,
        (F.col(offsets.LATEST) - F.col(offsets.START)).alias("lag"),
    )


def log_volume(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages written to, and read so far from, each topic partition.

    The committed offsets are broadcast if they are as few as they should be.
    """
    known = committed.select(n.TOPIC, n.PARTITION, F.col(n.OFFSET).alias(offsets.COMMITTED))
    if known.count() <= MAX_BROADCAST_PARTITIONS:
        known = F.broadcast(known)
    read = F.col(n.OFFSET) < F.col(offsets.COMMITTED)
    return (
        log.select(n.TOPIC, n.PARTITION, n.OFFSET)
        .join(known, [n.TOPIC, n.PARTITION], "left")
        .groupBy(n.TOPIC, n.PARTITION)
        .agg(F.count(F.lit(1)).alias("written"), F.count_if(read).alias("read"))
    )


def store_volume(stored: DataFrame) -> DataFrame:
    """Rows per year and week of one store, from file footers alone."""
    return stored.groupBy(n.YEAR, n.WEEK_NUMBER).agg(F.count(F.lit(1)).alias("stored_rows"))


def store_bytes(stored: DataFrame) -> DataFrame:
    """Rows, files and bytes per year and week of one store read from files."""
    files = stored.groupBy(
        n.YEAR, n.WEEK_NUMBER, "_metadata.file_path", "_metadata.file_size"
    ).agg(F.count(F.lit(1)).alias("file_rows"))
    return files.groupBy(n.YEAR, n.WEEK_NUMBER).agg(
        F.sum("file_rows").alias("stored_rows"),
        F.count(F.lit(1)).alias("stored_files"),
        F.sum("file_size").alias("stored_bytes"),
    )
