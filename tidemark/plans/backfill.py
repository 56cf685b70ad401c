"""A historical load: very many batches in one plan, with the outcome of one after the other."""

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.messages import flatten_messages
from tidemark.operators.dedup import anti_join_stored, only_weeks, write_survivors
from tidemark.operators.enrich import dictionary_bytes, enrich_with_dictionary, matched, unmatched
from tidemark.operators.offsets import END, START, log_range_scan, plan_unread
from tidemark.operators.slices import BATCH, SLICES_DDL, batch_slices, with_batch
from tidemark.plans.batch import SCRATCH, BatchReport, parse_once
from tidemark.plans.job import JobConfig, warn_of_moves
from tidemark.scratch import remove_folder, run_folder, write_once
from tidemark.sources.offset_table import claimed, commit_offsets, find_offsets
from tidemark.sources.store import (
    append_partitioned,
    append_success,
    not_yet_aside,
    not_yet_in,
    read_store,
    store_path,
)

logger = logging.getLogger(__name__)

#: Batches that are planned, stored and committed together. Their slices, one per topic
#: partition and batch, are what the driver holds and what is broadcast to the log.
AT_ONCE = 500

_BEYOND = 2**63 - 1


def backfill(
    log: DataFrame, dictionary: DataFrame, config: JobConfig, at_once: int = AT_ONCE
) -> list[tuple[int, BatchReport]]:
    """Batches until the end of the log, with one report each.

    Stores and offsets are those of `incremental_batch` called until there is nothing new,
    but up to `at_once` batches are one plan and one commit: a number of jobs that does not
    grow with theirs. The dictionary is measured once.
    """
    done, size = [], dictionary_bytes(dictionary)
    while True:
        some = _batches(log, dictionary, config, size, at_once)
        done += some
        if len(some) < at_once:  # no more than there was when it was planned
            return done


def _batches(
    log: DataFrame, dictionary: DataFrame, config: JobConfig, dictionary_size: int, at_once: int
) -> list[tuple[int, BatchReport]]:
    spark = log.sparkSession
    log = log.filter(log[n.TOPIC] == config.topic)
    known = find_offsets(spark, config.offsets_path, config.topic).collect()
    plan = plan_unread(log, known, config.batch_size)
    if not plan:
        return []
    warn_of_moves(config, plan)
    rest = log_range_scan(log, [_range(row[n.PARTITION], row[START], _BEYOND) for row in plan])
    slices = batch_slices(rest, config.batch_size, at_once).collect()
    whole: dict[int, tuple[int, int]] = {}
    for row in slices:
        start, end = whole.get(row[n.PARTITION], (row[START], row[END]))
        whole[row[n.PARTITION]] = min(start, row[START]), max(end, row[END])
    ranges = [_range(partition, *pair) for partition, pair in whole.items()]
    messages = with_batch(
        log_range_scan(log, ranges), spark.createDataFrame(slices, SLICES_DDL), config.batch_size
    )
    number = 1 + max(row[BATCH] for row in slices)
    first = max((row["batch_id"] for row in known), default=-1) + 1
    ends = [Row(**{n.TOPIC: config.topic, n.PARTITION: r[n.PARTITION], END: r[END]}) for r in ranges]
    with claimed(spark, config.offsets_path, config.topic, first):
        reports = store_batches(messages, number, dictionary, config, dictionary_size)
        commit_offsets(spark, ends, config.offsets_path, first + number - 1, known)
    for k, report in enumerate(reports):
        logger.info("%s, batch %s: %s", config.topic, first + k, report)
    return [(first + k, report) for k, report in enumerate(reports)]


def _range(partition: int, start: int, end: int) -> Row:
    return Row(**{n.PARTITION: partition, START: start, END: end})


def _per_batch(rows: DataFrame, **counts: Column) -> dict[int, Row]:
    """Counts of each batch; one row per batch is collected."""
    found = rows.groupBy(BATCH).agg(*[count.alias(name) for name, count in counts.items()])
    return {row[BATCH]: row for row in found.collect()}


def _count(found: Mapping[int, Row], batch: int, name: str) -> int:
    return (found[batch][name] or 0) if batch in found else 0


def store_batches(
    messages: DataFrame,
    number: int,
    dictionary: DataFrame,
    config: JobConfig,
    dictionary_size: int | None = None,
) -> list[BatchReport]:
    """Processes messages of `number` batches, told by their column `batch`, and appends them
    to the stores as `store_batch` would one after the other.

    Inside a batch an id has one survivor. Across batches the first one in which an order
    finds its shop stores it, and what follows for its id, year and week is a duplicate; what
    came before had failed. Messages without an arrival time raise an error, or are set aside
    with `quarantine`, before anything of any batch is written.
    """
    spark, root = messages.sparkSession, config.write_to
    place = [c for c in n.PLACE if c in messages.columns]
    one = F.count(F.lit(1))
    aside: dict[int, Row] = {}
    written_aside: dict[int, Row] = {}
    folder = run_folder(spark, "batches", f"{root.rstrip('/')}/{SCRATCH}")
    try:
        if config.quarantine:
            flat, invalid, total = parse_once(messages, f"{folder}/parsed", [BATCH])
            if total:
                aside = _per_batch(invalid, n_rows=one)
                new = not_yet_aside(invalid, root, config.replay_safe, total)
                written_aside = _per_batch(new, n_rows=one)
                if written_aside:
                    append_partitioned(new.drop(BATCH), store_path(root, n.QUARANTINE))
        else:
            flat = flatten_messages(messages, keep=[*place, BATCH])
        survivors, extent = write_survivors(flat, f"{folder}/survivors", (BATCH, n.ID))
        if extent.untimed:
            raise ValueError(
                "messages without an arrival time belong to no week; quarantine sets them aside"
            )
        copies = F.col(n.COPIES)
        read = _per_batch(
            survivors,
            kept=one,
            kept_valid=F.count(n.ID),
            read=F.sum(copies),
            valid=F.sum(F.when(F.col(n.ID).isNotNull(), copies)),
        )
        fresh = anti_join_stored(
            survivors,
            read_store(spark, root, n.SUCCESS, extent.weeks),
            extent.weeks,
            extent.id_range,
            extent.kept,
        )
        result = enrich_with_dictionary(
            fresh, dictionary, [*place, BATCH], dictionary_size=dictionary_size
        )
        same_order = Window.partitionBy(*n.STORE_KEY)
        stored_in = F.min(F.when(F.col(n.SHOP_NAME).isNotNull(), F.col(BATCH))).over(same_order)
        rows = write_once(
            result.withColumn("__stored_in", F.when(F.col(n.ID).isNotNull(), stored_in))
            .filter(F.col("__stored_in").isNull() | (F.col(BATCH) <= F.col("__stored_in")))
            .drop("__stored_in"),
            f"{folder}/result",
        )
        lost = unmatched(rows)
        if config.replay_safe:
            before = read_store(spark, root, n.FAILED, extent.weeks, n.FAILED_DDL)
            lost = write_once(not_yet_in(lost, only_weeks(before, extent.weeks)), f"{folder}/failed")
        success, failed = _per_batch(matched(rows), n_rows=one), _per_batch(lost, n_rows=one)
        limit = config.max_rows_per_file
        if success:
            append_success(matched(rows).drop(*place, BATCH), root, limit)
        if failed:
            append_partitioned(lost.drop(BATCH), store_path(root, n.FAILED), limit)
    finally:
        remove_folder(spark, folder)

    def report(k: int) -> BatchReport:
        kept, valid = _count(read, k, "kept"), _count(read, k, "valid")
        stored, lost_rows = _count(success, k, "n_rows"), _count(failed, k, "n_rows")
        set_aside, new_aside = _count(aside, k, "n_rows"), _count(written_aside, k, "n_rows")
        return BatchReport(
            read=_count(read, k, "read") + set_aside,
            invalid=_count(read, k, "read") - valid + new_aside,
            dup_in_batch=valid - _count(read, k, "kept_valid"),
            dup_stored=kept - stored - lost_rows + set_aside - new_aside,
            success=stored,
            failed=lost_rows,
        )

    return [report(k) for k in range(number)]
