"""One batch: messages to routed rows, and routed rows to the stores."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.messages import VALID, flatten_messages, parse_messages, split_parsed
from tidemark.operators.dedup import (
    Extent,
    anti_join_stored,
    dedup_incremental,
    only_weeks,
    write_survivors,
)
from tidemark.operators.enrich import enrich_with_dictionary, route
from tidemark.scratch import observed, remove_folder, run_folder, write_once
from tidemark.sources.store import append_quarantine, read_store, write_routed

# Folder below the stores for intermediate tables, where the session names none.
SCRATCH = "_scratch"


@dataclass(frozen=True)
class BatchReport:
    """Counts of one batch. `read` = `invalid` + duplicates + `success` + `failed`,
    except that the rows without an id, all `invalid`, still route as one row.

    `success`, `failed` and, with quarantine, `invalid` are what was written; what a
    safe replay finds written already counts as `dup_stored`."""

    read: int = 0
    invalid: int = 0
    dup_in_batch: int = 0
    dup_stored: int = 0
    success: int = 0
    failed: int = 0


def _place(messages: DataFrame) -> list[str]:
    return [c for c in n.PLACE if c in messages.columns]


def parse_once(
    messages: DataFrame, path: str, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, int]:
    """Flat rows of valid messages, invalid messages as they came and how many these are. The
    messages are read and parsed once, into a table at `path`."""
    seen = Observation()
    parsed = parse_messages(messages, [*_place(messages), *keep])
    invalid = F.count_if(~F.col(VALID)).alias("invalid")
    table = write_once(parsed.observe(seen, invalid), path)
    return *split_parsed(table), observed(seen, ["invalid"])["invalid"] or 0


def process_batch(
    messages: DataFrame,
    dictionary: DataFrame,
    stored: DataFrame | None,
    keep: Sequence[str] = (),
    extent: Extent | None = None,
) -> DataFrame:
    """Messages to result rows with the route each one takes. Nothing is written; `extent`
    as in `dedup_incremental`."""
    flat = flatten_messages(messages, keep=_place(messages))
    fresh = dedup_incremental(flat, stored, extent)
    return enrich_with_dictionary(fresh, dictionary, keep).withColumn(n.ROUTE, route())


def store_batch(
    messages: DataFrame,
    dictionary: DataFrame,
    root: str,
    replay_safe: bool = False,
    quarantine: bool = False,
    max_rows_per_file: int | None = None,
    dictionary_size: int | None = None,
) -> BatchReport:
    """Process one bounded batch and append it to the stores below `root`.

    Messages are read and parsed once. The survivors of the batch and then its result are
    written tables in a folder that executors share (`spark.checkpoint.dir`, or below
    `root`) and that is removed at the end: a store that changes, or a lost executor, cannot
    set off a second look at what was there before. The report counts what was written, by
    what was observed while it was.

    `replay_safe` keeps a batch that is run again after a crash from adding its
    failed rows twice. `quarantine` sets invalid messages aside, whole, instead of
    letting them collapse into one failed row. Rows without an arrival time belong to no
    week: they are set aside with `quarantine`, and raise an error without it, before
    anything is written.
    """
    spark = messages.sparkSession
    set_aside = written_aside = 0
    folder = run_folder(spark, "batch", f"{root.rstrip('/')}/{SCRATCH}")
    try:
        if quarantine:
            flat, invalid, set_aside = parse_once(messages, f"{folder}/parsed")
            if set_aside:
                written_aside = append_quarantine(invalid, root, replay_safe, set_aside)
        else:
            flat = flatten_messages(messages, keep=_place(messages))
        survivors, extent = write_survivors(flat, f"{folder}/survivors")
        if not extent.kept:
            return BatchReport(read=set_aside, invalid=written_aside, dup_stored=set_aside - written_aside)
        if extent.untimed:
            raise ValueError(
                "messages without an arrival time belong to no week; quarantine sets them aside"
            )
        fresh = anti_join_stored(
            survivors,
            read_store(spark, root, n.SUCCESS, extent.weeks),
            extent.weeks,
            extent.id_range,
            extent.kept,
        )
        result = enrich_with_dictionary(
            fresh, dictionary, keep=_place(messages), dictionary_size=dictionary_size
        )
        routed = Observation()
        rows = write_once(
            result.observe(
                routed, F.count(n.SHOP_NAME).alias("matched"), F.count(F.lit(1)).alias("all")
            ),
            f"{folder}/result",
        )
        counts = {c: count or 0 for c, count in observed(routed, ("matched", "all")).items()}
        failed_before = None
        if replay_safe:
            before = read_store(spark, root, n.FAILED, extent.weeks, n.FAILED_DDL)
            failed_before = only_weeks(before, extent.weeks)
        success, failed = write_routed(rows, root, failed_before, max_rows_per_file, counts)
    finally:
        remove_folder(spark, folder)
    return BatchReport(
        read=extent.read + set_aside,
        invalid=extent.read - extent.valid + written_aside,
        dup_in_batch=extent.valid - extent.kept_valid,
        dup_stored=extent.kept - success - failed + set_aside - written_aside,
        success=success,
        failed=failed,
    )
