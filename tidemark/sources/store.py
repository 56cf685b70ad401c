"""The parquet stores of routed rows, laid out by year and week of arrival."""

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.messages import arrival_time, arrival_week, arrival_year
from tidemark.operators.dedup import missing_from, only_weeks
from tidemark.operators.enrich import matched, unmatched
from tidemark.scratch import observed
from tidemark.sources.compaction import has_any, is_compacted, readable_files

# Up to this many weeks are named one by one when a store is listed.
MAX_LISTED_WEEKS = 200


def store_path(root: str, store: str) -> str:
    return f"{root.rstrip('/')}/{store}"


def read_store(
    spark: SparkSession,
    root: str,
    store: str = n.SUCCESS,
    weeks: Sequence[tuple[int, int]] | None = None,
    schema: str = n.RESULT_DDL,
) -> DataFrame:
    """Rows of a store. One that was never written has none; other errors are raised.
    Files that a compaction has replaced are left out.

    With `weeks`, only the directories of these (year, week) pairs are listed, so
    that the cost of a batch does not grow with the age of the store.
    """
    base = path = store_path(root, store)
    folders = [f"{n.YEAR}=*/{n.WEEK_NUMBER}=*"]
    if weeks is not None:
        known = sorted({pair for pair in weeks if None not in pair})
        if not known:
            return _no_rows(spark, schema)
        if len(known) <= MAX_LISTED_WEEKS:
            folders = [f"{n.YEAR}={year}/{n.WEEK_NUMBER}={week}" for year, week in known]
            path = f"{base}/{{{','.join(folders)}}}"
    if not has_any(spark, base, folders):
        return _no_rows(spark, schema)
    paths = [path]
    if is_compacted(spark, base, folders):
        paths = readable_files(spark, base, folders)
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _no_rows(spark, schema)


def _no_rows(spark: SparkSession, schema: str) -> DataFrame:
    # A limit of zero is planned as an empty relation, and joins with it away.
    return spark.createDataFrame([], schema).limit(0)


def distribute_by_partition(rows: DataFrame) -> DataFrame:
    """Rows of one year and week together, so that a directory gets few files.

    A batch mostly falls into one week. Rebalancing lets adaptive execution cut
    that week into tasks of the advisory size, where a plain repartition would
    leave it to a single writer.
    """
    return rows.hint("rebalance", *n.STORE_PARTITIONS)


def append_partitioned(
    rows: DataFrame,
    path: str,
    max_rows_per_file: int | None = None,
    lookup: str | None = None,
) -> None:
    """Appends rows, one directory for each year and week.

    `lookup` names a column by which rows will be looked up: files are sorted by it and have
    Bloom filters for it, so that a lookup of few values reads few row groups although each
    file spans all values.
    """
    rows = distribute_by_partition(rows)
    if lookup is not None:
        rows = rows.sortWithinPartitions(*n.STORE_PARTITIONS, lookup)
    writer = rows.write.mode("append").partitionBy(*n.STORE_PARTITIONS)
    if lookup is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def append_success(rows: DataFrame, root: str, max_rows_per_file: int | None = None) -> None:
    """Appends to the success store, in which every batch looks its ids up."""
    lookup = n.ID if n.ID in rows.columns else None
    append_partitioned(rows, store_path(root, n.SUCCESS), max_rows_per_file, lookup)


def not_yet_in(rows: DataFrame, stored: DataFrame, row_count: int | None = None) -> DataFrame:
    """Rows a store does not hold; nulls compare as equal. Keeps a replay from adding
    failed rows twice, while orders sent again still accumulate.

    A row is known by the message it came from: its place in the log and its arrival
    time, as a topic created anew gives out its offsets again. Rows that do not know
    their place are told by arrival time and id.
    """
    place = [c for c in n.PLACE if c in rows.columns and c in stored.columns]
    key = [*n.STORE_PARTITIONS, n.RECEIVE_TIME, n.ID, *place]
    return missing_from(rows, stored, key, row_count, null_safe=True)


def write_routed(
    rows: DataFrame,
    root: str,
    failed_before: DataFrame | None = None,
    max_rows_per_file: int | None = None,
    counts: Mapping[str, int] | None = None,
) -> tuple[int, int]:
    """Matched rows to the success store, then the others to the failed store.

    Returns how many were written to each. `rows` is read once for each store and should be
    persisted or a written table; `counts` are its `matched` rows and `all` of them, where
    the caller has observed them. Failed rows that `failed_before` holds are not written
    again. Where rows know their place in the log, the failed store keeps it.
    """
    if counts is None:
        counts = rows.agg(
            F.count(n.SHOP_NAME).alias("matched"), F.count(F.lit(1)).alias("all")
        ).first().asDict()
    success, failed = counts["matched"], counts["all"] - counts["matched"]
    place = [c for c in n.PLACE if c in rows.columns]
    if success:
        append_success(matched(rows).drop(*place), root, max_rows_per_file)
    if failed:
        lost = unmatched(rows)
        if failed_before is not None:
            # Counted while they are written; a replay may leave none.
            seen = Observation()
            lost = not_yet_in(lost, failed_before, failed).observe(seen, F.count(F.lit(1)).alias("new"))
        append_partitioned(lost, store_path(root, n.FAILED), max_rows_per_file)
        if failed_before is not None:
            failed = observed(seen, ["new"])["new"] or 0
    return success, failed


def not_yet_aside(
    messages: DataFrame, root: str, replay_safe: bool = False, row_count: int | None = None
) -> DataFrame:
    """Invalid messages as they came, with year and week of arrival, that are to be set aside.
    On a replay, those already there are left out: a message is known by its place in the log
    and its arrival time. Only the weeks of these messages are looked at, and those without
    an arrival time lie together."""
    path = store_path(root, n.QUARANTINE)
    place = [c for c in n.PLACE if c in messages.columns]
    when = arrival_time()
    dated = messages.withColumns({n.YEAR: arrival_year(when), n.WEEK_NUMBER: arrival_week(when)})
    if not replay_safe or n.OFFSET not in place:
        return dated
    weeks = [tuple(r) for r in dated.select(*n.STORE_PARTITIONS).distinct().collect()]
    try:
        before = messages.sparkSession.read.schema(dated.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return dated
    undated = before.filter(F.col(n.YEAR).isNull())
    before = only_weeks(before, weeks)
    if any(None in pair for pair in weeks):
        before = before.unionByName(undated)
    key = [*n.STORE_PARTITIONS, "timestamp", *place]
    return missing_from(dated, before, key, row_count, null_safe=True)


def append_quarantine(
    messages: DataFrame, root: str, replay_safe: bool = False, row_count: int | None = None
) -> int:
    """Sets invalid messages aside, laid out by year and week of arrival; returns how many
    were written. For a replay see `not_yet_aside`."""
    dated = not_yet_aside(messages, root, replay_safe, row_count)
    written = dated.count()
    if written:
        append_partitioned(dated, store_path(root, n.QUARANTINE))
    return written
