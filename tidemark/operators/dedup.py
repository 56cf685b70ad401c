"""Duplicate removal inside a batch and against the stored history."""

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.scratch import observed, write_once

# Up to this many batch rows, the keys of a batch (16 bytes each) are broadcast.
SMALL_BATCH_ROWS = 500_000

# Up to this many ids of a batch are written out as literals.
LITERAL_IDS = 200

# Up to this many (year, week) pairs are written out as literals.
MAX_LITERAL_WEEKS = 1_000


def dedup_in_batch(
    flat: DataFrame,
    key: Sequence[str] = (n.ID,),
    order: Sequence[str] = (n.RECEIVE_TIME, *n.POSITION),
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the first in `order`, nulls last, ties decided by the other columns.

    Null keys form one group. The minimum is taken in the map tasks first, so a
    key that holds a third of all rows still sends one row per task. `copies`
    names a column for the number of rows a survivor stands for.
    """
    first = [c for c in order if c in flat.columns]
    rest = [c for c in flat.columns if c not in first and c not in key]
    nulls_last = [F.col(c).isNull().alias(f"__no_{c}") for c in first]
    ordered = [c for pair in zip(nulls_last, first, strict=True) for c in pair]
    survivor = F.min(F.struct(*ordered, *rest)).alias("__first")
    if copies is None:
        grouped = flat.groupBy(*key).agg(survivor)
        extra = []
    else:
        grouped = flat.groupBy(*key).agg(survivor, F.count(F.lit(1)).alias(copies))
        extra = [copies]
    return grouped.select(
        *[c if c in key else F.col(f"__first.{c}") for c in flat.columns], *extra
    )


def is_any_of(column: str, values: Sequence[int]) -> Column:
    """Equality with one of the values, as a balanced OR: unlike a long IN it reaches the scan
    as equalities, which Bloom filters can answer."""
    if len(values) <= 1:
        return F.col(column) == values[0] if values else F.lit(False)
    half = len(values) // 2
    return is_any_of(column, values[:half]) | is_any_of(column, values[half:])


def store_key(stored: DataFrame) -> DataFrame:
    """The columns by which a stored order is recognised."""
    return stored.select(*n.STORE_KEY)


def only_weeks(stored: DataFrame, weeks: Iterable[tuple[int, int]]) -> DataFrame:
    """Stored rows of the given (year, week) pairs.

    The store is laid out by year and week, and no partition pruning at run time
    applies to an anti join, so the pairs become literals. Pairs with a null
    match no stored key and are left out.
    """
    by_year: dict[int, set[int]] = {}
    for year, week in weeks:
        if year is not None and week is not None:
            by_year.setdefault(year, set()).add(week)
    if not by_year:
        return stored.filter(F.lit(False))
    if sum(map(len, by_year.values())) > MAX_LITERAL_WEEKS:
        return stored.filter(F.col(n.YEAR).between(min(by_year), max(by_year)))
    wanted = [
        (F.col(n.YEAR) == year) & F.col(n.WEEK_NUMBER).isin(sorted(found))
        for year, found in sorted(by_year.items())
    ]
    return stored.filter(reduce(lambda a, b: a | b, wanted))


def weeks_of(batch: DataFrame) -> list[tuple[int, int]]:
    """The distinct (year, week) pairs of a batch; as many as the batch spans weeks."""
    return [tuple(row) for row in batch.select(n.YEAR, n.WEEK_NUMBER).distinct().collect()]


def missing_from(
    rows: DataFrame,
    known: DataFrame,
    key: Sequence[str],
    row_count: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Rows whose key `known` does not hold. Nulls match nothing, or with `null_safe`
    one another.

    `row_count`, where known, bounds the number of `rows`. Up to `SMALL_BATCH_ROWS`
    their keys go to `known`, which then is not shuffled, and only the keys found
    there come back. `rows` are read twice in that case and should be persisted.
    """
    other = {c: F.col(f"__known_{c}") for c in key}
    known = known.select(*[F.col(c).alias(f"__known_{c}") for c in key])
    same = [F.col(c).eqNullSafe(o) if null_safe else F.col(c) == o for c, o in other.items()]
    if row_count is not None and row_count <= SMALL_BATCH_ROWS:
        asked = F.broadcast(rows.select(*key))
        known = F.broadcast(known.join(asked, same, "left_semi").distinct())
    return rows.join(known, same, "left_anti")


def anti_join_stored(
    batch: DataFrame,
    stored: DataFrame,
    weeks: Iterable[tuple[int, int]] | None = None,
    id_range: tuple[int, int] | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Batch rows whose (id, year, week) is not stored. Null keys match nothing.

    `weeks` and `id_range`, where known, are those of the batch; both are implied
    by the join key and only keep partitions and row groups of the store from
    being read. For `batch_rows` see `missing_from`; of up to `LITERAL_IDS` rows the ids are
    literals besides, for which row groups are left out by their Bloom filters.
    """
    known = store_key(stored)
    if weeks is not None:
        known = only_weeks(known, weeks)
    if id_range is not None and None not in id_range:
        known = known.filter(F.col(n.ID).between(*id_range))
    if batch_rows is not None and batch_rows <= LITERAL_IDS:
        ids = {row[0] for row in batch.select(n.ID).collect()} - {None}
        known = known.filter(is_any_of(n.ID, sorted(ids)))
    return missing_from(batch, known, n.STORE_KEY, batch_rows)


@dataclass(frozen=True)
class Extent:
    """What a batch spans: weeks that hold all of its, its ids, and how many rows and copies
    it has."""

    weeks: list[tuple[int | None, int | None]]
    id_range: tuple[int, int] | None
    kept: int
    kept_valid: int
    read: int
    valid: int
    untimed: bool = False


def weeks_between(first: dt.date, last: dt.date) -> list[tuple[int, int]]:
    """The (calendar year, ISO week) pairs of all days from one to another."""
    days = (first + dt.timedelta(d) for d in range((last - first).days + 1))
    return sorted({(day.year, day.isocalendar()[1]) for day in days})


def write_survivors(
    flat: DataFrame, path: str, key: Sequence[str] = (n.ID,)
) -> tuple[DataFrame, Extent]:
    """The survivors of a batch, with their copies, as a table at `path`, and their extent.

    The extent is observed while the table is written, in the tasks that write it, so that
    neither messages nor survivors are read for it. Its weeks are those between the first and
    the last day; a batch that spans more than `MAX_LITERAL_WEEKS` of them is asked for its own.
    """
    copies, valid = F.col(n.COPIES), F.col(n.ID).isNotNull()
    day = F.to_date(n.RECEIVE_TIME)
    seen = Observation()
    survivors = dedup_in_batch(flat, key, copies=n.COPIES).observe(
        seen,
        F.count(F.lit(1)).alias("kept"),
        F.count(n.ID).alias("kept_valid"),
        F.coalesce(F.sum(copies), F.lit(0)).alias("read"),
        F.coalesce(F.sum(F.when(valid, copies)), F.lit(0)).alias("valid"),
        F.min(n.ID).alias("low"),
        F.max(n.ID).alias("high"),
        F.min(day).alias("first"),
        F.max(day).alias("last"),
        F.count_if(F.col(n.RECEIVE_TIME).isNull()).alias("untimed"),
    )
    table = write_once(survivors, path)
    numbers = ("kept", "kept_valid", "read", "valid", "untimed")
    found = observed(seen, (*numbers, "low", "high", "first", "last"))
    found |= {c: found[c] or 0 for c in numbers}
    weeks = []
    if found["first"] is not None:
        if (found["last"] - found["first"]).days <= 7 * MAX_LITERAL_WEEKS:
            weeks = weeks_between(found["first"], found["last"])
        else:
            weeks = [pair for pair in weeks_of(table) if None not in pair]
    counts = {c: found[c] for c in numbers[:-1]}
    id_range = None if found["low"] is None else (found["low"], found["high"])
    return table, Extent(weeks, id_range, **counts, untimed=found["untimed"] > 0)


def known_keys(stored: DataFrame, extent: Extent | None) -> DataFrame:
    """Keys of the store; with an extent only those that the batch may hold."""
    known = store_key(stored)
    if extent is not None:
        known = only_weeks(known, extent.weeks)
        if extent.id_range is not None:
            known = known.filter(F.col(n.ID).between(*extent.id_range))
    return known


def dedup_incremental(
    flat: DataFrame, stored: DataFrame | None, extent: Extent | None = None
) -> DataFrame:
    """Survivors of the batch that are not stored yet; with no store, all of them.

    One plan: nothing runs or is written here. An `extent` of the batch, where it is known,
    keeps weeks and row groups of the store from being read.
    """
    survivors = dedup_in_batch(flat)
    if stored is None:
        return survivors
    return missing_from(survivors, known_keys(stored, extent), n.STORE_KEY)
