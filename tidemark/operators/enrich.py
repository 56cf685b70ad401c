"""Left join of orders with the dictionary, and routing by its outcome."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n

# A dictionary is broadcast up to this size in memory.
BROADCAST_BYTES = 64 * 1024 * 1024

# Memory a hashed row takes besides its name: row header, key, name offset, slot.
_ROW_BYTES = 64

_KEY = "__dictionary_id"


def dictionary_bytes(dictionary: DataFrame) -> int:
    """Size of the dictionary once hashed. One job; reads the name column only."""
    name_bytes = F.coalesce(F.octet_length(n.DICTIONARY_NAME), F.lit(0)) + F.lit(_ROW_BYTES)
    return dictionary.agg(F.coalesce(F.sum(name_bytes), F.lit(0))).first()[0]


def result_projection(joined: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of a stored row, in their order. `keep` adds others, such as shop_id."""
    return joined.select(*n.RESULT_COLUMNS, *keep)


def enrich_with_dictionary(
    orders: DataFrame,
    dictionary: DataFrame,
    keep: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    dictionary_size: int | None = None,
) -> DataFrame:
    """Every order with the name of its shop, null where the dictionary has none.

    The dictionary is broadcast if it measures at most `broadcast_bytes`;
    `dictionary_size` is its size where it was measured before. Beyond
    that both sides are shuffled by shop, and adaptive execution splits the tasks
    of a shop, or of the missing shop, that holds a large share of the orders.
    """
    shops = dictionary.select(
        F.col(n.DICTIONARY_ID).cast("long").alias(_KEY),
        F.col(n.DICTIONARY_NAME).alias(n.SHOP_NAME),
    )
    if dictionary_size is None:
        dictionary_size = dictionary_bytes(dictionary)
    if dictionary_size <= broadcast_bytes:
        shops = F.broadcast(shops)
    else:
        shops = shops.hint("merge")
    joined = orders.join(shops, orders[n.SHOP_ID] == shops[_KEY], "left")
    return result_projection(joined, keep)


def matched(enriched: DataFrame) -> DataFrame:
    """Rows with a dictionary match."""
    return enriched.filter(F.col(n.SHOP_NAME).isNotNull())


def unmatched(enriched: DataFrame) -> DataFrame:
    """Rows without a dictionary match."""
    return enriched.filter(F.col(n.SHOP_NAME).isNull())


def route() -> Column:
    """The store a row belongs to."""
    return F.when(F.col(n.SHOP_NAME).isNull(), F.lit(n.FAILED)).otherwise(F.lit(n.SUCCESS))


def dictionary_lookup(dictionary: DataFrame, shop_id: int) -> DataFrame:
    """Name of one shop; filter and column list are left to the source."""
    return dictionary.filter(F.col(n.DICTIONARY_ID) == shop_id).select(n.DICTIONARY_NAME)


def sort_by_partition(rows: DataFrame) -> DataFrame:
    """Rows in the order of year and week, nulls first; for display, not for writing.

    Arrival time and id follow in the sort key, so that one week may be cut into
    several ranges and does not end up in a single task.
    """
    ties = [c for c in (n.RECEIVE_TIME, n.ID) if c in rows.columns]
    return rows.orderBy(n.YEAR, n.WEEK_NUMBER, *ties)
