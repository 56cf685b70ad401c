"""Column functions on messages, and their composition into the flat order table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n

_PARSED = "__payload"
_CORRUPT = "__corrupt"
VALID = "__valid"
RAW = "__message"


def value_text(value: str = "value") -> Column:
    """Message bytes as text."""
    return F.col(value).cast("string")


def parse_payload(text: Column, ddl: str = n.PAYLOAD_DDL) -> Column:
    """JSON text as a struct. Malformed text gives null fields, never an error.

    The mode is spelled out although it is the default: with no option given the
    optimizer splits the call into one pruned parse per field that is used.
    """
    return F.from_json(text, ddl, {"mode": "PERMISSIVE"})


def arrival_time(timestamp: str = "timestamp") -> Column:
    """Arrival time as a timestamp; null where a text does not hold one."""
    return F.col(timestamp).try_cast("timestamp")


def arrival_year(time: Column | str = n.RECEIVE_TIME) -> Column:
    """Calendar year of arrival. Near New Year it differs from the year of the ISO week."""
    return F.year(time)


def arrival_week(time: Column | str = n.RECEIVE_TIME) -> Column:
    """ISO week of arrival."""
    return F.weekofyear(time)


def flatten_struct(parsed: str = _PARSED) -> list[Column]:
    """Payload fields under the names of the flat order table."""
    return [
        F.col(f"{parsed}.id").alias(n.ID),
        F.col(f"{parsed}.shopId").alias(n.SHOP_ID),
        F.col(f"{parsed}.timestamp").alias(n.ORDER_TIMESTAMP),
    ]


def flatten_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Message log to flat order table, without a shuffle.

    `keep` names log columns to carry along, such as the position of a message.
    """
    parsed = messages.select(
        parse_payload(value_text()).alias(_PARSED),
        arrival_time().alias(n.RECEIVE_TIME),
        *keep,
    )
    return parsed.select(
        *flatten_struct(),
        n.RECEIVE_TIME,
        arrival_year().alias(n.YEAR),
        arrival_week().alias(n.WEEK_NUMBER),
        *keep,
    ).select(*n.FLAT_COLUMNS, *keep)


def parse_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Message log to flat order table, from one parse that also tells what is invalid.

    Besides the columns of `flatten_messages` a row has `VALID` and, if it is not, `RAW`: the
    message as it came. A message is invalid if its text does not parse into the payload, if
    the payload has no id, or if it has no arrival time.
    """
    flagged = messages.select(
        F.from_json(
            value_text(),
            f"{n.PAYLOAD_DDL}, {_CORRUPT} STRING",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
        ).alias(_PARSED),
        arrival_time().alias(n.RECEIVE_TIME),
        F.struct(*messages.columns).alias(RAW),
    )
    valid = (
        F.col(f"{_PARSED}.id").isNotNull()
        & F.col(f"{_PARSED}.{_CORRUPT}").isNull()
        & F.col(n.RECEIVE_TIME).isNotNull()
    )
    return flagged.select(
        *flatten_struct(),
        n.RECEIVE_TIME,
        arrival_year().alias(n.YEAR),
        arrival_week().alias(n.WEEK_NUMBER),
        *[F.col(f"{RAW}.{c}").alias(c) for c in keep],
        valid.alias(VALID),
        F.when(~valid, F.col(RAW)).alias(RAW),
    ).select(*n.FLAT_COLUMNS, *keep, VALID, RAW)


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(flat rows of valid messages, invalid messages as they came), of a written table."""
    valid = parsed.filter(VALID).drop(VALID, RAW)
    return valid, parsed.filter(~F.col(VALID)).select(f"{RAW}.*")
