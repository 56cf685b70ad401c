import datetime as dt

import pytest

from tidemark import names as n
from tidemark.functions.messages import flatten_messages, parse_messages, split_parsed

TEXT_LOG = "key string, value string, timestamp string"


def test_flat_schema_and_blanks_around_a_time(spark):
    value = '{"shopId": 31, "extra": [1], "timestamp":" 2019-11-30 06:07:08  ", "id":77}'
    log = spark.createDataFrame([(None, value, "2020-03-04 05:06:07")], TEXT_LOG)
    flat = flatten_messages(log)
    assert flat.dtypes == [
        ("id", "bigint"),
        ("shop_id", "bigint"),
        ("receive_time", "timestamp"),
        ("order_timestamp", "timestamp"),
        ("year", "int"),
        ("week_number", "int"),
    ]
    assert tuple(flat.first()) == (
        77,
        31,
        dt.datetime(2020, 3, 4, 5, 6, 7),
        dt.datetime(2019, 11, 30, 6, 7, 8),
        2020,
        10,
    )


@pytest.mark.parametrize(
    "value, expected",
    [
        ("not json", (None, None, None)),
        (None, (None, None, None)),
        ("", (None, None, None)),
        ('{"id":"x","timestamp":"bad","shopId":3}', (None, None, 3)),
        ('{"id":5}', (5, None, None)),
        (
            '{"id":"7","timestamp":1640995200,"shopId":1.5}',
            (None, dt.datetime(2022, 1, 1), None),
        ),
        ('[{"id":9}]', (None, None, None)),
        ('{"id":1,"id":2}', (2, None, None)),
        ('{"ID":3}', (None, None, None)),
        ('{"id":99999999999999999999,"shopId":4}', (None, None, 4)),
        ('{"id":64,"shopId":7} ,"', (64, None, 7)),
        ('{"timestamp":"2018-02-03 04:05:06","id":8}}]', (8, dt.datetime(2018, 2, 3, 4, 5, 6), None)),
    ],
)
def test_malformed_values_become_nulls(spark, value, expected):
    log = spark.createDataFrame([("key", value, "2022-01-01 00:00:00")], TEXT_LOG)
    row = flatten_messages(log).select(n.ID, n.ORDER_TIMESTAMP, n.SHOP_ID).first()
    assert tuple(row) == expected


def test_malformed_arrival_time_is_null(spark):
    log = spark.createDataFrame([("key", '{"id":1}', "soon")], TEXT_LOG)
    row = flatten_messages(log).first()
    assert (row[n.ID], row[n.RECEIVE_TIME], row[n.YEAR]) == (1, None, None)


@pytest.mark.parametrize(
    "day, year, week", [("2021-01-03", 2021, 53), ("2024-12-30", 2024, 1), ("2022-01-01", 2022, 52)]
)
def test_calendar_year_with_iso_week(spark, day, year, week):
    log = spark.createDataFrame([("key", "{}", day)], TEXT_LOG)
    assert tuple(flatten_messages(log).select(n.YEAR, n.WEEK_NUMBER).first()) == (year, week)


def test_split_invalid_keeps_every_message(spark):
    rows = [
        ("a", '{"id":1,"shopId":2}', "2022-01-01"),
        ("b", "not json", "2022-01-01"),
        ("c", None, "2022-01-01"),
        ("d", '{"id":"x","shopId":3}', "2022-01-01"),
        ("e", '{"id":2,"shopId":3}', None),
    ]
    log = spark.createDataFrame(rows, TEXT_LOG)
    valid, invalid = split_parsed(parse_messages(log))
    assert [tuple(r) for r in valid.collect()] == [tuple(flatten_messages(log).first())]
    assert sorted(r["key"] for r in invalid.collect()) == ["b", "c", "d", "e"]
    assert invalid.columns == log.columns


def test_payload_is_parsed_once(spark, plan_of):
    log = spark.createDataFrame([("key", "{}", "2022-01-01")], TEXT_LOG)
    assert plan_of(flatten_messages(log)).count("from_json(") == 1
