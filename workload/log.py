"""The test tables seen as a message log, a dictionary and a stored history."""

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n

TOPIC = "orders"
TOPIC_PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message, and every tenth one a second time an hour later.

    Every 97th event carries a truncated text. Offsets rise with the event number
    and leave gaps, as in a compacted log, so no sort is needed to assign them.
    """
    deliveries = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    payload = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.col("user_id").alias("shopId"),
        )
    )
    arrival = F.col("ts") + F.make_dt_interval(hours=F.col("delivery"))
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "ts", "user_id", F.explode(deliveries).alias("delivery"))
        .select(
            F.col("event_id").cast("string").cast("binary").alias("key"),
            F.when(F.col("event_id") % 97 == 0, F.lit('{"id":'))
            .otherwise(payload)
            .cast("binary")
            .alias("value"),
            F.lit(TOPIC).alias(n.TOPIC),
            (F.col("user_id") % TOPIC_PARTITIONS).cast("int").alias(n.PARTITION),
            (F.col("event_id") * 2 + F.col("delivery")).alias(n.OFFSET),
            arrival.cast("timestamp").alias("timestamp"),
        )
    )


def option_reader(log: DataFrame) -> Callable[[Mapping[str, str]], DataFrame]:
    """Reads a log table as the connector reads a topic: by its two offset options."""

    def read(options: Mapping[str, str]) -> DataFrame:
        assigned = json.loads(options.get("assign", "{}"))
        (topic,) = assigned or [options["subscribe"]]
        rows = log.filter(F.col(n.TOPIC) == topic)
        if assigned:
            rows = rows.filter(F.col(n.PARTITION).isin(assigned[topic]))
        starting, ending = options["startingOffsets"], options["endingOffsets"]
        if starting != "earliest":
            rows = rows.filter(_limited(json.loads(starting)[topic], lambda o, b: o >= b))
        if ending != "latest":
            rows = rows.filter(_limited(json.loads(ending)[topic], lambda o, b: o < b))
        return rows

    def _limited(limits, compare):
        wanted = F.lit(False)
        for partition, bound in limits.items():
            wanted |= (F.col(n.PARTITION) == int(partition)) & compare(F.col(n.OFFSET), bound)
        return wanted

    return read


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias(n.DICTIONARY_ID), F.col("s_name").alias(n.DICTIONARY_NAME)
    )


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders a former run has stored: every seventh well-formed event, on first arrival."""
    arrival = F.col("ts").cast("timestamp")
    return (
        table(spark, sf_dir, "events")
        .filter((F.col("event_id") % 7 == 0) & (F.col("event_id") % 97 != 0))
        .select(
            arrival.alias(n.RECEIVE_TIME),
            F.col("event_id").alias(n.ID),
            F.date_trunc("second", arrival).alias(n.ORDER_TIMESTAMP),
            F.lit("earlier run").alias(n.SHOP_NAME),
            F.year(arrival).alias(n.YEAR),
            F.weekofyear(arrival).alias(n.WEEK_NUMBER),
        )
    )
