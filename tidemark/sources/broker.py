"""Message broker as a source: options of Spark's connector.

The connector jar comes with the cluster (`--packages`), not with this package.
"""

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark import names as n
from tidemark.operators.offsets import EARLIEST, LATEST, log_bounds

# Fixed value of the connector: in an offset text, the first offset of a partition.
FIRST_OFFSET = -2


def subscription(servers: str, topic: str, group: str | None = None) -> dict[str, str]:
    """Options that name a topic and where it is served."""
    options = {"subscribe": topic, "kafka.bootstrap.servers": servers}
    if group:
        options["kafka.group.id"] = group
    return options


def range_options(
    servers: str,
    topic: str,
    starting: str,
    ending: str,
    group: str | None = None,
    partitions: Iterable[int] | None = None,
) -> dict[str, str]:
    """Options for a bounded read; both offset texts as `offsets_to_json` renders them.

    Start offsets are included, end offsets are not. The connector wants every partition
    that it reads named in the texts: all of the topic's, or the given `partitions`.
    """
    options = subscription(servers, topic, group)
    if partitions is not None:
        del options["subscribe"]
        options["assign"] = json.dumps({topic: sorted(partitions)})
    return {**options, "startingOffsets": starting, "endingOffsets": ending}


def tail_options(
    servers: str,
    topic: str,
    committed: Mapping[int, int],
    partitions: Iterable[int] = (),
    group: str | None = None,
) -> dict[str, str]:
    """Options for what lies past the committed offsets (partition: offset).

    `partitions` names those of the topic that may have no commit yet; they are read from
    their first offset. A topic of which nothing is known at all is read as a whole. One
    that has other partitions besides is refused by the connector, not read in part.
    """
    starts = dict.fromkeys(partitions, FIRST_OFFSET) | dict(committed)
    starting = "earliest"
    if starts:
        named = {str(partition): starts[partition] for partition in sorted(starts)}
        starting = json.dumps({topic: named}, separators=(",", ":"))
    return range_options(servers, topic, starting, "latest", group)


def tail_bounds(tail: DataFrame, topic: str, committed: Mapping[int, int]) -> list[Row]:
    """First and next offset of each partition as far as the messages past the commits tell:
    a partition without any ends at its commit, one without a commit either is left out."""
    found = {row[n.PARTITION]: row for row in log_bounds(tail).collect()}
    idle = [
        Row(**{n.TOPIC: topic, n.PARTITION: partition, EARLIEST: offset, LATEST: offset})
        for partition, offset in committed.items()
        if partition not in found
    ]
    return [*found.values(), *idle]


def topic_bounds(spark: SparkSession, servers: str, topic: str) -> list[Row]:
    """First and next offset of each partition, empty ones included, asked of the broker by a
    consumer of the connector's own client library: no message is read."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for key in ("key", "value"):
        settings.put(f"{key}.deserializer", "org.apache.kafka.common.serialization.ByteArrayDeserializer")
    settings.put("bootstrap.servers", servers)
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
    try:
        places = jvm.java.util.ArrayList()
        for info in consumer.partitionsFor(topic):
            places.add(jvm.org.apache.kafka.common.TopicPartition(topic, info.partition()))
        first, following = consumer.beginningOffsets(places), consumer.endOffsets(places)
        return [
            Row(**{n.TOPIC: topic, n.PARTITION: p.partition(), EARLIEST: first[p], LATEST: following[p]})
            for p in places
        ]
    finally:
        consumer.close()


def read_range(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("kafka").options(**options).load()


def read_stream(
    spark: SparkSession,
    options: dict[str, str],
    offsets_per_batch: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """The topic as a stream; its checkpoint keeps the offsets, so nothing is planned here.

    `starting` counts for the first run alone: offsets kept elsewhere so far are given
    as `offsets_to_json` renders them.
    """
    reader = spark.readStream.format("kafka").options(**options)
    reader = reader.option("startingOffsets", starting)
    if offsets_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(offsets_per_batch))
    return reader.load()
