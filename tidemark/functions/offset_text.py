"""Offsets as text: the message connector's option format and the offset document.

Both render one row per topic out of one row per topic partition, so the lists
they collect are as long as a topic has partitions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as n


def _entries(offset: str) -> Column:
    """All (partition, offset) pairs of a group, in the order of the partition numbers."""
    return F.array_sort(
        F.collect_list(F.struct(F.col(n.PARTITION), F.col(offset).alias(n.OFFSET)))
    )


def _connector_text(offset: str) -> Column:
    by_partition = F.map_from_entries(
        F.transform(
            _entries(offset),
            lambda e: F.struct(e[n.PARTITION].cast("string").alias("k"), e[n.OFFSET].alias("v")),
        )
    )
    return F.to_json(F.create_map(F.col(n.TOPIC), by_partition))


def offsets_to_json(offsets: DataFrame, **columns: str) -> DataFrame:
    """Rows (topic, partition, offset) to (topic, `{"topic":{"0":1,"1":2}}`).

    `columns` maps each text to the offset column it renders; by default the text
    `offsets` renders `offset`.
    """
    columns = columns or {"offsets": n.OFFSET}
    return offsets.groupBy(n.TOPIC).agg(
        *[_connector_text(offset).alias(text) for text, offset in columns.items()]
    )


def encode_offset_document(offsets: DataFrame) -> DataFrame:
    """Rows (topic, partition, offset) to (topic, document)."""
    entries = F.transform(
        _entries(n.OFFSET),
        lambda e: F.struct(
            e[n.PARTITION].cast("string").alias("partitionIndex"), e[n.OFFSET].alias("offset")
        ),
    )
    document = F.struct(F.col(n.TOPIC), entries.alias("partitionDataList"))
    return offsets.groupBy(n.TOPIC).agg(F.to_json(document).alias("document"))


def decode_offset_document(documents: DataFrame, document: str = "document") -> DataFrame:
    """Documents back to rows (topic, partition, offset)."""
    parsed = documents.select(F.from_json(document, n.OFFSET_DOCUMENT_DDL).alias("d"))
    return parsed.select("d.topic", F.inline("d.partitionDataList")).select(
        n.TOPIC, F.col("partitionIndex").cast("int").alias(n.PARTITION), n.OFFSET
    )
