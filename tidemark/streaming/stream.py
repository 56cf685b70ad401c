"""The ingestion job as a stream: the checkpoint keeps the offsets."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import names as n
from tidemark.functions.messages import parse_payload, value_text
from tidemark.plans.batch import BatchReport, store_batch


def first_within(messages: DataFrame, horizon: str) -> DataFrame:
    """Messages of a stream without those whose order came before within the horizon.

    The stream's state holds each id until the newest arrival time is `horizon` past it. It
    differs from the dedup against the stores: the first message seen wins, not the earliest
    one; weeks do not matter; and ids older than the horizon are forgotten. Spark passes over
    messages that arrive more than `horizon` behind the newest one of earlier micro-batches, so
    it must exceed the disorder of the log. Messages without an id are all kept.
    """
    order = parse_payload(value_text())["id"]
    place = F.when(order.isNull(), F.concat_ws(":", *n.PLACE))
    keyed = messages.withColumns({"__order": order, "__place": place})
    kept = keyed.withWatermark("timestamp", horizon)
    return kept.dropDuplicatesWithinWatermark(["__order", "__place"]).drop("__order", "__place")


def ingest_stream(
    messages: DataFrame,
    dictionary: Callable[[], DataFrame],
    write_to: str,
    checkpoint: str,
    quarantine: bool = False,
    max_rows_per_file: int | None = None,
    on_batch: Callable[[int, BatchReport], None] | None = None,
    horizon: str | None = None,
) -> StreamingQuery:
    """Read everything there is in bounded micro-batches, store each, and stop.

    How much a micro-batch holds is the source's affair (`maxOffsetsPerTrigger`,
    `maxFilesPerTrigger`). The dictionary is read anew for each one. A micro-batch
    that runs again after a crash adds no row twice: its success rows are found
    stored, and its failed rows are told by the messages they came from. With a `horizon`
    (`"3 days"`) copies within it are left out by the stream's state before a batch looks for
    them in the stores; see `first_within`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        report = store_batch(
            batch,
            dictionary(),
            write_to,
            replay_safe=True,
            quarantine=quarantine,
            max_rows_per_file=max_rows_per_file,
        )
        if on_batch is not None:
            on_batch(batch_id, report)

    if horizon is not None:
        messages = first_within(messages, horizon)
    return (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
