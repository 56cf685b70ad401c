"""`spark-submit` entry: one run over the broker's topic, set by the environment.

`RUN=stream` (the default) catches up in micro-batches whose offsets a checkpoint keeps;
`RUN=batch` plans, reads and commits one bounded batch, as a scheduled job does. Besides
the variables of `JobConfig.from_env`: `TOPIC_PARTITIONS` (stream, required: the cap of
`BATCH_SIZE` is per topic partition, the connector's is for all of them together; batch:
partitions beyond those with a commit are looked at from their start), `BOUNDS=broker` (batch:
first and next offsets are asked of the broker instead of read from the topic's tail),
`HORIZON` (stream: copies that arrive within it, as `3 days`, are told by the stream's state),
`STARTING_OFFSETS` (stream, first run only; `earliest` by default), `QUARANTINE=1` and
`MAX_ROWS_PER_FILE`.
"""

import logging
import os

from pyspark.sql import SparkSession

from tidemark.plans.job import JobConfig, broker_batch, load_dictionary
from tidemark.sources.broker import read_stream, topic_bounds
from tidemark.sources.store import store_path
from tidemark.streaming.stream import ingest_stream

log = logging.getLogger("tidemark")


def run_stream(spark: SparkSession, config: JobConfig) -> None:
    partitions = int(os.environ["TOPIC_PARTITIONS"])
    query = ingest_stream(
        read_stream(
            spark,
            dict(config.broker),
            config.batch_size * partitions,
            os.environ.get("STARTING_OFFSETS", "earliest"),
        ),
        lambda: load_dictionary(spark, config),
        config.write_to,
        store_path(config.write_to, "checkpoint"),
        quarantine=config.quarantine,
        max_rows_per_file=config.max_rows_per_file,
        horizon=os.environ.get("HORIZON"),
        on_batch=lambda batch_id, report: log.info("batch %s: %s", batch_id, report),
    )
    query.awaitTermination()


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    config = JobConfig.from_env(os.environ)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    log.info("start, topic %s", config.topic)
    if os.environ.get("RUN", "stream") == "batch":
        bounds = None
        if os.environ.get("BOUNDS") == "broker":
            bounds = topic_bounds(spark, config.broker["kafka.bootstrap.servers"], config.topic)
        if broker_batch(spark, config, load_dictionary(spark, config), bounds=bounds) is None:
            log.info("nothing new")
    else:
        run_stream(spark, config)
    log.info("done")


if __name__ == "__main__":
    main()
