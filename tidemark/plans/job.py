"""The ingestion job over a message log table: bounded batches, offsets committed last."""

import logging
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark import names as n
from tidemark.functions.offset_text import offsets_to_json
from tidemark.operators.offsets import (
    COMMITTED,
    END,
    START,
    ending_offsets,
    local_bounds,
    local_offsets,
    log_range_scan,
    plan_unread,
    starting_offsets,
)
from tidemark.plans.batch import BatchReport, store_batch
from tidemark.sources import broker
from tidemark.sources.broker import read_range
from tidemark.sources.dictionary import jdbc_options, read_dictionary
from tidemark.sources.offset_table import claimed, commit_offsets, find_offsets
from tidemark.sources.store import store_path

logger = logging.getLogger(__name__)

DEFAULT_BATCH_SIZE = 5000


@dataclass(frozen=True)
class JobConfig:
    """What a run needs to know. `batch_size` caps the offsets per topic partition."""

    topic: str
    write_to: str
    dictionary: Mapping[str, str]
    dictionary_source: str = "jdbc"
    dictionary_columns: tuple[str, str] = (n.DICTIONARY_ID, n.DICTIONARY_NAME)
    batch_size: int = DEFAULT_BATCH_SIZE
    replay_safe: bool = False
    quarantine: bool = False
    max_rows_per_file: int | None = None
    broker: Mapping[str, str] = field(default_factory=dict)
    topic_partitions: int | None = None
    offsets: str | None = None

    @property
    def offsets_path(self) -> str:
        return self.offsets or store_path(self.write_to, "offsets")

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> "JobConfig":
        """The names of the variables; see also `__main__`.

        `JDBC_PARTITIONS` with `JDBC_LOWER_BOUND` and `JDBC_UPPER_BOUND` of the
        dictionary's id cuts its read into as many tasks.
        """
        cuts = int(env.get("JDBC_PARTITIONS", "1"))
        bounds = (int(env["JDBC_LOWER_BOUND"]), int(env["JDBC_UPPER_BOUND"])) if cuts > 1 else None
        return cls(
            topic=env["TOPIC_NAME"],
            write_to=env["WRITE_TO"],
            dictionary=jdbc_options(
                env["JDBC_URL"],
                "shops",
                env["DB_USER"],
                env["DB_PASSWORD"],
                env["DB_DRIVER"],
                bounds,
                cuts,
            ),
            batch_size=int(env.get("BATCH_SIZE", DEFAULT_BATCH_SIZE)),
            replay_safe=True,
            quarantine=env.get("QUARANTINE", "") in ("1", "true"),
            max_rows_per_file=int(env["MAX_ROWS_PER_FILE"]) if "MAX_ROWS_PER_FILE" in env else None,
            broker=broker.subscription(
                env["BOOTSTRAP_SERVERS"], env["TOPIC_NAME"], env.get("GROUP_ID")
            ),
            topic_partitions=int(env["TOPIC_PARTITIONS"]) if "TOPIC_PARTITIONS" in env else None,
        )


def warn_of_moves(config: JobConfig, plan: list[Row]) -> None:
    for row in plan:
        if row["moved"]:
            logger.log(
                logging.WARNING if row[START] < row[COMMITTED] else logging.INFO,
                "%s[%s]: offset %s is not in the log, reading from %s",
                config.topic,
                row[n.PARTITION],
                row[COMMITTED],
                row[START],
            )


def _store_and_commit(
    messages: DataFrame,
    dictionary: DataFrame,
    config: JobConfig,
    plan: list[Row],
    known: list[Row],
    dictionary_size: int | None = None,
) -> tuple[int, BatchReport]:
    """Stores first, offsets last: a crash between them reads the range again. The batch is
    claimed before, so that of two runs planned from the same offsets one stores nothing."""
    batch_id = max((row["batch_id"] for row in known), default=-1) + 1
    spark = messages.sparkSession
    with claimed(spark, config.offsets_path, config.topic, batch_id):
        report = store_batch(
            messages,
            dictionary,
            config.write_to,
            replay_safe=config.replay_safe,
            quarantine=config.quarantine,
            max_rows_per_file=config.max_rows_per_file,
            dictionary_size=dictionary_size,
        )
        commit_offsets(spark, plan, config.offsets_path, batch_id, known)
    logger.info("%s, batch %s: %s", config.topic, batch_id, report)
    return batch_id, report


def incremental_batch(
    log: DataFrame,
    dictionary: DataFrame,
    config: JobConfig,
    dictionary_size: int | None = None,
) -> tuple[int, BatchReport] | None:
    """Read, store and commit what follows the last commit; None if nothing does.

    A failure anywhere is raised and leaves the offsets as they were, so the next
    run reads the same range again.
    """
    spark = log.sparkSession
    log = log.filter(log[n.TOPIC] == config.topic)
    known = find_offsets(spark, config.offsets_path, config.topic).collect()
    plan = plan_unread(log, known, config.batch_size)
    if not plan:
        return None
    warn_of_moves(config, plan)
    messages = log_range_scan(log, plan)
    return _store_and_commit(messages, dictionary, config, plan, known, dictionary_size)


def load_dictionary(spark: SparkSession, config: JobConfig) -> DataFrame:
    return read_dictionary(
        spark, dict(config.dictionary), config.dictionary_source, *config.dictionary_columns
    )


def ingest_job(
    spark: SparkSession, log: DataFrame, config: JobConfig
) -> tuple[int, BatchReport] | None:
    """One run of the job: the dictionary as it is now, and one batch of the log."""
    dictionary = load_dictionary(spark, config)
    return incremental_batch(log, dictionary, config)


Reader = Callable[[dict[str, str]], DataFrame]


def broker_batch(
    spark: SparkSession,
    config: JobConfig,
    dictionary: DataFrame,
    reader: Reader | None = None,
    bounds: list[Row] | None = None,
) -> tuple[int, BatchReport] | None:
    """Plan a bounded range over the broker's topic, read exactly that, store and commit.

    `reader` makes a frame of the connector's options (`sources.broker.read_range` by
    default). `bounds` holds the first and next offset of each partition, where the broker
    was asked for them (`sources.broker.topic_bounds`). Without them what lies past the
    commits is read once to learn its extent, and nothing before that; the topic as a whole
    only as long as nothing is known of it. Only partitions with something new are read then,
    so that one without a message needs no offsets.
    """
    read = reader or partial(read_range, spark)
    servers, group = config.broker["kafka.bootstrap.servers"], config.broker.get("kafka.group.id")
    known = find_offsets(spark, config.offsets_path, config.topic).collect()
    if bounds is None:
        committed = {row[n.PARTITION]: row[n.OFFSET] for row in known}
        options = broker.tail_options(
            servers, config.topic, committed, range(config.topic_partitions or 0), group
        )
        bounds = broker.tail_bounds(read(options), config.topic, committed)
    starts = starting_offsets(local_bounds(spark, bounds), local_offsets(spark, known))
    plan = [r for r in ending_offsets(starts, config.batch_size).collect() if r[START] < r[END]]
    if not plan:
        return None
    warn_of_moves(config, plan)
    planned = local_offsets(spark, plan, START).withColumnRenamed(n.OFFSET, START)
    planned = planned.join(
        local_offsets(spark, plan, END).withColumnRenamed(n.OFFSET, END), [n.TOPIC, n.PARTITION]
    )
    texts = offsets_to_json(planned, starting_offsets=START, ending_offsets=END).first()
    options = broker.range_options(
        servers,
        config.topic,
        texts["starting_offsets"],
        texts["ending_offsets"],
        group,
        [row[n.PARTITION] for row in plan],
    )
    return _store_and_commit(read(options), dictionary, config, plan, known)


def reports_frame(spark: SparkSession, reports: list[tuple[int, BatchReport]]) -> DataFrame:
    """Reports as a table, one row per batch."""
    columns = list(asdict(BatchReport()))
    rows = [(batch_id, *asdict(report).values()) for batch_id, report in reports]
    ddl = ", ".join(f"{c} LONG" for c in ["batch_id", *columns])
    return spark.createDataFrame(rows, ddl)
