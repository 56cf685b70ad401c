"""One query per operator over the test tables."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions import messages as m
from tidemark.functions.offset_text import (
    decode_offset_document,
    encode_offset_document,
    offsets_to_json,
)
from tidemark.operators import dedup, enrich, metrics, offsets, slices
from tidemark.plans import backfill as backfill_plan
from tidemark.plans import job
from tidemark.plans.batch import process_batch, store_batch
from tidemark.scratch import run_folder
from tidemark.sources import broker, compaction, offset_table, store
from tidemark.sources.dictionary import read_dictionary
from tidemark.streaming.stream import ingest_stream
from workload.log import (
    TOPIC,
    TOPIC_PARTITIONS,
    dictionary,
    message_log,
    option_reader,
    stored_history,
    table,
)

FILES_PER_SLICE = 4

Query = Callable[[SparkSession, str], DataFrame]


# Building blocks


def flat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.flatten_messages(message_log(spark, sf_dir), keep=n.POSITION)


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_in_batch(flat_orders(spark, sf_dir))


def fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.anti_join_stored(deduped(spark, sf_dir), stored_history(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_with_dictionary(fresh(spark, sf_dir), dictionary(spark, sf_dir))


def offset_state(bounds: DataFrame) -> DataFrame:
    """Two commits: partition 3 never, partition 2 once, partition 0 up to near its end."""
    span = F.expr(f"{offsets.LATEST} - {offsets.EARLIEST}")
    quarter = F.col(offsets.EARLIEST) + F.floor(span / 4)
    half = F.col(offsets.EARLIEST) + F.floor(span / 2)
    commits = F.array(
        F.struct(quarter.alias(n.OFFSET), F.lit(1).cast("long").alias("batch_id")),
        F.struct(
            F.when(F.col(n.PARTITION) == 0, F.col(offsets.LATEST) - 100)
            .otherwise(half)
            .alias(n.OFFSET),
            F.lit(2).cast("long").alias("batch_id"),
        ),
    )
    return (
        bounds.filter(F.col(n.PARTITION) < 3)
        .select(n.TOPIC, n.PARTITION, F.inline(commits))
        .filter((F.col("batch_id") == 1) | (F.col(n.PARTITION) < 2))
    )


def state_of(log: DataFrame) -> DataFrame:
    return offset_state(offsets.log_bounds(log))


def part_of_log(log: DataFrame, parts: int) -> int:
    """A batch cap that grows with the log, so that it is read in `parts` batches."""
    span = log.agg(F.max(n.OFFSET) + 1 - F.min(n.OFFSET)).first()[0]
    return span // parts + 1


def quarter_plan(log: DataFrame) -> DataFrame:
    committed = offsets.committed_offsets(state_of(log), TOPIC)
    return offsets.plan_offsets(log, committed, part_of_log(log, 4))


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log as a table of its own, as a job finds it."""
    path = run_folder(spark, "log")
    message_log(spark, sf_dir).write.partitionBy(n.TOPIC, n.PARTITION).parquet(path)
    return spark.read.schema(n.LOG_DDL).parquet(path)


def both_stores(spark: SparkSession, root: str) -> DataFrame:
    success, failed = (
        store.read_store(spark, root, name).withColumn(n.ROUTE, F.lit(name))
        for name in (n.SUCCESS, n.FAILED)
    )
    return success.unionByName(failed)


def job_config(spark: SparkSession, batch_size: int, sf_dir: str = "") -> job.JobConfig:
    return job.JobConfig(
        topic=TOPIC,
        write_to=run_folder(spark, "stores"),
        dictionary={"path": f"{sf_dir}/supplier.parquet"},
        dictionary_source="parquet",
        dictionary_columns=("s_suppkey", "s_name"),
        batch_size=batch_size,
    )


# Scans, sources, sinks


def kafka_range_source(spark, sf_dir):
    """Messages that a reader of the connector's options gives for a planned range."""
    texts = kafka_range_options(spark, sf_dir).first()
    options = broker.range_options(
        "broker:9092", texts["subscribe"], texts["starting_offsets"], texts["ending_offsets"]
    )
    rows = option_reader(message_log(spark, sf_dir))(options)
    return rows.select(n.PARTITION, n.OFFSET, m.value_text().alias("value"), "timestamp")


def kafka_range_options(spark, sf_dir):
    """The two offset options of a bounded read, as rendered for the connector."""
    texts = offsets_to_json(
        quarter_plan(message_log(spark, sf_dir)),
        starting_offsets=offsets.START,
        ending_offsets=offsets.END,
    )
    return texts.withColumnRenamed(n.TOPIC, "subscribe")


def log_range_scan(spark, sf_dir):
    log = message_log(spark, sf_dir)
    rows = offsets.log_range_scan(log, quarter_plan(log))
    return rows.select(n.PARTITION, n.OFFSET, m.value_text().alias("value"), "timestamp")


def dictionary_source(spark, sf_dir):
    options = {"path": f"{sf_dir}/supplier.parquet"}
    return read_dictionary(spark, options, "parquet", "s_suppkey", "s_name")


def store_scan(spark, sf_dir):
    root = run_folder(spark, "store")
    history = stored_history(spark, sf_dir)
    store.append_partitioned(history, store.store_path(root, n.SUCCESS))
    return store.read_store(spark, root)


def partitioned_append_sink(spark, sf_dir):
    path = run_folder(spark, "store")
    rows = enrich.enrich_with_dictionary(flat_orders(spark, sf_dir), dictionary(spark, sf_dir))
    store.append_partitioned(rows, path)
    return spark.read.schema(n.RESULT_DDL).parquet(path)


def routed_sink(spark, sf_dir):
    root = run_folder(spark, "stores")
    rows = enriched(spark, sf_dir).persist()
    store.write_routed(rows, root)
    rows.unpersist()
    return both_stores(spark, root)


def offset_state_read(spark, sf_dir):
    path = run_folder(spark, "offsets")
    state = state_of(message_log(spark, sf_dir))
    state.write.partitionBy(n.TOPIC).parquet(path)
    return offset_table.find_offsets(spark, path, TOPIC)


def offset_state_upsert(spark, sf_dir):
    log = message_log(spark, sf_dir)
    new = quarter_plan(log).select(
        n.TOPIC,
        n.PARTITION,
        F.col(offsets.END).alias(n.OFFSET),
        F.lit(3).cast("long").alias("batch_id"),
    )
    return offsets.upsert_offsets(state_of(log), new)


# Offset planning


def earliest_offsets(spark, sf_dir):
    return offsets.earliest_offsets(message_log(spark, sf_dir))


def latest_offsets(spark, sf_dir):
    return offsets.latest_offsets(message_log(spark, sf_dir))


def starting_offsets(spark, sf_dir):
    bounds = offsets.log_bounds(message_log(spark, sf_dir))
    return offsets.starting_offsets(bounds, offsets.committed_offsets(offset_state(bounds), TOPIC))


def ending_offsets(spark, sf_dir):
    return offsets.ending_offsets(starting_offsets(spark, sf_dir), job.DEFAULT_BATCH_SIZE)


def plan_offsets(spark, sf_dir):
    return quarter_plan(message_log(spark, sf_dir))


def offsets_json(spark, sf_dir):
    return offsets_to_json(offsets.latest_offsets(message_log(spark, sf_dir)))


def offset_document_codec(spark, sf_dir):
    committed = offsets.committed_offsets(state_of(message_log(spark, sf_dir)), TOPIC)
    documents = encode_offset_document(committed)
    return decode_offset_document(documents).join(documents, n.TOPIC)


# Projections


def value_to_string(spark, sf_dir):
    return message_log(spark, sf_dir).select(
        n.PARTITION, n.OFFSET, m.value_text().alias("value")
    )


def parse_json(spark, sf_dir):
    parsed = m.parse_payload(F.col("props"), "k INT")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


def flatten_struct(spark, sf_dir):
    parsed = message_log(spark, sf_dir).select(
        m.parse_payload(m.value_text()).alias("order"), *n.POSITION
    )
    return parsed.select(*m.flatten_struct("order"), *n.POSITION)


def to_timestamp_cast(spark, sf_dir):
    text = F.when(F.col("event_id") % 97 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("timestamp"))
    return texts.select("event_id", m.arrival_time().alias(n.RECEIVE_TIME))


def arrival_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", m.arrival_year("o_orderdate").alias(n.YEAR)
    )


def arrival_week(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", m.arrival_week("o_orderdate").alias(n.WEEK_NUMBER)
    )


def flatten_messages(spark, sf_dir):
    return m.flatten_messages(message_log(spark, sf_dir))


def dedup_key_projection(spark, sf_dir):
    return dedup.store_key(stored_history(spark, sf_dir))


def result_projection(spark, sf_dir):
    return enrich.enrich_with_dictionary(flat_orders(spark, sf_dir), dictionary(spark, sf_dir))


# Filters, joins


def matched_filter(spark, sf_dir):
    return enrich.matched(enriched(spark, sf_dir))


def unmatched_filter(spark, sf_dir):
    return enrich.unmatched(enriched(spark, sf_dir))


def dictionary_lookup(spark, sf_dir):
    return enrich.dictionary_lookup(dictionary(spark, sf_dir), 3)


def enrich_with_dictionary(spark, sf_dir):
    return enrich.enrich_with_dictionary(deduped(spark, sf_dir), dictionary(spark, sf_dir))


# Distinct, counts


def dedup_in_batch_untimed(spark, sf_dir):
    """Texts of which every third holds no time: a copy that has one goes first."""
    untimed = F.col(n.OFFSET) % 3 == 0
    flat = flat_orders(spark, sf_dir)
    return dedup.dedup_in_batch(
        flat.withColumns(
            {
                c: F.when(~untimed, F.col(c))
                for c in (n.RECEIVE_TIME, n.YEAR, n.WEEK_NUMBER)
            }
        )
    )


def dedup_in_batch_lineitem(spark, sf_dir):
    return dedup.dedup_in_batch(
        table(spark, sf_dir, "lineitem"),
        key=["l_orderkey", "l_linenumber"],
        order=[
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
        ],
    )


def dedup_incremental(spark, sf_dir):
    return dedup.dedup_incremental(flat_orders(spark, sf_dir), store_scan(spark, sf_dir))


def batch_counts(spark, sf_dir):
    return metrics.batch_counts(
        flat_orders(spark, sf_dir), stored_history(spark, sf_dir), dictionary(spark, sf_dir)
    )


# Order, distribution


def sort_by_partition(spark, sf_dir):
    return enrich.sort_by_partition(enriched(spark, sf_dir))


def distribute_by_partition(spark, sf_dir):
    return store.distribute_by_partition(flatten_messages(spark, sf_dir))


# Incremental


def incremental_batch(spark, sf_dir):
    log = log_table(spark, sf_dir)
    config = job_config(spark, part_of_log(log, 3))
    job.incremental_batch(log, dictionary(spark, sf_dir), config)
    return both_stores(spark, config.write_to)


def backfill(spark, sf_dir):
    log = log_table(spark, sf_dir)
    config = job_config(spark, part_of_log(log, 3))
    backfill_plan.backfill(log, dictionary(spark, sf_dir), config)
    return both_stores(spark, config.write_to)


def batch_slices(spark, sf_dir):
    """The ranges that a backfill gives each batch, from bitmaps of the offsets."""
    log = message_log(spark, sf_dir)
    return slices.batch_slices(log, part_of_log(log, 3), backfill_plan.AT_ONCE)


def broker_batches(spark, sf_dir):
    """Batches planned and read by the connector's options, until nothing is new."""
    log = log_table(spark, sf_dir)
    config = replace(
        job_config(spark, part_of_log(log, 3)),
        broker=broker.subscription("broker:9092", TOPIC),
        topic_partitions=TOPIC_PARTITIONS,
    )
    shops, read = dictionary(spark, sf_dir), option_reader(log)
    while job.broker_batch(spark, config, shops, read):
        pass
    return both_stores(spark, config.write_to)


def quarantined_messages(spark, sf_dir):
    """What one batch sets aside, whole; its messages are parsed once."""
    root = run_folder(spark, "stores")
    log = message_log(spark, sf_dir).drop("key")
    store_batch(log, dictionary(spark, sf_dir), root, quarantine=True)
    aside = spark.read.parquet(store.store_path(root, n.QUARANTINE))
    return aside.select(
        n.PARTITION, n.OFFSET, m.value_text().alias("value"), "timestamp", n.YEAR, n.WEEK_NUMBER
    )


def compacted_store(spark, sf_dir):
    """The success store of three batches after all its weeks were compacted."""
    root = run_folder(spark, "stores")
    rows = enrich.matched(enriched(spark, sf_dir)).persist()
    for part in range(3):
        store.append_success(rows.filter(F.col(n.ID) % 3 == part), root)
    rows.unpersist()
    weeks = store.read_store(spark, root).select(*n.STORE_PARTITIONS).distinct().collect()
    for week in weeks:
        compaction.compact_week(spark, root, n.SUCCESS, *week)
    return store.read_store(spark, root)


def stream_ingest(spark, sf_dir):
    """The log in three slices, as a backfill cuts it; each is one bounded micro-batch."""
    log_path, root, checkpoint = (run_folder(spark, x) for x in ("log", "stores", "stream"))
    log = log_table(spark, sf_dir)
    size, known = part_of_log(log, 3), {}
    while plan := offsets.plan_unread(log, list(known.values()), size):
        known |= {
            r[n.PARTITION]: Row(topic=r[n.TOPIC], partition=r[n.PARTITION], offset=r[offsets.END])
            for r in plan
        }
        rows = offsets.log_range_scan(log, plan).repartition(FILES_PER_SLICE)
        rows.write.mode("append").parquet(log_path)
    messages = (
        spark.readStream.schema(n.LOG_DDL)
        .option("maxFilesPerTrigger", str(FILES_PER_SLICE))
        .parquet(log_path)
    )
    shops = dictionary(spark, sf_dir)
    ingest_stream(messages, lambda: shops, root, checkpoint).awaitTermination()
    return both_stores(spark, root)


# Observability


def run_metrics(spark, sf_dir):
    return metrics.run_metrics(
        flat_orders(spark, sf_dir), stored_history(spark, sf_dir), dictionary(spark, sf_dir)
    )


def partition_lag(spark, sf_dir):
    log = message_log(spark, sf_dir)
    return metrics.partition_lag(log, offsets.committed_offsets(state_of(log), TOPIC))


def log_volume(spark, sf_dir):
    log = message_log(spark, sf_dir)
    return metrics.log_volume(log, offsets.committed_offsets(state_of(log), TOPIC))


def store_volume(spark, sf_dir):
    root = run_folder(spark, "stores")
    rows = enriched(spark, sf_dir).persist()
    store.write_routed(rows, root)
    rows.unpersist()
    success, failed = (
        metrics.store_volume(store.read_store(spark, root, name)).withColumn(
            n.ROUTE, F.lit(name)
        )
        for name in (n.SUCCESS, n.FAILED)
    )
    return success.unionByName(failed)


# Composites


def whole_batch(spark, sf_dir):
    """Messages to routed rows, against a stored history."""
    return process_batch(
        message_log(spark, sf_dir), dictionary(spark, sf_dir), stored_history(spark, sf_dir)
    )


def ingest_job(spark, sf_dir):
    """One run over the whole log, with stores that hold a history."""
    log = log_table(spark, sf_dir)
    config = job_config(spark, part_of_log(log, 1), sf_dir)
    store.append_partitioned(
        stored_history(spark, sf_dir), store.store_path(config.write_to, n.SUCCESS)
    )
    job.ingest_job(spark, log, config)
    return both_stores(spark, config.write_to)


def queries() -> dict[str, Query]:
    return {
        "kafka_range_source": kafka_range_source,
        "kafka_range_options": kafka_range_options,
        "log_range_scan": log_range_scan,
        "dictionary_source": dictionary_source,
        "store_scan": store_scan,
        "partitioned_append_sink": partitioned_append_sink,
        "routed_sink": routed_sink,
        "offset_state_read": offset_state_read,
        "offset_state_upsert": offset_state_upsert,
        "earliest_offsets": earliest_offsets,
        "latest_offsets": latest_offsets,
        "starting_offsets": starting_offsets,
        "ending_offsets": ending_offsets,
        "plan_offsets": plan_offsets,
        "offsets_to_json": offsets_json,
        "offset_document_codec": offset_document_codec,
        "value_to_string": value_to_string,
        "parse_json": parse_json,
        "flatten_struct": flatten_struct,
        "to_timestamp_cast": to_timestamp_cast,
        "arrival_year": arrival_year,
        "arrival_week": arrival_week,
        "flatten_messages": flatten_messages,
        "dedup_key_projection": dedup_key_projection,
        "result_projection": result_projection,
        "matched_filter": matched_filter,
        "unmatched_filter": unmatched_filter,
        "dictionary_lookup": dictionary_lookup,
        "enrich_with_dictionary": enrich_with_dictionary,
        "anti_join_stored": fresh,
        "dedup_in_batch": deduped,
        "dedup_in_batch_untimed": dedup_in_batch_untimed,
        "dedup_in_batch_lineitem": dedup_in_batch_lineitem,
        "dedup_incremental": dedup_incremental,
        "batch_counts": batch_counts,
        "sort_by_partition": sort_by_partition,
        "distribute_by_partition": distribute_by_partition,
        "incremental_batch": incremental_batch,
        "backfill": backfill,
        "batch_slices": batch_slices,
        "broker_batches": broker_batches,
        "quarantined_messages": quarantined_messages,
        "compacted_store": compacted_store,
        "stream_ingest": stream_ingest,
        "run_metrics": run_metrics,
        "partition_lag": partition_lag,
        "log_volume": log_volume,
        "store_volume": store_volume,
        "process_batch": whole_batch,
        "ingest_job": ingest_job,
    }
