"""The SQL each query is compared with. Plain DuckDB over the test tables."""

from workload.log import TOPIC

LOG = f"""
deliveries as (
  select event_id, ts, user_id, 0 as delivery from events
  union all
  select event_id, ts, user_id, 1 as delivery from events where event_id % 10 = 0),
log as (
  select '{TOPIC}' as topic, cast(user_id % 4 as integer) as partition,
    event_id * 2 + delivery as "offset", ts + delivery * interval 1 hour as "timestamp",
    case when event_id % 97 = 0 then '{{"id":' else '{{"id":' || event_id || ',"timestamp":"'
      || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","shopId":' || user_id || '}}' end as value,
    event_id, ts, user_id
  from deliveries)"""

FLAT = f"""{LOG},
flat as (
  select case when event_id % 97 <> 0 then event_id end as id,
    case when event_id % 97 <> 0 then user_id end as shop_id,
    "timestamp" as receive_time,
    case when event_id % 97 <> 0 then date_trunc('second', ts) end as order_timestamp,
    cast(year("timestamp") as integer) as year, cast(week("timestamp") as integer) as week_number,
    partition, "offset"
  from log)"""

DEDUP = f"""{FLAT},
dedup as (
  select * from flat
  qualify row_number() over (partition by id order by receive_time, partition, "offset") = 1)"""

HISTORY = """
history as (
  select ts as receive_time, event_id as id, date_trunc('second', ts) as order_timestamp,
    'earlier run' as shop_name,
    cast(year(ts) as integer) as year, cast(week(ts) as integer) as week_number
  from events where event_id % 7 = 0 and event_id % 97 <> 0)"""

FRESH = f"""{DEDUP},{HISTORY},
fresh as (
  select * from dedup d where not exists (
    select 1 from history h
    where h.id = d.id and h.year = d.year and h.week_number = d.week_number))"""

ENRICHED = f"""{FRESH},
enriched as (
  select f.receive_time, f.id, f.order_timestamp, s.s_name as shop_name, f.year, f.week_number
  from fresh f left join supplier s on f.shop_id = s.s_suppkey)"""

ROUTE = "case when shop_name is null then 'failed' else 'success' end as route"

BOUNDS = f"""{LOG},
bounds as (
  select topic, partition, min("offset") as earliest_offset, max("offset") + 1 as latest_offset
  from log group by topic, partition)"""

# Commits: partition 3 never, partition 2 once, partition 0 up to near its end.
STATE = f"""{BOUNDS},
state as (
  select topic, partition, earliest_offset + (latest_offset - earliest_offset) // 4 as "offset",
    cast(1 as bigint) as batch_id
  from bounds where partition < 3
  union all
  select topic, partition,
    case when partition = 0 then latest_offset - 100
      else earliest_offset + (latest_offset - earliest_offset) // 2 end as "offset",
    cast(2 as bigint) as batch_id
  from bounds where partition < 2),
committed as (
  select topic, partition, arg_max("offset", batch_id) as "offset", max(batch_id) as batch_id
  from state group by topic, partition)"""

STARTS = f"""{STATE},
starts as (
  select b.topic, b.partition, b.earliest_offset, b.latest_offset,
    case when c."offset" between b.earliest_offset and b.latest_offset then c."offset"
      else b.earliest_offset end as start_offset,
    c."offset" is not null and c."offset" not between b.earliest_offset and b.latest_offset
      as moved,
    c."offset" as committed_offset
  from bounds b left join committed c on b.topic = c.topic and b.partition = c.partition)"""


def plan(cap: str) -> str:
    return f"""{STARTS},
plan as (
  select *, least(latest_offset, start_offset + {cap}) as end_offset from starts)"""


QUARTER = """(select (max("offset") + 1 - min("offset")) // 4 + 1 from log)"""
THIRD = """(select (max("offset") + 1 - min("offset")) // 3 + 1 from log)"""

# Batches of the backfill: each starts at the next offset there is, and what is
# stored is looked at batch by batch.
SLICES = f"""{FLAT},
ranges as (
  select partition, 0 as slice, min("offset") as low,
    least(max("offset") + 1, min("offset") + {THIRD}) as high
  from log group by partition
  union all
  select r.partition, r.slice + 1, min(l."offset"),
    least(max(l."offset") + 1, min(l."offset") + {THIRD})
  from ranges r join log l on l.partition = r.partition and l."offset" >= r.high
  group by r.partition, r.slice, r.high),
sliced as (
  select f.*, r.slice
  from flat f join ranges r
    on f.partition = r.partition and f."offset" >= r.low and f."offset" < r.high),
kept as (
  select * from sliced
  qualify row_number() over (
    partition by slice, id order by receive_time, partition, "offset") = 1),
named as (
  select k.*, s.s_name as shop_name
  from kept k left join supplier s on k.shop_id = s.s_suppkey),
stored as (
  select * from named where shop_name is not null
  qualify row_number() over (partition by id, year, week_number order by slice) = 1),
refused as (
  select * from named x where shop_name is null and not exists (
    select 1 from stored s where s.id = x.id and s.year = x.year
      and s.week_number = x.week_number and s.slice < x.slice))"""

RESULT = "receive_time, id, order_timestamp, shop_name, year, week_number"


def _document(offset: str) -> str:
    return f"""'{{"topic":"' || topic || '","partitionDataList":[' || string_agg(
      '{{"partitionIndex":"' || partition || '","offset":' || {offset} || '}}', ','
      order by partition) || ']}}'"""


def _offsets_text(offset: str) -> str:
    return f"""'{{"' || topic || '":{{' || string_agg(
      '"' || partition || '":' || {offset}, ',' order by partition) || '}}}}'"""


def oracle_sql() -> dict[str, str]:
    sql = {
        # Scans, sources, sinks
        "kafka_range_source": f"""with {plan(QUARTER)}
            select l.partition, l."offset", l.value, l."timestamp"
            from log l join plan p on l.partition = p.partition
            where l."offset" >= p.start_offset and l."offset" < p.end_offset""",
        "kafka_range_options": f"""with {plan(QUARTER)}
            select topic as subscribe, {_offsets_text('start_offset')} as starting_offsets,
              {_offsets_text('end_offset')} as ending_offsets
            from plan group by topic""",
        "log_range_scan": f"""with {plan(QUARTER)}
            select l.partition, l."offset", l.value, l."timestamp"
            from log l join plan p on l.partition = p.partition
            where l."offset" >= p.start_offset and l."offset" < p.end_offset""",
        "dictionary_source": "select s_suppkey as id, s_name as name from supplier",
        "store_scan": f"with {HISTORY} select {RESULT} from history",
        "partitioned_append_sink": f"""with {FLAT}, named as (
              select receive_time, id, order_timestamp, s_name as shop_name, year, week_number
              from flat left join supplier on shop_id = s_suppkey)
            select {RESULT} from named""",
        "routed_sink": f"with {ENRICHED} select *, {ROUTE} from enriched",
        "offset_state_read": f"with {STATE} select * from committed",
        "offset_state_upsert": f"""with {plan(QUARTER)},
            after_commit as (
              select * from state
              union all
              select topic, partition, end_offset, cast(3 as bigint) from plan)
            select topic, partition, arg_max("offset", batch_id) as "offset",
              max(batch_id) as batch_id
            from after_commit group by topic, partition""",
        # Offset planning
        "earliest_offsets": f"""with {BOUNDS}
            select topic, partition, earliest_offset as "offset" from bounds""",
        "latest_offsets": f"""with {BOUNDS}
            select topic, partition, latest_offset as "offset" from bounds""",
        "starting_offsets": f"with {STARTS} select * from starts",
        "ending_offsets": f"with {plan('5000')} select * from plan",
        "plan_offsets": f"with {plan(QUARTER)} select * from plan",
        "offsets_to_json": f"""with {BOUNDS}
            select topic, {_offsets_text('latest_offset')} as offsets from bounds group by topic""",
        "offset_document_codec": f"""with {STATE},
            documents as (
              select topic, {_document('"offset"')} as document from committed group by topic)
            select c.topic, c.partition, c."offset", d.document
            from committed c join documents d on c.topic = d.topic""",
        # Projections
        "value_to_string": f"""with {LOG} select partition, "offset", value from log""",
        "parse_json": """select event_id, cast(regexp_extract(props, '[0-9]+') as integer) as k
            from events""",
        "flatten_struct": f"""with {FLAT}
            select id, shop_id, order_timestamp, partition, "offset" from flat""",
        "to_timestamp_cast": """select event_id,
              try_cast(case when event_id % 97 = 0 then 'not a time' else
                strftime(ts, '%Y-%m-%d %H:%M:%S') end as timestamp) as receive_time
            from events""",
        "arrival_year": """select o_orderkey, cast(year(o_orderdate) as integer) as year
            from orders""",
        "arrival_week": """select o_orderkey, cast(week(o_orderdate) as integer) as week_number
            from orders""",
        "flatten_messages": f"""with {FLAT}
            select id, shop_id, receive_time, order_timestamp, year, week_number from flat""",
        "dedup_key_projection": f"with {HISTORY} select id, year, week_number from history",
        "result_projection": f"""with {FLAT}
            select receive_time, id, order_timestamp, s_name as shop_name, year, week_number
            from flat left join supplier on shop_id = s_suppkey""",
        # Filters
        "matched_filter": f"with {ENRICHED} select * from enriched where shop_name is not null",
        "unmatched_filter": f"with {ENRICHED} select * from enriched where shop_name is null",
        "dictionary_lookup": "select s_name as name from supplier where s_suppkey = 3",
        # Joins
        "enrich_with_dictionary": f"""with {DEDUP}
            select receive_time, id, order_timestamp, s_name as shop_name, year, week_number
            from dedup left join supplier on shop_id = s_suppkey""",
        "anti_join_stored": f"with {FRESH} select * from fresh",
        # Distinct, counts
        "dedup_in_batch": f"with {DEDUP} select * from dedup",
        "dedup_in_batch_untimed": f"""with {FLAT}, texts as (
              select id, shop_id, order_timestamp, partition, "offset",
                case when "offset" % 3 <> 0 then receive_time end as receive_time,
                case when "offset" % 3 <> 0 then year end as year,
                case when "offset" % 3 <> 0 then week_number end as week_number
              from flat)
            select * from texts
            qualify row_number() over (
              partition by id order by receive_time nulls last, partition, "offset") = 1""",
        "dedup_in_batch_lineitem": """select * from lineitem
            qualify row_number() over (partition by l_orderkey, l_linenumber
              order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
        "dedup_incremental": f"with {FRESH} select * from fresh",
        "batch_counts": f"""with {ENRICHED}, counts as (
              select (select count(*) from flat) as read,
                (select count(*) from enriched where shop_name is not null) as success,
                (select count(*) from enriched where shop_name is null) as failed)
            select read, read - success - failed as duplicates, success, failed from counts""",
        # Order, distribution
        "sort_by_partition": f"with {ENRICHED} select * from enriched",
        "distribute_by_partition": f"""with {FLAT}
            select id, shop_id, receive_time, order_timestamp, year, week_number from flat""",
        # Incremental
        "incremental_batch": f"""with recursive {SLICES}
            select {RESULT}, {ROUTE} from named where slice = 0""",
        "backfill": f"""with recursive {SLICES}
            select {RESULT}, 'success' as route from stored
            union all
            select {RESULT}, 'failed' as route from refused""",
        "batch_slices": f"""with recursive {SLICES}
            select partition, cast(slice as integer) as batch, low as start_offset,
              high as end_offset
            from ranges""",
        "broker_batches": f"""with recursive {SLICES}
            select {RESULT}, 'success' as route from stored
            union all
            select {RESULT}, 'failed' as route from refused""",
        "quarantined_messages": f"""with {LOG}
            select partition, "offset", value, "timestamp",
              cast(year("timestamp") as integer) as year,
              cast(week("timestamp") as integer) as week_number
            from log where event_id % 97 = 0""",
        "compacted_store": f"""with {ENRICHED}
            select * from enriched where shop_name is not null""",
        "stream_ingest": f"""with recursive {SLICES}
            select {RESULT}, 'success' as route from stored
            union all
            select {RESULT}, 'failed' as route from refused""",
        # Observability
        "run_metrics": f"""with {ENRICHED}
            select (select count(*) from flat) as read,
              (select count(*) from flat where id is null) as invalid,
              (select count(*) - count(distinct id) from flat where id is not null)
                as dup_in_batch,
              (select count(*) from dedup) - (select count(*) from fresh) as dup_stored,
              (select count(*) from enriched where shop_name is not null) as success,
              (select count(*) from enriched where shop_name is null) as failed""",
        "partition_lag": f"""with {STARTS}
            select topic, partition, latest_offset, start_offset,
              latest_offset - start_offset as lag
            from starts""",
        "log_volume": f"""with {STATE}
            select l.topic, l.partition, count(*) as written,
              count(*) filter (where l."offset" < c."offset") as read
            from log l left join committed c on l.topic = c.topic and l.partition = c.partition
            group by l.topic, l.partition""",
        "store_volume": f"""with {ENRICHED}
            select {ROUTE}, year, week_number, count(*) as stored_rows
            from enriched group by all""",
        # Composites
        "process_batch": f"with {ENRICHED} select *, {ROUTE} from enriched",
        "ingest_job": f"""with {ENRICHED}
            select *, {ROUTE} from enriched
            union all
            select {RESULT}, 'success' as route from history""",
    }
    return sql
