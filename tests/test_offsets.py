from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.frames import local_frame
from tidemark.functions.offset_text import (
    decode_offset_document,
    encode_offset_document,
    offsets_to_json,
)
from tidemark.operators import offsets
from tidemark.sources import offset_table

OFFSETS = "topic string, partition int, offset long"
STATE = f"{OFFSETS}, batch_id long"


def frame(spark, *rows):
    return local_frame(spark, [("t", *row) for row in rows], OFFSETS)


def state(spark, *rows):
    return local_frame(spark, [("t", *row) for row in rows], STATE)


def log(spark, bounds):
    return frame(spark, *[(p, o) for p, (low, high) in bounds.items() for o in range(low, high)])


def ranges(rows):
    return {r["partition"]: (r[offsets.START], r[offsets.END]) for r in rows}


def test_offset_text(spark):
    rows = spark.createDataFrame([("clicks", 4, 310), ("clicks", 7, 0)], OFFSETS)
    assert offsets_to_json(rows).first()["offsets"] == '{"clicks":{"4":310,"7":0}}'


def test_offset_text_is_in_partition_order(spark):
    rows = frame(spark, *[(p, p * 10) for p in (10, 2, 1)])
    assert offsets_to_json(rows).first()["offsets"] == '{"t":{"1":10,"2":20,"10":100}}'


def test_offset_document_round_trip(spark):
    rows = frame(spark, (0, 10), (11, 7))
    documents = encode_offset_document(rows)
    assert documents.first()["document"] == (
        '{"topic":"t","partitionDataList":'
        '[{"partitionIndex":"0","offset":10},{"partitionIndex":"11","offset":7}]}'
    )
    assert sorted(decode_offset_document(documents).collect()) == sorted(rows.collect())


def test_latest_grows_with_the_log(spark):
    before = offsets.latest_offsets(log(spark, {0: (3, 7)})).first()
    after = offsets.latest_offsets(log(spark, {0: (3, 8)})).first()
    assert (before["offset"], after["offset"]) == (7, 8)
    assert offsets.earliest_offsets(log(spark, {0: (3, 7)})).first()["offset"] == 3


def test_start_is_committed_else_earliest_per_partition(spark):
    messages = log(spark, {0: (0, 20), 1: (5, 20), 2: (0, 4)})
    plan = offsets.plan_offsets(messages, state(spark, (0, 12, 1), (2, 4, 1)), 10)
    assert ranges(plan.collect()) == {0: (12, 20), 1: (5, 15), 2: (4, 4)}
    assert not any(r["moved"] for r in plan.collect())


def test_committed_offsets_outside_the_log_move_into_it(spark):
    messages = log(spark, {0: (100, 120), 1: (0, 5)})
    plan = offsets.plan_offsets(messages, state(spark, (0, 50, 1), (1, 70, 1)), 8).collect()
    assert ranges(plan) == {0: (100, 108), 1: (0, 5)}
    assert all(r["moved"] for r in plan)


def test_last_commit_wins_even_if_lower(spark):
    rows = state(spark, (0, 0, 1), (0, 90, 2), (0, 40, 3), (1, 5, 1))
    new = state(spark, (1, 2, 4), (2, 1, 4))
    after = offsets.upsert_offsets(rows, new).collect()
    assert {(r["partition"], r["offset"], r["batch_id"]) for r in after} == {
        (0, 40, 3),
        (1, 2, 4),
        (2, 1, 4),
    }


def test_offset_table_insert_update_and_absence(spark, tmp_path):
    path = str(tmp_path / "offsets")
    assert offset_table.find_offsets(spark, path, "t").count() == 0

    def commit(topic, offset, batch):
        row = Row(topic=topic, partition=0, **{offsets.END: offset})
        offset_table.commit_offsets(spark, [row], path, batch)

    commit("t", 14, 0)
    commit("u", 3, 0)
    assert offset_table.find_offsets(spark, path, "t").first()["offset"] == 14
    commit("t", 31, 1)
    commit("t", 31, 1)
    assert offset_table.find_offsets(spark, path, "t").first()["offset"] == 31
    assert offset_table.find_offsets(spark, path, "absent").count() == 0
    compacted = str(tmp_path / "compacted")
    offset_table.compact(spark, path, compacted)
    for topic in ("t", "u", "absent"):
        before, after = (
            offset_table.find_offsets(spark, p, topic).collect() for p in (path, compacted)
        )
        assert before == after


BOUND = st.tuples(st.integers(0, 20), st.integers(1, 15))


@settings(max_examples=8, deadline=None)
@given(
    bounds=st.dictionaries(st.integers(0, 3), BOUND, min_size=1),
    committed=st.dictionaries(st.integers(0, 4), st.integers(0, 40)),
    cap=st.integers(1, 12),
)
def test_planning_the_tail_equals_planning_the_log(spark, bounds, committed, cap):
    messages = log(spark, {p: (low, low + size) for p, (low, size) in bounds.items()})
    done = state(spark, *[(p, o, 1) for p, o in committed.items()])
    whole = offsets.plan_offsets(messages, done, cap).collect()
    tail = offsets.plan_unread(messages, done.collect(), cap)
    assert ranges(tail) == {p: r for p, r in ranges(whole).items() if r[0] < r[1]}
    expected = {}
    for p, (low, size) in bounds.items():
        start = committed.get(p, low)
        start = start if low <= start <= low + size else low
        expected[p] = (start, min(low + size, start + cap))
    assert ranges(whole) == expected


@settings(max_examples=8, deadline=None)
@given(
    places=st.dictionaries(st.integers(0, 3), st.sets(st.integers(0, 60), min_size=1), min_size=1),
    committed=st.dictionaries(st.integers(0, 4), st.integers(0, 70)),
    cap=st.integers(1, 12),
)
def test_both_forms_plan_the_same_over_gaps(spark, places, committed, cap):
    """Each range starts at the next offset there is, whatever the number of partitions."""
    messages = frame(spark, *[(p, o) for p, found in places.items() for o in found])
    done = state(spark, *[(p, o, 1) for p, o in committed.items()]).collect()
    expected = {}
    for p, found in places.items():
        rest = [o for o in found if o >= committed.get(p, 0)]
        if not rest and committed[p] - 1 not in found:
            rest = found  # the topic was created anew
        if rest:
            expected[p] = (min(rest), min(max(rest) + 1, min(rest) + cap))
    default = offsets.MAX_LITERAL_RANGES
    for limit in (default, 0):
        offsets.MAX_LITERAL_RANGES = limit
        try:
            assert ranges(offsets.plan_unread(messages, done, cap)) == expected
        finally:
            offsets.MAX_LITERAL_RANGES = default


def test_many_partitions_prune_the_scan_too(spark, plan_of, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    log(spark, {0: (0, 9), 1: (0, 9), 2: (0, 9)}).write.partitionBy("partition").parquet(path)
    monkeypatch.setattr(offsets, "MAX_LITERAL_RANGES", 1)
    done = state(spark, (0, 4, 1), (1, 7, 1)).collect()
    tail = offsets._unread(spark.read.parquet(path), done)
    assert tail.count() == 5 + 2 + 9
    seen, unseen = plan_of(tail).split("FileScan")[1:]
    assert "GreaterThanOrEqual(offset,4)" in seen
    for scan in (seen, unseen):
        assert "partition" in scan.split("PartitionFilters: ")[1].split("]")[0]


def test_commits_of_one_batch_leave_the_higher_offset(spark):
    rows = state(spark, (0, 7, 3), (0, 9, 3), (0, 8, 3), (0, 50, 2))
    for order in (rows, rows.orderBy("offset"), rows.orderBy(F.desc("offset"))):
        assert tuple(offsets.committed_offsets(order).first()) == ("t", 0, 9, 3)


def test_range_forms_agree(spark):
    messages = log(spark, {0: (0, 9), 1: (0, 9), 2: (0, 9)})
    plan = spark.createDataFrame(
        [(0, 2, 5), (1, 0, 1), (2, 4, 4)], "partition int, start_offset long, end_offset long"
    )
    expected = [("t", 0, 2), ("t", 0, 3), ("t", 0, 4), ("t", 1, 0)]
    assert sorted(map(tuple, offsets.log_range_scan(messages, plan).collect())) == expected
    assert sorted(map(tuple, offsets.range_join(messages, plan.collect()).collect())) == expected
    assert offsets.range_filter(messages, []).count() == 0


def test_a_plan_of_very_many_partitions(spark):
    count = offsets.MAX_LITERAL_RANGES + 20
    messages = spark.range(0, count * 4).select(
        F.lit("t").alias("topic"),
        (F.col("id") % count).cast("int").alias("partition"),
        F.floor(F.col("id") / count).alias("offset"),
    )
    plan = offsets.plan_unread(messages, [], 3)
    assert offsets.log_range_scan(messages, plan).count() == count * 3
    done = state(spark, *[(r["partition"], r[offsets.END], 1) for r in plan])
    rest = offsets.plan_unread(messages, done.collect(), 3)
    assert offsets.log_range_scan(messages, rest).count() == count


def test_ranges_reach_the_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "log")
    log(spark, {0: (0, 9), 1: (0, 9), 2: (0, 9)}).write.partitionBy("partition").parquet(path)
    plan = spark.createDataFrame(
        [(0, 2, 5), (1, 0, 1)], "partition int, start_offset long, end_offset long"
    )
    scan = offsets.log_range_scan(spark.read.parquet(path), plan)
    text = plan_of(scan)
    assert "partition" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(offset,2)" in text and "LessThan(offset,5)" in text
    assert scan.count() == 4


def test_committed_offsets_reach_the_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "log")
    log(spark, {0: (0, 9), 1: (0, 9), 2: (0, 9)}).write.partitionBy("partition").parquet(path)
    done = state(spark, (0, 4, 1), (1, 7, 1)).collect()
    tail = offsets._unread(spark.read.parquet(path), done)
    assert tail.count() == 5 + 2 + 9
    seen, unseen = plan_of(tail).split("FileScan")[1:]
    assert "GreaterThanOrEqual(offset,4)" in seen and "GreaterThanOrEqual(offset,7)" in seen
    assert "partition" in unseen.split("PartitionFilters: ")[1].split("]")[0]


def test_an_idle_partition_is_told_from_one_created_anew(spark):
    messages = log(spark, {0: (0, 9), 1: (3, 9), 2: (0, 2)})
    done = state(spark, (0, 9, 1), (1, 9, 1), (2, 9, 1), (3, 9, 1)).collect()
    assert sorted(offsets._not_reaching(messages, done)) == [2, 3]
    plan = offsets.plan_unread(messages, done, 5)
    assert ranges(plan) == {2: (0, 2)}
    assert plan[0]["moved"]


def test_bounds_and_commits_meet_without_a_shuffle_of_their_own(spark, plan_of):
    messages = log(spark, {0: (0, 9), 1: (0, 9)})
    committed = offsets.committed_offsets(state(spark, (0, 4, 1)), "t")
    plan = plan_of(offsets.plan_offsets(messages, committed, 3))
    assert plan.count("Exchange hashpartitioning") == 2
