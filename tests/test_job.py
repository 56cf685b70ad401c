import datetime as dt
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.frames import local_frame
from tidemark import names as n
from tidemark import scratch
from tidemark.functions.messages import flatten_messages
from tidemark.operators import slices
from tidemark.operators.dedup import dedup_in_batch, dedup_incremental
from tidemark.operators.metrics import batch_counts, partition_lag, run_metrics
from tidemark.operators.offsets import committed_offsets, log_bounds, starting_offsets
from tidemark.plans import batch as batch_plans
from tidemark.plans import backfill as backfill_plan
from tidemark.plans import job
from tidemark.plans.batch import BatchReport, process_batch, store_batch
from tidemark.sources import offset_table
from tidemark.sources.offset_table import find_offsets
from tidemark.sources.store import read_store
from workload.log import option_reader

LOG = "topic string, partition int, offset long, value string, timestamp timestamp"
DAY = dt.datetime(2022, 1, 3)


def message(offset, id_, shop=2, partition=0, hours=0, value=None):
    if value is None:
        value = f'{{"shopId":{shop},"timestamp":"2021-12-24 18:00:00","note":"x","id":{id_}}}'
    return ("orders", partition, offset, value, DAY + dt.timedelta(hours=hours))


def log_of(spark, rows):
    return local_frame(spark, rows, LOG)


def shops(spark):
    return local_frame(spark, [(i, f"shop#{i}") for i in (1, 2, 3)], "id int, name string")


def config(path, **other):
    return job.JobConfig(topic="orders", write_to=str(path), dictionary={}, **other)


def stores(spark, path):
    return tuple(
        sorted(
            ((r[n.ID], r[n.SHOP_NAME]) for r in read_store(spark, str(path), s).collect()),
            key=str,
        )
        for s in (n.SUCCESS, n.FAILED)
    )


THREE = [message(0, 1), message(1, 1, hours=1), message(2, 2, shop=10)]


def test_end_to_end_over_two_partitions_and_a_week_boundary(spark, tmp_path):
    """One order sent again within its week and once more in the next, one of an unknown
    shop, one unreadable; the store folders are there but empty."""
    for kind in (n.SUCCESS, n.FAILED):
        (tmp_path / kind).mkdir()
    rows = [
        message(10, 7, shop=3, partition=1),
        message(4, 7, shop=1, hours=2),
        message(5, 8, shop=44, hours=3),
        message(11, None, partition=1, hours=4, value="{"),
        message(6, 7, shop=1, hours=24 * 7),
    ]
    log, settings = log_of(spark, rows), config(tmp_path, batch_size=2)
    first, second = backfill_plan.backfill(log, shops(spark), settings)
    assert first == (0, BatchReport(read=4, invalid=1, dup_in_batch=1, success=1, failed=2))
    assert second == (1, BatchReport(read=1, success=1))
    assert stores(spark, tmp_path) == (
        [(7, "shop#1"), (7, "shop#3")],
        [(8, None), (None, None)],
    )
    offsets = find_offsets(spark, str(tmp_path / "offsets"), "orders").collect()
    assert {(r["partition"], r["offset"]) for r in offsets} == {(0, 7), (1, 12)}
    assert not list(tmp_path.rglob("tidemark-*"))  # nothing is left of the intermediate tables


def test_nothing_new_is_no_batch(spark, tmp_path):
    log = log_of(spark, THREE)
    assert job.incremental_batch(log, shops(spark), config(tmp_path))
    assert job.incremental_batch(log, shops(spark), config(tmp_path)) is None
    more = log_of(spark, [*THREE, message(3, 1, hours=2), message(4, 3, shop=3)])
    batch_id, report = job.incremental_batch(more, shops(spark), config(tmp_path))
    assert batch_id == 1
    assert report == BatchReport(read=2, dup_stored=1, success=1)


def test_other_topics_are_left_alone(spark, tmp_path):
    other = [("else", 0, 0, '{"id":9,"shopId":2}', DAY)]
    backfill_plan.backfill(log_of(spark, THREE + other), shops(spark), config(tmp_path))
    assert stores(spark, tmp_path) == ([(1, "shop#2")], [(2, None)])


def test_a_replay_adds_nothing_to_success(spark, tmp_path):
    log = log_of(spark, THREE)
    store_batch(log, shops(spark), str(tmp_path))
    report = store_batch(log, shops(spark), str(tmp_path))
    assert report == BatchReport(read=3, dup_in_batch=1, dup_stored=1, failed=1)
    assert stores(spark, tmp_path) == ([(1, "shop#2")], [(2, None), (2, None)])


def test_a_safe_replay_adds_nothing_at_all(spark, tmp_path):
    log = log_of(spark, [*THREE, message(3, None, value="not json")])
    for _ in range(2):
        store_batch(log, shops(spark), str(tmp_path), replay_safe=True)
    assert stores(spark, tmp_path) == ([(1, "shop#2")], [(2, None), (None, None)])
    again = log_of(spark, [message(4, 2, shop=10, hours=5)])
    store_batch(again, shops(spark), str(tmp_path), replay_safe=True)
    assert len(stores(spark, tmp_path)[1]) == 3


def test_equal_ids_and_times_of_other_messages_are_no_replay(spark, tmp_path):
    first = log_of(spark, [message(0, 7, shop=44), message(1, None, value="{")])
    second = log_of(spark, [message(2, 7, shop=45), message(0, None, partition=1, value="[")])
    for log in (first, second):
        report = store_batch(log, shops(spark), str(tmp_path), replay_safe=True)
        assert report == BatchReport(read=2, invalid=1, failed=2)
    assert stores(spark, tmp_path)[1] == [(7, None), (7, None), (None, None), (None, None)]
    again = store_batch(second, shops(spark), str(tmp_path), replay_safe=True)
    assert (again.failed, again.dup_stored) == (0, 2)
    assert len(stores(spark, tmp_path)[1]) == 4


def test_a_message_at_the_place_of_another_is_set_aside_too(spark, tmp_path):
    """A topic created anew gives out its offsets again."""
    old = log_of(spark, [message(3, None, value="old")])
    new = log_of(spark, [message(3, None, value="new", hours=30)])
    for log, written in ((old, 1), (old, 0), (new, 1), (new, 0)):
        report = store_batch(log, shops(spark), str(tmp_path), replay_safe=True, quarantine=True)
        assert (report.read, report.invalid, report.dup_stored) == (1, written, 1 - written)
    aside = spark.read.parquet(str(tmp_path / n.QUARANTINE))
    assert sorted(r["value"] for r in aside.collect()) == ["new", "old"]
    assert {p.name for p in (tmp_path / n.QUARANTINE).iterdir()} >= {"year=2022"}


def test_rows_without_an_arrival_time(spark, tmp_path):
    rows = [("orders", 0, o, f'{{"id":{i},"shopId":2}}', t) for o, (i, t) in enumerate(
        [(1, None), (1, DAY), (2, None)]
    )]
    log = log_of(spark, rows)
    with pytest.raises(ValueError, match="arrival time"):
        store_batch(log, shops(spark), str(tmp_path))
    assert stores(spark, tmp_path) == ([], [])
    for _ in range(2):
        store_batch(log, shops(spark), str(tmp_path), replay_safe=True, quarantine=True)
        assert stores(spark, tmp_path) == ([(1, "shop#2")], [])
        aside = spark.read.parquet(str(tmp_path / n.QUARANTINE))
        assert sorted(r["offset"] for r in aside.collect()) == [0, 2]
    # a copy with a time is enough where nothing is set aside
    report = store_batch(log_of(spark, rows[:2]), shops(spark), str(tmp_path / "other"))
    assert report == BatchReport(read=2, dup_in_batch=1, success=1)


def table_reader(log, asked, partitions):
    """A reader that honours the options over a log table, and like the connector refuses
    offset texts that do not name exactly the partitions it reads."""

    def read(options):
        asked.append((options["startingOffsets"], options["endingOffsets"]))
        assigned = json.loads(options.get("assign", "{}")).get("orders", range(partitions))
        for text in asked[-1]:
            assert not text.startswith("{") or {*map(int, json.loads(text)["orders"])} == {*assigned}
        return option_reader(log)(options)

    return read


def test_the_broker_batch_reads_its_tail_and_its_range(spark, tmp_path):
    rows = [message(o, o, partition=p, hours=o) for p, size in ((0, 5), (1, 2)) for o in range(size)]
    log, asked = log_of(spark, rows), []
    settings = config(
        tmp_path, batch_size=3, broker={"kafka.bootstrap.servers": "b:1", "kafka.group.id": "g"}
    )

    def run(**other):
        asked.clear()
        return job.broker_batch(spark, settings, shops(spark), table_reader(log, asked, 2), **other)

    batch_id, report = run()
    assert (batch_id, report.read) == (0, 5)
    assert asked == [
        ("earliest", "latest"),
        ('{"orders":{"0":0,"1":0}}', '{"orders":{"0":3,"1":2}}'),
    ]
    batch_id, report = run()
    assert (batch_id, report.read) == (1, 2)
    assert asked == [
        ('{"orders":{"0":3,"1":2}}', "latest"),
        ('{"orders":{"0":3}}', '{"orders":{"0":5}}'),
    ]
    assert run() is None
    assert asked == [('{"orders":{"0":5,"1":2}}', "latest")]
    settings = config(tmp_path / "given", broker=settings.broker)
    run(bounds=log_bounds(log).collect())
    assert asked == [('{"orders":{"0":0,"1":0}}', '{"orders":{"0":5,"1":2}}')]


def test_the_broker_batch_stands_partitions_without_a_message(spark, tmp_path):
    rows = [message(o, o, partition=p, hours=o) for p, first in ((0, 2), (2, 0)) for o in range(first, 4)]
    settings = config(tmp_path, batch_size=2, topic_partitions=4, broker={"kafka.bootstrap.servers": "b:1"})
    asked, read = [], 0
    while batch := job.broker_batch(
        spark, settings, shops(spark), table_reader(log_of(spark, rows), asked, 4)
    ):
        read += batch[1].read
    assert read == 6
    assert asked[0] == ('{"orders":{"0":-2,"1":-2,"2":-2,"3":-2}}', "latest")
    assert asked[2][0] == '{"orders":{"0":4,"1":-2,"2":2,"3":-2}}'
    assert asked[-1][0] == '{"orders":{"0":4,"1":-2,"2":4,"3":-2}}'
    # a message in one of them is found, and only there is anything read from its start
    rows.append(message(9, 50, partition=3))
    _, report = job.broker_batch(
        spark, settings, shops(spark), table_reader(log_of(spark, rows), asked, 4)
    )
    assert report.read == 1 and asked[-1] == ('{"orders":{"3":9}}', '{"orders":{"3":10}}')
    # bounds of the broker name empty partitions, too
    Bounds = lambda p, a, b: Row(topic="orders", partition=p, earliest_offset=a, latest_offset=b)
    given = [Bounds(0, 2, 4), Bounds(1, 7, 7), Bounds(2, 0, 4), Bounds(3, 9, 10)]
    assert job.broker_batch(spark, settings, shops(spark), table_reader(log_of(spark, rows), asked, 4), given) is None
    offsets = find_offsets(spark, settings.offsets_path, "orders").collect()
    assert {(r["partition"], r["offset"]) for r in offsets} == {(0, 4), (2, 4), (3, 10)}


def test_old_commits_are_removed_and_offsets_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offset_table, "KEPT_COMMITS", 2)
    rows = [message(o, o, hours=o) for o in range(7)] + [message(0, 99, partition=1)]
    settings = config(tmp_path, batch_size=1)
    assert len(one_by_one(log_of(spark, rows), shops(spark), settings)) == 7
    offsets = find_offsets(spark, settings.offsets_path, "orders").collect()
    assert {(r["partition"], r["offset"], r["batch_id"]) for r in offsets} == {(0, 7, 6), (1, 1, 6)}
    assert len(list((tmp_path / "offsets").rglob("*.parquet"))) <= 5


def test_a_failed_order_succeeds_once_its_shop_exists(spark, tmp_path):
    store_batch(log_of(spark, [message(0, 2, shop=10)]), shops(spark), str(tmp_path))
    known = shops(spark).union(spark.createDataFrame([(10, "shop#10")], "id int, name string"))
    store_batch(log_of(spark, [message(1, 2, shop=10, hours=1)]), known, str(tmp_path))
    assert stores(spark, tmp_path) == ([(2, "shop#10")], [(2, None)])


def test_a_crash_before_the_commit_reads_the_range_again(spark, tmp_path, monkeypatch):
    log = log_of(spark, THREE)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(job, "commit_offsets", crash)
        with pytest.raises(RuntimeError):
            job.incremental_batch(log, shops(spark), config(tmp_path, replay_safe=True))
    assert find_offsets(spark, str(tmp_path / "offsets"), "orders").count() == 0
    job.incremental_batch(log, shops(spark), config(tmp_path, replay_safe=True))
    assert stores(spark, tmp_path) == ([(1, "shop#2")], [(2, None)])


def test_a_crash_between_the_stores_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    log = log_of(spark, THREE)
    write = batch_plans.write_routed

    def crash(rows, root, *_):
        write(rows.filter(F.col(n.SHOP_NAME).isNotNull()), root)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(batch_plans, "write_routed", crash)
        with pytest.raises(RuntimeError):
            job.incremental_batch(log, shops(spark), config(tmp_path))
    job.incremental_batch(log, shops(spark), config(tmp_path))
    assert stores(spark, tmp_path) == ([(1, "shop#2")], [(2, None)])


def test_two_runs_from_one_state_store_once(spark, tmp_path, monkeypatch):
    """The second run plans from the offsets that the first one has read, too."""
    log, settings = log_of(spark, THREE), config(tmp_path)
    planned = find_offsets(spark, settings.offsets_path, "orders")
    stale = planned.collect()
    assert job.incremental_batch(log, shops(spark), settings)
    held = stores(spark, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(job, "find_offsets", lambda *_: planned.limit(0))
        with pytest.raises(offset_table.CommitConflict, match="committed already"):
            job.incremental_batch(log, shops(spark), settings)
    assert stale == [] and stores(spark, tmp_path) == held


def test_claims_of_lost_runs_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "offsets")
    with pytest.raises(RuntimeError, match="failed"), offset_table.claimed(spark, path, "orders", 0):
        with pytest.raises(offset_table.CommitConflict, match="another run"):
            with offset_table.claimed(spark, path, "orders", 0):
                raise AssertionError("held twice")
        with offset_table.claimed(spark, path, "orders", 0, lost_after=-1):
            pass
        raise RuntimeError("failed")
    with offset_table.claimed(spark, path, "orders", 0):  # a run that failed gave it up
        pass
    assert find_offsets(spark, path, "orders").collect() == []


def test_null_ids_collapse_or_are_set_aside(spark, tmp_path):
    rows = [*THREE, *[message(3 + i, None, value="not json", hours=i) for i in range(4)]]
    report = store_batch(log_of(spark, rows), shops(spark), str(tmp_path / "a"))
    assert report == BatchReport(read=7, invalid=4, dup_in_batch=1, success=1, failed=2)
    assert stores(spark, tmp_path / "a") == ([(1, "shop#2")], [(2, None), (None, None)])
    report = store_batch(log_of(spark, rows), shops(spark), str(tmp_path / "b"), quarantine=True)
    assert report == BatchReport(read=7, invalid=4, dup_in_batch=1, success=1, failed=1)
    assert stores(spark, tmp_path / "b") == ([(1, "shop#2")], [(2, None)])
    aside = spark.read.parquet(str(tmp_path / "b" / n.QUARANTINE))
    assert sorted(r["offset"] for r in aside.collect()) == [3, 4, 5, 6]


def test_a_safe_replay_sets_no_message_aside_twice(spark, tmp_path):
    log = log_of(spark, [*THREE, message(3, None, value="not json")])
    for _ in range(2):
        store_batch(log, shops(spark), str(tmp_path), replay_safe=True, quarantine=True)
    assert spark.read.parquet(str(tmp_path / n.QUARANTINE)).count() == 1


@pytest.mark.parametrize("quarantine", [False, True])
def test_messages_are_read_once(spark, tmp_path, quarantine):
    rows = [*THREE, message(3, None, value="not json"), message(4, 5, shop=3, hours=9)]
    read = spark.sparkContext.accumulator(0)

    def told(text):
        read.add(1)
        return text

    log = log_of(spark, rows).withColumn("value", F.udf(told, "string")("value"))
    report = store_batch(log, shops(spark), str(tmp_path), True, quarantine)
    assert (report.read, report.invalid, report.success) == (5, 1, 2)
    assert read.value == 5


def test_only_invalid_messages_with_quarantine(spark, tmp_path):
    log = log_of(spark, [message(0, None, value="")])
    report = store_batch(log, shops(spark), str(tmp_path), quarantine=True)
    assert report == BatchReport(read=1, invalid=1)


def random_messages(seed, count=60):
    draw = random.Random(seed)
    rows, ends = [], [0, 0, 0]
    for i in range(count):
        partition = draw.randrange(3)
        value = "{" if draw.random() < 0.1 else None
        hours = i * 8
        id_, shop = draw.randrange(25), draw.randrange(1, 6)
        rows.append(message(ends[partition], id_, shop, partition, hours, value))
        ends[partition] += draw.choice([1, 1, 2])
    return rows


def reference_run(rows, slices):
    """What the stores must hold after the given batches, in plain Python."""
    import json

    success, failed, stored = [], [], set()
    for part in slices:
        first = {}
        for row in sorted(part, key=lambda r: (r[4], r[1], r[2])):
            try:
                payload = json.loads(row[3])
            except ValueError:
                payload = {}
            first.setdefault(payload.get("id"), (payload.get("shopId"), row[4]))
        for id_, (shop, time) in first.items():
            year, week = time.year, time.isocalendar()[1]
            if id_ is not None and (id_, year, week) in stored:
                continue
            (success if shop in (1, 2, 3) else failed).append(
                (id_, f"shop#{shop}" if shop in (1, 2, 3) else None)
            )
            if shop in (1, 2, 3):
                stored.add((id_, year, week))
    return sorted(success, key=str), sorted(failed, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_backfill_in_slices_equals_brute_force(spark, tmp_path, seed):
    rows, cap = random_messages(seed), 9
    log = log_of(spark, rows)
    batches = backfill_plan.backfill(log, shops(spark), config(tmp_path, batch_size=cap))
    # The slices the cap makes, from the end of one to the next offset there is.
    slices, position = [], dict.fromkeys(range(3), 0)
    while True:
        part = []
        for p in position:
            rest = [r for r in rows if r[1] == p and r[2] >= position[p]]
            if not rest:
                continue
            start = min(r[2] for r in rest)
            end = min(max(r[2] for r in rest) + 1, start + cap)
            part += [r for r in rest if start <= r[2] < end]
            position[p] = end
        if not part:
            break
        slices.append(part)
    assert sum(report.read for _, report in batches) == len(rows)
    assert [report.read for _, report in batches] == [len(s) for s in slices]
    assert stores(spark, tmp_path) == reference_run(rows, slices)
    summed = job.reports_frame(spark, batches).agg(F.sum("success"), F.sum("failed")).first()
    assert tuple(summed) == tuple(map(len, stores(spark, tmp_path)))


def one_by_one(log, dictionary, settings):
    done = []
    while (batch := job.incremental_batch(log, dictionary, settings)) is not None:
        done.append(batch)
    return done


def whole_stores(spark, path):
    """All columns of the stores and of what was set aside."""
    found = {}
    for store in (n.SUCCESS, n.FAILED, n.QUARANTINE):
        if (path / store).exists():
            rows = spark.read.parquet(str(path / store))
            found[store] = sorted(str(r) for r in rows.select(sorted(rows.columns)).collect())
    return found


@pytest.mark.parametrize(
    "seed, at_once, options",
    [
        (11, 500, {}),
        (12, 3, {"replay_safe": True}),
        (13, 2, {"quarantine": True, "replay_safe": True}),
        (14, 500, {"quarantine": True}),
    ],
)
def test_backfill_equals_batches_one_by_one(spark, tmp_path, seed, at_once, options):
    rows = random_messages(seed)
    log, before = log_of(spark, rows), log_of(spark, [message(0, 3), message(1, 90, shop=10)])
    for folder in "ab":  # both go on from a store and a commit
        job.incremental_batch(before, shops(spark), config(tmp_path / folder, **options))
    want = one_by_one(log, shops(spark), config(tmp_path / "a", batch_size=7, **options))
    settings = config(tmp_path / "b", batch_size=7, **options)
    got = backfill_plan.backfill(log, shops(spark), settings, at_once)
    assert got == want and len(got) > 3
    assert whole_stores(spark, tmp_path / "b") == whole_stores(spark, tmp_path / "a")
    ends = [
        {(r["partition"], r["offset"]) for r in find_offsets(spark, str(tmp_path / f / "offsets"), "orders").collect()}
        for f in "ab"
    ]
    assert ends[0] == ends[1]
    assert not list(tmp_path.rglob("tidemark-*"))


def test_a_backfill_takes_fewer_jobs_than_batches(spark, tmp_path):
    rows = [message(3 * o, o % 40, shop=o % 5, hours=o) for o in range(120)]
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    try:
        context.setJobGroup("backfill", "")
        batches = backfill_plan.backfill(
            log_of(spark, rows), shops(spark), config(tmp_path, batch_size=6)
        )
        jobs = len(tracker.getJobIdsForGroup("backfill"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(batches) == 60 and sum(report.read for _, report in batches) == 120
    assert jobs < len(batches)


def test_slices_follow_from_one_another_across_gaps(spark):
    draw = random.Random(5)
    rows, want = [], set()
    for partition, first in ((0, 0), (1, 32_760), (2, 5 * 10**9)):
        offsets, at = [], first
        for _ in range(400):
            offsets.append(at)
            at += draw.choice([1, 1, 2, 90, 40_000])
        rows += [message(o, o, partition=partition) for o in offsets]
        start, k = offsets[0], 0
        while start is not None:
            rest = [o for o in offsets if o >= start + 100]
            end = start + 100 if rest else min(start + 100, offsets[-1] + 1)
            want.add((partition, k, start, end))
            start, k = (rest[0] if rest else None), k + 1
    log = log_of(spark, rows)
    got = slices.batch_slices(log, 100, 10**6)
    assert {tuple(r) for r in got.collect()} == want
    some = {tuple(r) for r in slices.batch_slices(log, 100, 4).collect()}
    assert some == {w for w in want if w[1] < 4}
    dealt = slices.with_batch(log, got, 100).select("partition", "offset", "batch").collect()
    assert len(dealt) == len(rows)
    where = {(p, k): (a, b) for p, k, a, b in want}
    assert all(where[r[0], r[2]][0] <= r[1] < where[r[0], r[2]][1] for r in dealt)


def test_both_routes_make_up_the_deduped_batch(spark):
    log = log_of(spark, random_messages(3))
    kept = dedup_in_batch(flatten_messages(log, keep=n.POSITION))
    rows = process_batch(log, shops(spark), None)
    routes = {r[n.ROUTE] for r in rows.select(n.ROUTE).distinct().collect()}
    assert routes == {n.SUCCESS, n.FAILED}
    key = [n.RECEIVE_TIME, n.ID]
    assert rows.count() == kept.count()
    assert rows.select(*key).exceptAll(kept.select(*key)).isEmpty()


def test_metrics_agree_with_the_report(spark, tmp_path):
    rows = random_messages(4)
    store_batch(log_of(spark, rows[:30]), shops(spark), str(tmp_path))
    stored = read_store(spark, str(tmp_path))
    log = log_of(spark, rows[20:])
    flat = flatten_messages(log, keep=n.POSITION)
    metrics = run_metrics(flat, stored, shops(spark)).first()
    counts = batch_counts(flat, stored, shops(spark)).first()
    report = store_batch(log, shops(spark), str(tmp_path))
    assert BatchReport(**metrics.asDict()) == report
    assert counts["duplicates"] == report.read - report.success - report.failed


def test_composed_operators_run_nothing_and_leave_nothing(spark, tmp_path, monkeypatch):
    """Jobs start when a result is asked for; only the dictionary is measured before."""
    store_batch(log_of(spark, THREE), shops(spark), str(tmp_path / "stores"))
    stored, log = read_store(spark, str(tmp_path / "stores")), log_of(spark, random_messages(6))
    flat = flatten_messages(log, keep=n.POSITION)
    monkeypatch.setattr(scratch, "local_folder", lambda _: str(tmp_path / "scratch"))
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    try:
        context.setJobGroup("planned", "")
        frames = [
            dedup_incremental(flat, stored),
            run_metrics(flat, stored, shops(spark)),
            batch_counts(flat, stored, shops(spark)),
            process_batch(log, shops(spark), stored),
        ]
        assert len(tracker.getJobIdsForGroup("planned")) <= 6  # three sizes of the dictionary
        context.setJobGroup("collected", "")
        assert all(frame.collect() for frame in frames)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not (tmp_path / "scratch").exists()


def test_a_batch_takes_few_jobs(spark, tmp_path):
    """Counts are observed while tables are written: no job is run for them."""
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    try:
        context.setJobGroup("batch", "")
        report = store_batch(
            log_of(spark, random_messages(8)), shops(spark), str(tmp_path), dictionary_size=100
        )
        jobs = len(tracker.getJobIdsForGroup("batch"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert report.success and report.failed
    # adaptive execution runs each shuffle as a job: survivors, result and each store; ids of
    # so small a batch are collected
    assert jobs <= 9


def test_metrics_of_nothing_are_zero(spark):
    flat = flatten_messages(log_of(spark, []), keep=n.POSITION)
    stored = spark.createDataFrame([], n.RESULT_DDL)
    assert set(run_metrics(flat, stored, shops(spark)).first()) == {0}


def test_the_batch_beyond_the_small_size_gives_the_same(spark, tmp_path, monkeypatch):
    from tidemark.operators import dedup

    rows = random_messages(5, count=24)
    for limit, folder in ((500_000, "a"), (0, "b")):
        monkeypatch.setattr(dedup, "SMALL_BATCH_ROWS", limit)
        backfill_plan.backfill(log_of(spark, rows), shops(spark), config(tmp_path / folder, batch_size=6))
    assert stores(spark, tmp_path / "a") == stores(spark, tmp_path / "b")


def test_a_topic_created_anew_is_read_from_its_start(spark, tmp_path, caplog):
    old = log_of(spark, [message(i, i) for i in range(6)])
    backfill_plan.backfill(old, shops(spark), config(tmp_path))
    new = log_of(spark, [message(0, 50), message(1, 51)])
    _, report = job.incremental_batch(new, shops(spark), config(tmp_path))
    assert report.success == 2
    assert "not in the log" in caplog.text
    assert job.incremental_batch(new, shops(spark), config(tmp_path)) is None


def test_ingest_job_reads_its_dictionary(spark, tmp_path):
    path = str(tmp_path / "shops")
    shops(spark).write.parquet(path)
    settings = job.JobConfig(
        topic="orders",
        write_to=str(tmp_path / "out"),
        dictionary={"path": path},
        dictionary_source="parquet",
    )
    assert job.ingest_job(spark, log_of(spark, THREE), settings)[1].success == 1


def test_nothing_stays_persisted(spark, tmp_path):
    persistent = spark.sparkContext._jsc.getPersistentRDDs
    before = persistent().size()
    log = log_of(spark, [*THREE, message(3, None, value="not json")])
    settings = config(tmp_path, quarantine=True, replay_safe=True, max_rows_per_file=1)
    backfill_plan.backfill(log, shops(spark), settings)
    assert persistent().size() == before

    with pytest.raises(Exception, match="no_such_column"):
        store_batch(log, shops(spark).withColumnRenamed("id", "no_such_column"), str(tmp_path))
    assert persistent().size() == before


def test_lag_from_the_tail_equals_lag_from_the_whole_log(spark):
    rows = [message(o, o, partition=p) for p, found in ((0, (5, 6, 9)), (1, (2,)), (2, (7, 8)), (3, (0,))) for o in found]
    log = log_of(spark, rows + [("other", 0, 4, "{}", DAY)])
    commits = [("orders", 0, 7, 1), ("orders", 1, 3, 1), ("orders", 2, 3, 1), ("orders", 4, 3, 1)]
    committed = committed_offsets(
        local_frame(spark, commits, "topic string, partition int, offset long, batch_id long")
    )
    whole = starting_offsets(log_bounds(log), committed)
    got = partition_lag(log, committed).select("topic", "partition", "latest_offset", "start_offset")
    assert sorted(got.collect()) == sorted(whole.select(*got.columns).collect())


def test_stream_settings_are_those_of_a_batch():
    import inspect

    from tidemark.streaming.stream import ingest_stream

    assert {"quarantine", "max_rows_per_file"} <= set(inspect.signature(ingest_stream).parameters)
