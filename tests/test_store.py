from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.frames import local_frame
from tidemark import names as n
from tidemark.operators import dedup
from tidemark.operators.metrics import store_bytes, store_volume
from tidemark.sources import compaction, store

PLAIN = "receive_time string, shop_name string, year int, week_number int"


def routed(spark, count, weeks=1, parts=4):
    return spark.range(0, count, numPartitions=parts).select(
        F.timestamp_seconds("id").alias(n.RECEIVE_TIME),
        n.ID,
        F.timestamp_seconds("id").alias(n.ORDER_TIMESTAMP),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("shop#"), "id")).alias(n.SHOP_NAME),
        F.lit(2022).alias(n.YEAR),
        (F.col("id") % weeks + 1).cast("int").alias(n.WEEK_NUMBER),
    )


def files(path):
    return list(Path(path).rglob("*.parquet"))


def test_each_route_writes_its_own_store_and_no_other(spark, tmp_path):
    ddl = f"{PLAIN}, topic string, partition int, offset long"
    place = ("clicks", 3, 41)
    known, unknown = ("2024-12-31 23:59:59", "north", 2024, 1), ("2025-01-02", None, 2025, 1)
    for label, rows, counts in (
        ("both", [known, unknown, unknown], (1, 2)),
        ("known", [known], (1, 0)),
        ("unknown", [unknown], (0, 1)),
    ):
        root = tmp_path / label
        frame = spark.createDataFrame([(*row, *place) for row in rows], ddl)
        assert store.write_routed(frame, str(root)) == counts
        kinds = {kind for kind, count in zip((n.SUCCESS, n.FAILED), counts, strict=True) if count}
        assert {p.name for p in root.iterdir()} == kinds
    both = tmp_path / "both"
    success = spark.read.parquet(str(both / n.SUCCESS))
    assert success.columns == ["receive_time", n.SHOP_NAME, n.YEAR, n.WEEK_NUMBER]
    assert (both / n.SUCCESS / "year=2024" / "week_number=1").is_dir()
    failed = spark.read.parquet(str(both / n.FAILED)).first()
    assert (failed["topic"], failed["partition"], failed["offset"]) == place


@pytest.mark.parametrize("end", ["", "/", "//"])
def test_a_store_lies_below_its_root(end):
    assert store.store_path(f"s3a://bucket/a b{end}", "failed") == "s3a://bucket/a b/failed"


def test_missing_and_empty_stores_have_no_rows(spark, tmp_path):
    assert store.read_store(spark, str(tmp_path)).count() == 0
    (tmp_path / n.SUCCESS).mkdir()
    empty = store.read_store(spark, str(tmp_path))
    assert empty.count() == 0 and empty.columns == n.RESULT_COLUMNS


def test_other_errors_are_raised(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        store.read_store(spark, "nosuchscheme://host/stores")


def test_only_the_asked_weeks_are_listed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store.write_routed(routed(spark, 300, weeks=5), root)
    whole = store.read_store(spark, root)
    weeks = [(2022, 2), (2022, 4), (2022, 40), (None, 1)]
    some = store.read_store(spark, root, weeks=weeks)
    expected = whole.filter("week_number in (2, 4)")
    assert some.columns == whole.columns and some.schema == whole.schema
    assert sorted(some.collect()) == sorted(expected.collect())
    assert {Path(f).parent.name for f in some.inputFiles()} == {"week_number=2", "week_number=4"}
    for none in ([(2022, 40)], [(2021, 2)], [], [(None, None)]):
        assert store.read_store(spark, root, weeks=none).isEmpty()
    monkeypatch.setattr(store, "MAX_LISTED_WEEKS", 1)
    assert len(store.read_store(spark, root, weeks=weeks).inputFiles()) == len(whole.inputFiles())


def test_append_adds_and_a_frame_read_before_does_not_change(spark, tmp_path):
    root = str(tmp_path)
    store.write_routed(routed(spark, 30), root)
    before = store.read_store(spark, root)
    assert before.count() == 20
    store.write_routed(routed(spark, 3), root)
    assert store.read_store(spark, root).count() == 22


def test_one_file_per_directory_when_weeks_are_small(spark, tmp_path):
    path = str(tmp_path / "s")
    store.append_partitioned(routed(spark, 5_000, weeks=40, parts=8), path)
    assert len(files(path)) == 40


def test_a_hot_week_has_several_writers(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        store.append_partitioned(routed(spark, 200_000, parts=16), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(path)) > 3
    assert spark.read.parquet(path).count() == 200_000


def test_rows_per_file_can_be_bounded(spark, tmp_path):
    path = str(tmp_path / "s")
    store.append_partitioned(routed(spark, 1_000), path, max_rows_per_file=300)
    assert len(files(path)) == 4


def test_write_path_neither_sorts_nor_repartitions_statically(spark, plan_of):
    plan = plan_of(store.distribute_by_partition(routed(spark, 10)))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "Sort" not in plan


def test_replayed_rows_are_found_null_ids_too(spark):
    ddl = "receive_time string, id long, year int, week_number int"
    rows = [("a", 1, 2022, 1), ("a", None, 2022, 1), ("b", 1, 2022, 1)]
    frame = spark.createDataFrame(rows, ddl)
    left = store.not_yet_in(frame, spark.createDataFrame(rows[:2], ddl))
    assert [tuple(r) for r in left.collect()] == [("b", 1, 2022, 1)]


def test_rows_that_know_their_place_are_told_by_it(spark):
    ddl = (
        "receive_time string, id long, year int, week_number int, "
        "topic string, partition int, offset long"
    )
    first = [("a", 1, 2022, 1, "t", 0, 5), ("a", None, 2022, 1, "t", 1, 5)]
    others = [("a", 1, 2022, 1, "t", 0, 6), ("a", None, 2022, 1, "t", 0, 5), ("b", 1, 2022, 1, "t", 0, 5)]
    stored = spark.createDataFrame(first, ddl)
    for count in (None, 5):
        left = store.not_yet_in(spark.createDataFrame(first + others, ddl), stored, count)
        assert sorted(map(str, left.collect())) == sorted(map(str, spark.createDataFrame(others, ddl).collect()))


def test_store_volume_and_bytes(spark, tmp_path):
    path = str(tmp_path / "s")
    store.append_partitioned(routed(spark, 90, weeks=2), path)
    stored = spark.read.parquet(path)
    rows = {r[n.WEEK_NUMBER]: r["stored_rows"] for r in store_volume(stored).collect()}
    assert rows == {1: 45, 2: 45}
    sizes = store_bytes(stored).collect()
    assert sum(r["stored_bytes"] for r in sizes) == sum(f.stat().st_size for f in files(path))
    assert sum(r["stored_files"] for r in sizes) == len(files(path))
    assert {r[n.WEEK_NUMBER]: r["stored_rows"] for r in sizes} == rows


def test_store_volume_reads_no_data_column(spark, plan_of, tmp_path):
    path = str(tmp_path / "s")
    store.append_partitioned(routed(spark, 9), path)
    assert "ReadSchema: struct<>" in plan_of(store_volume(spark.read.parquet(path)))


def rows_scanned(frame):
    """Rows that left the scan of a frame which is collected here."""
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_ids_spread_over_a_week_are_found_by_bloom_filters(spark, tmp_path):
    """A million rows in files that each span all ids: bounds cannot leave out any."""
    one_week = [
        F.lit("2022-01-03 10:00:00").cast("timestamp").alias(n.RECEIVE_TIME),
        F.col("id"),
        F.lit(None).cast("timestamp").alias(n.ORDER_TIMESTAMP),
        F.lit("shop").alias(n.SHOP_NAME),
        F.lit(2022).alias(n.YEAR),
        F.lit(1).alias(n.WEEK_NUMBER),
    ]
    for part in range(10):
        rows = spark.range(part, 10_000_000, 100, numPartitions=1).select(*one_week)
        store.append_success(rows, str(tmp_path / "with"))
        store.append_partitioned(rows, str(tmp_path / "without" / n.SUCCESS))
    asked = [3 + 100 * 77_777, 5 + 100 * 12, 9_999_999]  # the last one is not there
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scanned = {}
        for kind in ("with", "without"):
            known = store.read_store(spark, str(tmp_path / kind))
            found = known.filter(dedup.is_any_of(n.ID, asked)).select(n.ID)
            assert sorted(r[0] for r in found.collect()) == sorted(asked[:2])
            scanned[kind] = rows_scanned(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert scanned["with"] <= scanned["without"] / 3


def test_literal_ids_and_joined_ones_find_the_same(spark, monkeypatch):
    schema = "id long, year int, week_number int"
    batch = local_frame(spark, [(k, 2022, 1) for k in range(20)] + [(None, 2022, 1)], schema)
    stored = local_frame(spark, [(k, 2022, 1 + k % 2) for k in range(0, 20, 2)] + [(None, 2022, 1)], schema)
    want = dedup.anti_join_stored(batch, stored).collect()
    for literal in (0, 200):
        monkeypatch.setattr(dedup, "LITERAL_IDS", literal)
        got = dedup.anti_join_stored(batch, stored, [(2022, 1)], (0, 19), 21)
        assert sorted(map(str, got.collect())) == sorted(map(str, want))


def test_readers_see_every_row_once_before_during_and_after_a_compaction(
    spark, tmp_path, monkeypatch
):
    root = str(tmp_path)
    for part in range(6):
        rows = spark.range(part, 600, 6, numPartitions=1).select(
            F.timestamp_seconds("id").alias(n.RECEIVE_TIME),
            n.ID,
            F.timestamp_seconds("id").alias(n.ORDER_TIMESTAMP),
            F.lit("shop").alias(n.SHOP_NAME),
            F.lit(2022).alias(n.YEAR),
            (F.col("id") % 2 + 1).cast("int").alias(n.WEEK_NUMBER),
        )
        store.append_success(rows, root)

    def seen(weeks=None):
        return sorted(r[0] for r in store.read_store(spark, root, weeks=weeks).select(n.ID).collect())

    first, odd = list(range(600)), list(range(0, 600, 2))
    planned = store.read_store(spark, root)  # has listed its files already
    assert seen() == first
    steps, rename = [], compaction._Files.rename

    def looked(files, old, new):
        steps.append((seen() == first, seen([(2022, 1)]) == odd))
        rename(files, old, new)
        steps.append((seen() == first, seen([(2022, 1)]) == odd))

    monkeypatch.setattr(compaction._Files, "rename", looked)
    assert compaction.compact_week(spark, root, n.SUCCESS, 2022, 1) == (3, 1)
    assert len(steps) == 4 and all(map(all, steps))
    store.append_success(rows.limit(0).union(rows), root)  # batches go on
    after = sorted(first + list(range(5, 600, 6)))
    assert seen() == after
    assert sorted(r[0] for r in planned.select(n.ID).collect()) == first
    assert compaction.vacuum(spark, root, n.SUCCESS) == 0  # not yet
    assert compaction.vacuum(spark, root, n.SUCCESS, grace_seconds=-1) == 3
    assert seen() == after and seen([(2022, 1)]) == odd
    assert len(files(tmp_path / n.SUCCESS / "year=2022" / "week_number=1")) == 1


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for _ in range(3):
        store.append_success(routed(spark, 30, parts=1), root)
    held = store.read_store(spark, root).count()
    rename = compaction._Files.rename

    def dies(files, old, new):
        if compaction.REPLACED in new:
            raise RuntimeError("lost")
        rename(files, old, new)

    with monkeypatch.context() as patch:
        patch.setattr(compaction._Files, "rename", dies)
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact_week(spark, root, n.SUCCESS, 2022, 1)
    assert store.read_store(spark, root).count() == held
    with pytest.raises(RuntimeError, match="under way"):
        compaction.compact_week(spark, root, n.SUCCESS, 2022, 1)
    assert compaction.vacuum(spark, root, n.SUCCESS, grace_seconds=-1) == 1
    assert compaction.compact_week(spark, root, n.SUCCESS, 2022, 1) == (3, 1)
    assert store.read_store(spark, root).count() == held
    assert compaction.compact_week(spark, root, n.SUCCESS, 2022, 1) == (0, 0)


def test_bins_of_small_files():
    sizes = {"a": 10, "b": 30, "c": 49, "d": 50, "e": 90, "f": 20, "g": 41}
    assert compaction.bins_of(sizes, 100) == [["a", "f", "b"], ["g", "c"]]
    assert compaction.bins_of({"a": 10}, 100) == compaction.bins_of({}, 100) == []
