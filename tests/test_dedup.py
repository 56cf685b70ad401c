import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.frames import local_frame
from tidemark import names as n
from tidemark.operators import dedup

FLAT = (
    "id long, shop_id long, receive_time timestamp, order_timestamp timestamp, "
    "year int, week_number int, partition int, offset long"
)
DAY = dt.datetime(2022, 1, 4)


def flat_row(id_, offset, shop=2, hours=0, week=1, partition=0):
    return (id_, shop, DAY + dt.timedelta(hours=hours), DAY, 2022, week, partition, offset)


def test_anti_join_looks_at_id_year_and_week_alone(spark):
    """Stored rows with other shops and times still count; other weeks or years do not."""
    batch = [flat_row(40, 0, shop=9, hours=5), flat_row(41, 1, week=3), flat_row(42, 2)]
    last_year = list(flat_row(42, 0))
    last_year[4] = 2021
    stored = [flat_row(40, 7, shop=1), flat_row(41, 8, week=4), tuple(last_year)]
    frame, known = spark.createDataFrame(batch, FLAT), spark.createDataFrame(stored, FLAT)
    for rows in (None, 3):
        kept = dedup.anti_join_stored(frame, known, batch_rows=rows)
        assert sorted(r[n.ID] for r in kept.collect()) == [41, 42]
        assert kept.columns == frame.columns


def test_same_id_in_another_week_and_null_id_are_kept(spark):
    batch = spark.createDataFrame([flat_row(1, 0, week=2), flat_row(None, 1)], FLAT)
    stored = spark.createDataFrame([flat_row(1, 0), flat_row(None, 1)], FLAT)
    for rows in (None, 2):
        kept = dedup.anti_join_stored(batch, stored, [(2022, 1), (2022, 2)], batch_rows=rows)
        assert kept.count() == 2


def test_repeated_stored_keys_do_not_matter(spark):
    batch = spark.createDataFrame([flat_row(1, 0), flat_row(2, 1)], FLAT)
    stored = spark.createDataFrame([flat_row(1, 0)] * 3, FLAT)
    kept = dedup.anti_join_stored(batch, stored, batch_rows=2)
    assert [r[n.ID] for r in kept.collect()] == [2]


def test_first_arrival_survives_then_position(spark):
    rows = [
        flat_row(1, 9, shop=1, hours=2),
        flat_row(1, 7, shop=2, hours=1, partition=1),
        flat_row(1, 8, shop=3, hours=1, partition=0),
        flat_row(None, 1, shop=4),
        flat_row(None, 2, shop=5),
    ]
    frame = spark.createDataFrame(rows, FLAT).repartition(4)
    kept = dedup.dedup_in_batch(frame, copies=n.COPIES)
    assert {(r[n.ID], r[n.SHOP_ID], r[n.COPIES]) for r in kept.collect()} == {
        (1, 3, 3),
        (None, 4, 2),
    }


def test_a_dated_copy_beats_one_without_a_time(spark):
    untimed = (1, 5, None, DAY, None, None, 0, 0)
    rows = [untimed, flat_row(1, 9, shop=6, hours=8), (2, 7, None, DAY, None, None, 1, 3)]
    kept = dedup.dedup_in_batch(spark.createDataFrame(rows, FLAT).repartition(3)).collect()
    assert {(r[n.ID], r[n.SHOP_ID]) for r in kept} == {(1, 6), (2, 7)}


def test_composed_dedup_reads_the_batch_once(spark):
    """The messages are counted as they are read: once, however often the result is used."""
    read = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [flat_row(i % 20, i) for i in range(50)]
    flat = spark.createDataFrame(rows, FLAT)
    counted = flat.mapInArrow(tell, flat.schema)
    stored = spark.createDataFrame([flat_row(3, 0)], FLAT)
    kept = dedup.dedup_incremental(counted, stored)
    assert kept.columns == flat.columns
    assert len(kept.collect()) == 19
    assert read.value == 50


ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.integers(0, 2), st.integers(1, 2)
)


@settings(max_examples=8, deadline=None)
@given(batch=st.lists(ROW, min_size=1, max_size=12), known=st.lists(ROW, max_size=6))
def test_incremental_dedup_equals_brute_force(spark, batch, known):
    rows = [
        flat_row(i, offset, hours=hours, partition=part, week=week)
        for offset, (i, hours, part, week) in enumerate(batch)
    ]
    stored_rows = [flat_row(i, 0, week=week) for i, _, _, week in known]
    first = {}
    for row in sorted(rows, key=lambda r: (r[2], r[6], r[7])):
        first.setdefault(row[0], row)
    stored_keys = {(r[0], r[4], r[5]) for r in stored_rows if r[0] is not None}
    expected = {r for r in first.values() if (r[0], r[4], r[5]) not in stored_keys}

    frame = local_frame(spark, rows, FLAT)
    stored = local_frame(spark, stored_rows, FLAT)
    assert {tuple(r) for r in dedup.dedup_incremental(frame, stored).collect()} == expected


def test_store_scan_is_pruned_to_the_weeks_and_ids_of_the_batch(spark, plan_of, tmp_path):
    rows = [flat_row(i, i, week=w) for i, w in enumerate([1, 1, 2, 3, 4])]
    path = str(tmp_path / "store")
    spark.createDataFrame(rows, FLAT).write.partitionBy("year", "week_number").parquet(path)
    stored = spark.read.parquet(path)
    batch = spark.createDataFrame([flat_row(1, 0, week=1), flat_row(9, 1, week=3)], FLAT)
    for size in (None, 2):
        kept = dedup.anti_join_stored(batch, stored, dedup.weeks_of(batch), (1, 9), size)
        plan = plan_of(kept)
        assert "week_number" in plan.split("PartitionFilters: ")[1].split("]")[0]
        assert "GreaterThanOrEqual(id,1)" in plan and "LessThanOrEqual(id,9)" in plan
        assert "ReadSchema: struct<id:bigint>" in plan
        assert [r[n.ID] for r in kept.collect()] == [9]


def test_a_small_batch_does_not_shuffle_the_store(spark, plan_of, tmp_path):
    path = str(tmp_path / "store")
    stored = spark.createDataFrame([flat_row(1, 1)], FLAT)
    stored.write.partitionBy("year", "week_number").parquet(path)
    batch = spark.createDataFrame([flat_row(1, 0)], FLAT)
    kept = dedup.anti_join_stored(batch, spark.read.parquet(path), [(2022, 1)], (1, 1), 1)
    plan = plan_of(kept)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_very_many_weeks_prune_by_year(spark, plan_of, tmp_path):
    path = str(tmp_path / "store")
    stored = spark.createDataFrame([flat_row(1, 1)], FLAT)
    stored.write.partitionBy("year", "week_number").parquet(path)
    weeks = [(year, week) for year in range(2000, 2025) for week in range(1, 53)]
    assert len(weeks) > dedup.MAX_LITERAL_WEEKS
    assert dedup.only_weeks(spark.read.parquet(path), weeks).count() == 1
    assert dedup.only_weeks(spark.read.parquet(path), [(None, None)]).count() == 0


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    flat = spark.range(0, 90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"),
        F.lit(DAY).alias("receive_time"),
        F.col("id").alias("offset"),
    )
    kept = dedup.dedup_in_batch(flat, copies=n.COPIES)
    assert kept.count() == 60_001
    hot = kept.filter("id is null").first()
    assert (hot["offset"], hot[n.COPIES]) == (0, 30_000)
    plan = dedup.dedup_in_batch(flat)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_min")


def test_weeks_between_hold_both_sides_of_a_new_year():
    import datetime as dt

    pairs = dedup.weeks_between(dt.date(2020, 12, 26), dt.date(2021, 1, 5))
    assert pairs == [(2020, 52), (2020, 53), (2021, 1), (2021, 53)]
