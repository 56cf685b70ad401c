from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.messages import flatten_messages
from tidemark.operators import enrich

TEXT_LOG = "key string, value string, timestamp string"


def orders(spark):
    """A shop with two orders, one that is unknown, and an order that names none."""
    shops = {501: 44, 502: None, 503: 45, 504: 44, 505: 90}
    rows = [
        (None, f'{{"id":{id_},"shopId":{shop or "null"}}}', f"2023-05-{day:02} 08:30:00")
        for day, (id_, shop) in enumerate(shops.items(), 1)
    ]
    return flatten_messages(spark.createDataFrame(rows, TEXT_LOG))


def shops(spark):
    return spark.createDataFrame([(44, "north"), (45, "south")], "id int, name string")


def test_match_and_no_match(spark):
    for limit in (enrich.BROADCAST_BYTES, 0):
        rows = enrich.enrich_with_dictionary(orders(spark), shops(spark), broadcast_bytes=limit)
        assert rows.columns == n.RESULT_COLUMNS
        names = {r[n.ID]: r[n.SHOP_NAME] for r in enrich.sort_by_partition(rows).collect()}
        assert names == {501: "north", 502: None, 503: "south", 504: "north", 505: None}


def test_shop_id_can_be_kept(spark):
    rows = enrich.enrich_with_dictionary(orders(spark), shops(spark), keep=[n.SHOP_ID])
    assert sorted((r[n.SHOP_ID] or 0) for r in rows.collect()) == [0, 44, 44, 45, 90]


def test_dictionary_is_broadcast_only_up_to_its_limit(spark, plan_of):
    assert enrich.dictionary_bytes(shops(spark)) == 2 * (5 + 64)
    assert enrich.dictionary_bytes(shops(spark).limit(0)) == 0
    small = enrich.enrich_with_dictionary(orders(spark), shops(spark), broadcast_bytes=138)
    large = enrich.enrich_with_dictionary(orders(spark), shops(spark), broadcast_bytes=137)
    assert "BroadcastHashJoin" in plan_of(small)
    assert "SortMergeJoin" in plan_of(large)


def test_a_hot_shop_is_split_beyond_the_broadcast_limit(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 300_000, numPartitions=16).select(
            "id",
            F.when(F.col("id") % 3 == 0, F.lit(7))
            .when(F.col("id") % 3 == 1, F.lit(None))
            .otherwise(F.col("id") % 1000)
            .cast("long")
            .alias("shop_id"),
            F.timestamp_seconds("id").alias("receive_time"),
            F.timestamp_seconds("id").alias("order_timestamp"),
            F.lit(1970).alias("year"),
            F.lit(1).alias("week_number"),
        )
        names = spark.range(0, 900).select("id", F.concat(F.lit("shop#"), "id").alias("name"))
        found = enrich.enrich_with_dictionary(rows, names, broadcast_bytes=0)
        counts = found.agg(F.count(F.lit(1)).alias("all"), F.count(n.SHOP_NAME).alias("named"))
        got = counts.collect()[0]
        assert got["all"] == 300_000
        assert got["named"] == rows.filter("shop_id < 900").count()
        assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_lookup_reaches_the_source(spark, plan_of, tmp_path):
    path = str(tmp_path / "shops")
    shops(spark).write.parquet(path)
    found = enrich.dictionary_lookup(spark.read.parquet(path), 45)
    assert [r[n.DICTIONARY_NAME] for r in found.collect()] == ["south"]
    assert "EqualTo(id,45)" in plan_of(found)
    assert enrich.dictionary_lookup(spark.read.parquet(path), 46).isEmpty()


def test_sort_puts_null_weeks_first_and_can_split_a_week(spark, plan_of):
    ddl = "receive_time string, id long, year int, week_number int"
    rows = [("b", 1, 2022, 2), ("a", 2, 2022, 2), ("c", 3, None, None), ("d", 4, 2021, 53)]
    frame = enrich.sort_by_partition(spark.createDataFrame(rows, ddl))
    assert [r["id"] for r in frame.collect()] == [3, 4, 2, 1]
    ranges = plan_of(frame).split("rangepartitioning(")[1]
    assert "receive_time" in ranges.split("\n")[0]
