import pytest

from tests.test_job import LOG, log_of, message, shops, stores
from tidemark.streaming.stream import ingest_stream


def write_slice(spark, rows, path):
    log_of(spark, rows).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, on_batch=None, **other):
    source = (
        spark.readStream.schema(LOG)
        .option("maxFilesPerTrigger", "1")
        .parquet(str(tmp_path / "log"))
    )
    query = ingest_stream(
        source,
        lambda: shops(spark),
        str(tmp_path / "out"),
        str(tmp_path / "checkpoint"),
        on_batch=on_batch,
        **other,
    )
    query.awaitTermination()


FIRST = [message(0, 1), message(1, 1, hours=1), message(2, 2, shop=10)]
SECOND = [message(3, 1, hours=2), message(4, 3, shop=3), message(5, 2, shop=10, hours=3)]
EXPECTED = ([(1, "shop#2"), (3, "shop#3")], [(2, None), (2, None)])


def test_bounded_micro_batches_then_only_what_is_new(spark, tmp_path):
    reports = []
    write_slice(spark, FIRST, str(tmp_path / "log"))
    run(spark, tmp_path, lambda i, report: reports.append(report))
    write_slice(spark, SECOND, str(tmp_path / "log"))
    write_slice(spark, [message(6, None, value="{")], str(tmp_path / "log"))
    run(spark, tmp_path, lambda i, report: reports.append(report))
    assert sorted(r.read for r in reports) == [1, 3, 3]
    success, failed = EXPECTED
    assert stores(spark, tmp_path / "out") == (success, [*failed, (None, None)])


def test_a_micro_batch_run_again_after_a_crash_adds_no_row(spark, tmp_path):
    write_slice(spark, FIRST, str(tmp_path / "log"))

    def crash(*_):
        raise RuntimeError("lost after both stores were written")

    with pytest.raises(Exception, match="lost after both"):
        run(spark, tmp_path, crash)
    write_slice(spark, SECOND, str(tmp_path / "log"))
    run(spark, tmp_path)
    assert stores(spark, tmp_path / "out") == EXPECTED


def test_the_submitted_program_runs_on_its_environment(spark, tmp_path, monkeypatch):
    import tidemark.__main__ as program
    from tests.test_sources import ENV

    asked = {}

    def files(spark, options, offsets_per_batch, starting):
        asked.update(options, cap=offsets_per_batch, starting=starting)
        return spark.readStream.schema(LOG).parquet(str(tmp_path / "log"))

    write_slice(spark, FIRST, str(tmp_path / "log"))
    settings = {"WRITE_TO": str(tmp_path / "out"), "BATCH_SIZE": "50", "TOPIC_PARTITIONS": "4"}
    for name, value in {**ENV, **settings}.items():
        monkeypatch.setenv(name, value)
    monkeypatch.setattr(program, "read_stream", files)
    monkeypatch.setattr(program, "load_dictionary", lambda spark, _: shops(spark))
    program.main()
    assert stores(spark, tmp_path / "out") == ([(1, "shop#2")], [(2, None)])
    assert (asked["subscribe"], asked["cap"], asked["starting"]) == ("orders", 200, "earliest")


def test_the_submitted_program_runs_one_bounded_batch(spark, tmp_path, monkeypatch):
    import tidemark.__main__ as program
    from tests.test_job import table_reader
    from tests.test_sources import ENV
    from tidemark.plans import job

    asked = []
    reader = table_reader(log_of(spark, FIRST), asked, 1)
    settings = {"WRITE_TO": str(tmp_path / "out"), "BATCH_SIZE": "2", "RUN": "batch"}
    for name, value in {**ENV, **settings}.items():
        monkeypatch.setenv(name, value)
    monkeypatch.setattr(job, "read_range", lambda spark, options: reader(options))
    monkeypatch.setattr(program, "load_dictionary", lambda spark, _: shops(spark))
    for _ in range(3):
        program.main()
    assert stores(spark, tmp_path / "out") == ([(1, "shop#2")], [(2, None)])
    assert asked == [
        ("earliest", "latest"),  # nothing is known of the topic yet
        ('{"orders":{"0":0}}', '{"orders":{"0":2}}'),
        ('{"orders":{"0":2}}', "latest"),
        ('{"orders":{"0":2}}', '{"orders":{"0":3}}'),
        ('{"orders":{"0":3}}', "latest"),
    ]


def test_the_stream_must_know_its_partitions(monkeypatch):
    import tidemark.__main__ as program

    monkeypatch.delenv("TOPIC_PARTITIONS", raising=False)
    with pytest.raises(KeyError):
        program.run_stream(None, None)


def test_copies_within_the_horizon_never_reach_a_batch(spark, tmp_path):
    """Across restarts of the stream; a copy beyond the horizon is left to the stores."""
    reports = []

    def slice_of(*rows):
        write_slice(spark, list(rows), str(tmp_path / "log"))
        before = len(reports)
        run(spark, tmp_path, lambda _, report: reports.append(report), horizon="10 hours")
        return [report for report in reports[before:] if report.read]

    (report,) = slice_of(*FIRST, message(3, None, value="{"), message(4, None, value="{"))
    assert report.read == 4  # order 1 once, order 2, and both messages without an order
    (report,) = slice_of(message(5, 1, hours=5), message(6, 7, hours=6))
    assert (report.read, report.success) == (1, 1)
    (report,) = slice_of(message(7, 9, hours=30))  # the horizon moves on
    assert report.success == 1
    (report,) = slice_of(message(8, 1, hours=31), message(9, 9, hours=31))
    assert (report.read, report.dup_stored) == (1, 1)
    success, _ = stores(spark, tmp_path / "out")
    assert success == [(1, "shop#2"), (7, "shop#2"), (9, "shop#2")]
