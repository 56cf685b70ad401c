import corpus_pipeline
from tests.llm.frames import empty, messy
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_mixing import reshared
from tidemark.llm import quality
from tidemark.llm.mixing import word_count

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, SF)


def test_stages_follow_each_other(spark):
    """Each stage's rows against what its rule says of the rows it was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stage(spark, "quality", docs)
    assert kept.columns == COLUMNS
    good = {r["doc_id"] for r in quality.quality_verdicts(docs, labels).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good
    assert 0 < len(good) < docs.count()

    single = stage(spark, "near_dedup", kept.cache())
    from tests.llm.test_neardup import brute

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    components = {eval(r)[2] for r in brute(rows)}  # noqa: S307
    assert single.columns == COLUMNS
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(components)

    clean = stage(spark, "decontaminate", single.cache())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean.columns == COLUMNS
    want = {r["doc_id"] for r in single.collect() if not contaminated(r["text"], items)[0]}
    assert {r["doc_id"] for r in clean.collect()} == want

    mixed = stage(spark, "mix", clean.cache())
    assert mixed.columns == COLUMNS
    count = lambda f: {r["source"]: r["n"] for r in f.groupBy("source").agg({"w": "sum"}).withColumnRenamed("sum(w)", "n").collect()}
    target = reshared(count(clean.withColumn("w", word_count(clean["text"]))))
    taken = count(mixed.withColumn("w", word_count(mixed["text"])))
    longest = max(len(r["text"].split()) for r in clean.collect())
    assert all(abs(taken.get(s, 0) - t) <= longest for s, t in target.items())

    files = stage(spark, "token_files", mixed.cache()).collect()
    assert sorted(r["doc_id"] for r in files) == sorted(r["doc_id"] for r in mixed.collect())


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows
    starts = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def test_stages_take_messy_and_empty_tables(spark):
    for docs in (messy(spark), empty(spark)):
        for name, function in corpus_pipeline.STAGES:
            result = function(spark, docs, SF)
            assert name == "token_files" or result.columns == docs.columns
            result.collect()


def test_intermediate_tables_are_removed(spark):
    from pathlib import Path

    from tidemark.llm import common

    common.remove_written(spark)
    frame = common.written(spark.range(5).toDF("x"), "removed")
    (path,) = common._WRITTEN[spark.sparkContext.applicationId]
    assert frame.count() == 5 and Path(path).exists()
    assert common.remove_written(spark) == 1 and not Path(path).exists()
    assert common.remove_written(spark) == 0
