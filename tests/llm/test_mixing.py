import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import documents, empty, messy
from tidemark.llm import mixing


def reshared(sizes, weights=(3, 1, 2), share=1.5):
    """Targets by dealing out, and dealing what is above twice a size again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left = dict.fromkeys(order, 0.0), share * sum(sizes.values())
    open_sources = list(order)
    while left > 1e-9 and open_sources:
        whole = sum(weight[s] for s in open_sources)
        for s in open_sources:
            target[s] += left * weight[s] / whole
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in open_sources)
        full = [s for s in open_sources if target[s] >= 2 * sizes[s]]
        for s in full:
            target[s] = 2.0 * sizes[s]
        open_sources = [s for s in open_sources if s not in full]
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice([0, 1, 10, 500, 10_000]) for k in range(9)} | {None: 300, "": 40}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(reshared(sizes))


def test_taken_words_meet_targets(spark):
    rows = [(k, "w " * (k % 40), "en", f"s{k % 3}" if k % 2 else "hot") for k in range(900)]
    source = {k: name for k, _, _, name in rows}
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in mixing.mix_sources(documents(spark, rows)).collect():
        key = source[r["doc_id"]]
        taken[key] += r["taken"]
        target[key] = r["target"]
        largest[key] = max(largest[key], r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert all(abs(taken[k] - target[k]) <= largest[k] / 2 for k in taken)


def test_every_row_of_a_messy_table_comes_back_the_same_twice(spark):
    docs = messy(spark)
    once, again = mixing.mix_sources(docs).collect(), mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, again))
    assert len(once) == docs.count()
    assert all(r["taken"] == 0 for r in once if r["size"] == 0)


def test_documents_keep_their_columns(spark):
    docs = messy(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    words = mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == sum(r["taken"] for r in mixing.mix_sources(docs).collect())


def test_empty_table(spark):
    assert mixing.mix_sources(empty(spark)).collect() == []
    assert mixing.mixed_documents(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark, plan_of):
    assert "Python" not in plan_of(mixing.mix_sources(messy(spark)))
    assert "Arrow" not in plan_of(mixing.mix_sources(messy(spark)))
