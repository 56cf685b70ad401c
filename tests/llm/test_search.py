import math
import random
import re

import numpy as np
import pytest

from tests.llm.frames import documents, empty, messy, prose, vocabulary
from tidemark.llm import search as se

ITEM = "item_id long, text string"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, queries, best):
    """(item, text) to the ranked (doc_id, score), by scoring every document."""
    held = [(doc_id, words(text)) for doc_id, text in docs]
    n_docs, n_terms = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    found = {}
    for item, text in {q for q in queries if words(q[1])}:
        rows = []
        for doc_id, own in held:
            score = 0
            for term in set(words(text)):
                df = sum(term in w for _, w in held)
                if tf := own.count(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * len(own) * n_docs // n_terms)))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0))
        found[item, text] = [(None if null else d, -s) for s, null, d in sorted(rows)[:best]]
    return found


def ranked(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        found.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return found


def fixture(seed, rows=300):
    rng, known = random.Random(seed), vocabulary(80)
    docs = [(k, prose(rng, rng.randint(0, 120), known[: rng.choice([5, 30, 80])])) for k in range(rows)]
    docs += [(1000 + k, docs[3][1]) for k in range(40)]  # copies: ties
    rare = [(2000 + k, f"{prose(rng, 30, known)} rare{k % 3}") for k in range(9)]
    items = [(k, prose(rng, rng.randint(1, 12), known)) for k in range(25)]
    items += [(90, "rare1 " + known[0]), (91, "nowhere"), (92, " .,"), (93, None), (94, docs[3][1])]
    return docs + rare, items


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 2_000}, {"shard_bytes": 1}, {"block_terms": 20}, {"best": 3}])
def test_the_best_equal_brute_force(spark, options):
    docs, items = fixture(1)
    frame = documents(spark, [(*row, "en", "s") for row in docs])
    got = ranked(se.search(frame, spark.createDataFrame(items, ITEM), **options))
    want = brute(docs, items, options.get("best", se.BEST))
    assert got == {item: [(k + 1, *row) for k, row in enumerate(rows)] for (item, _), rows in want.items() if rows}


def test_messy_and_empty_tables(spark):
    docs = messy(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "same line"), (1, "same line"), (None, "word WORD"), (3, ""), (4, None), (5, rows[7][1])]
    bench = spark.createDataFrame(items, ITEM)
    want = brute(rows, items, 50)
    got = ranked(se.search(docs, bench))
    assert got == {item: [(k + 1, *row) for k, row in enumerate(rows)] for (item, _), rows in want.items() if rows}
    assert se.search(empty(spark), bench).collect() == []
    assert se.search(docs, spark.createDataFrame([], ITEM)).collect() == []


def test_blocks_are_packed_in_few_bytes_and_come_back():
    rng = np.random.default_rng(2)
    for high in (3, 200, 70_000, 2**40):
        docs = np.cumsum(rng.integers(1, high, 128))
        tfs = rng.integers(1, high, 128)
        found = se.unpack(se.pack(docs, tfs))
        assert [column.tolist() for column in found] == [docs.tolist(), tfs.tolist()]
    assert len(se.pack(np.arange(128), np.ones(128, np.int64))) == 2 + 256


def test_block_maxima_spare_the_unpacking_of_blocks():
    rng = random.Random(3)
    common, rare = 0, 1
    texts = [(k, [common] * rng.randint(1, 3) + ([rare] * 3 if k % 500 == 7 else [])) for k in range(20_000)]
    shard = se.index_shard(texts, np.array([len(t) + 5 for _, t in texts]), 20_000, 300_000)
    searcher = se.Searcher(shard)
    docs, scores = searcher.search([(common, 10), (rare, 6_000)], 10, 1)
    whole = se.Searcher(shard)
    all_docs, all_scores = whole._blocks(range(len(shard.blocks)))
    assert len(whole.unpacked) == len(shard.blocks) > 150
    bar = int(np.sort(scores)[-10])
    again = se.Searcher(shard)
    best, found = again.search([(common, 10), (rare, 6_000)], 10, bar)
    assert len(again.unpacked) < len(shard.blocks) / 3
    assert sorted(found.tolist())[-10:] == sorted(scores.tolist())[-10:]


def test_the_bar_of_earlier_shards_holds_for_later_ones():
    heap = se.Heap(2)
    heap.add([5, 4, None], [10, 10, 10])
    assert heap.rows == [(-10, False, 4), (-10, False, 5)] and heap.bar == 10
    heap.add([1], [9])
    heap.add([3], [10])
    assert heap.rows == [(-10, False, 3), (-10, False, 4)]
