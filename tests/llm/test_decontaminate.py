import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from tests.llm.frames import documents, empty, messy, prose, vocabulary
from tidemark.llm import decontaminate as dc

ITEM = "item_id long, text string"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window=10):
    """Hit words, items that occur, and the longest match of each item, all by comparing."""
    own, hit, occurs, longest = words(text), set(), set(), {}
    for item, other in items:
        asked = words(other)
        size = min(window, len(asked))
        for k in range(len(asked) - size + 1) if asked else []:
            for at in range(len(own) - size + 1):
                if own[at : at + size] == asked[k : k + size]:
                    hit |= set(range(at, at + size))
                    occurs.add(str(item))
        best = 0
        for k in range(len(asked)):
            for at in range(len(own)):
                n = 0
                while k + n < len(asked) and at + n < len(own) and asked[k + n] == own[at + n]:
                    n += 1
                best = max(best, n)
        longest[str(item)] = best
    return sorted(hit), occurs, longest


def fixture(seed):
    rng, known = random.Random(seed), vocabulary(60)
    items = [(k, prose(rng, rng.randint(1, 40), known)) for k in range(25)]
    items += [(90, None), (91, " .,!"), (92, items[0][1]), (93, known[0]), (94, items[3][1].upper())]
    rows = []
    for k in range(60):
        text = prose(rng, rng.randint(0, 60), known)
        if k % 3 == 0:
            part = items[rng.randrange(25)][1].split()
            at = rng.randrange(len(part))
            text += " " + ", ".join(part[at : at + rng.randint(1, 25)]).title() + " " + prose(rng, 5, known)
        rows.append((k, text, "en", "s"))
    return rows, items


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"block_words": 30}), (3, {"shard_bytes": 200}), (4, {"window": 4})])
def test_hits_items_and_matches_equal_brute_force(spark, seed, options):
    rows, items = fixture(seed)
    found = dc.find_matches(documents(spark, rows), spark.createDataFrame(items, ITEM), **options)
    for r in found.collect():
        text = r["row"]["text"]
        hit, occurs, longest = brute(text, items, options.get("window", 10))
        assert r["n_words"] == len(words(text))
        assert r["hits"] == hit
        assert {m["item_id"] for m in r["matches"] if m["occurs"]} == occurs
        own = words(text)
        for m in r["matches"]:  # every match told is one, where it says
            asked = words(dict((str(k), t) for k, t in items)[m["item_id"]])
            part = own[m["at"] : m["at"] + m["longest"]]
            assert part in [asked[k : k + len(part)] for k in range(len(asked))]
            assert m["longest"] <= longest[m["item_id"]]
        for item in occurs:  # and where an item occurs, its longest match is told
            assert longest[item] >= max(m["longest"] for m in r["matches"] if m["item_id"] == item)


def test_longest_matches_of_a_shard():
    rows, items = fixture(5)
    bench = dc.Benchmark([(str(k), words(t)) for k, t in items])
    texts = [words(text) for _, text, *_ in rows]
    _, _, found = dc.search_shard(texts, bench)
    for number, item in enumerate(bench.item_ids):
        best = max(brute(text, [(item, dict((str(k), t) for k, t in items)[item])])[2][item] for _, text, *_ in rows)
        told = found[found["item"] == number]["longest"].max() if number in set(found["item"]) else 0
        assert told == best or best == 1  # single words start no match unless they are an item


def test_contaminated_documents_go(spark):
    rows, items = fixture(6)
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, ITEM)
    kept = dc.decontaminate(docs, bench)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert {r["doc_id"] for r in kept.collect()} == {k for k, t, *_ in rows if not brute(t, items)[0]}


def test_messy_and_empty_tables(spark):
    docs, none = messy(spark), spark.createDataFrame([], ITEM)
    rows = dc.contamination(docs, none).collect()
    assert len(rows) == docs.count()
    assert not any(r["contaminated"] for r in rows)
    bench = spark.createDataFrame([(None, "word"), (2, "word"), (2, "word"), (None, None)], ITEM)
    rows = dc.contamination(docs, bench).collect()
    assert [(r["doc_id"], r["n_hit"], r["n_items"]) for r in rows if r["contaminated"]] == [(4, 1, 2)]
    assert dc.contamination(empty(spark), bench).collect() == []
    assert dc.decontaminate(empty(spark), bench).collect() == []


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 1}, {"shard_bytes": 1500}, {"block_words": 120}])
def test_longest_matches_equal_brute_force_for_every_holder(spark, options):
    rows, items = fixture(7)
    rng, known = random.Random(8), vocabulary(60)
    long = prose(rng, 100, known)
    items += [(200, long), (201, " ".join(long.split()[40:70]))]
    parts = [long, long, " ".join(long.split()[:10]), " ".join(long.split()[5:60]), long + " " + long]
    rows += [(500 + k, f"{prose(rng, 3, known)} {part} {prose(rng, 3, known)}", "en", "s") for k, part in enumerate(parts)]
    rows += [(600, "q", "en", "s"), (601, items[0][1].split()[0] + " q", "en", "s"), (602, None, "en", "s")]
    docs, bench = documents(spark, rows), spark.createDataFrame(items, ITEM)
    want = {k: brute(text, items) for k, text, *_ in rows}
    for r in dc.find_matches(docs, bench, **options).collect():
        _, occurs, longest = want[r["row"]["doc_id"]]
        own, texts = words(r["row"]["text"]), {str(k): words(t) for k, t in items}
        assert {m["item_id"]: m["longest"] for m in r["matches"] if m["occurs"]} == {i: longest[i] for i in occurs}
        for m in r["matches"]:
            part = own[m["at"] : m["at"] + m["longest"]]
            assert len(part) == m["longest"]
            assert part in [texts[m["item_id"]][k : k + len(part)] for k in range(len(texts[m["item_id"]]))]
    for r in dc.contamination(docs, bench, **options).collect():
        assert r["longest"] == max(want[r["doc_id"]][2].values())


def peak_of(work):
    tracemalloc.start()
    try:
        found = work()
        return found, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_prompt_that_many_items_share_takes_bounded_memory():
    rng, known = random.Random(9), vocabulary(300)
    prompt = [rng.choice(known) for _ in range(30)]
    items = [(str(k), [*prompt, f"q{k}", *(rng.choice(known) for _ in range(15))]) for k in range(2_000)]
    texts = [["so", *prompt, f"q{k}", "end"] for k in range(300)]
    bench = dc.Benchmark(items)
    (shard, hit, found), peak = peak_of(lambda: dc.search_shard(texts, bench))
    assert peak < 400 << 20
    assert len(hit) == sum(31 if k < 2_000 else 30 for k in range(300))
    occurs = found[found["occurs"]]
    assert len(occurs) == 300 * 2_000
    own = occurs["item"] == occurs["text"]
    assert occurs[~own]["longest"].eq(30).all()
    assert occurs[own]["longest"].eq(31).all()
    clean = dc.Shard([["so", *prompt[:9], "end"]], bench)
    assert not len(clean.hit())


def test_a_text_of_one_word_takes_bounded_memory():
    bench = dc.Benchmark([("a", ["same"] * 100), ("b", ["same"] * 12 + ["other"])])
    texts = [["same"] * 40_000, ["x", *["same"] * 11, "other"]]
    (shard, hit, found), peak = peak_of(lambda: dc.search_shard(texts, bench))
    assert peak < 300 << 20
    assert len(hit) == 40_000 + 12
    told = {(r.text, r.item): r.longest for r in found[found["occurs"]].itertuples()}
    assert told == {(0, 0): 100, (0, 1): 12, (1, 0): 11, (1, 1): 12}


def test_rows_leave_in_batches_of_bounded_matches(monkeypatch):
    rng, known = random.Random(10), vocabulary(60)
    part = [rng.choice(known) for _ in range(12)]
    bench = dc.Benchmark([(str(k), [*part, str(k)]) for k in range(40)])
    texts = [[*part, str(k)] for k in range(30)] + [["nothing"], []]
    monkeypatch.setattr(dc, "BATCH_MATCHES", 50)
    shard, hit, found = dc.search_shard(texts, bench)
    names = pa.array(bench.item_ids).take(pa.array(found["item"].to_numpy()))
    told = list(dc._told(pa.array(range(32)), texts, shard.starts, hit, [(found, names)]))
    assert len(told) >= 15
    rows = [row for batch in told for row in batch.to_pylist()]
    assert [r["row"] for r in rows] == list(range(32))
    for k, r in enumerate(rows[:30]):
        assert r["hits"] == list(range(13))
        longest = {m["item_id"]: m["longest"] for m in r["matches"] if m["occurs"]}
        assert longest == {str(j): 13 if j == k else 12 for j in range(40)}
        assert {m["at"] for m in r["matches"]} == {0}
    assert rows[30]["hits"] == rows[31]["hits"] == rows[30]["matches"] == rows[31]["matches"] == []
