"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

The index has one row per shard of documents: postings of each term in blocks, packed in as
few bytes as they need, and beside each block its last document and the highest impact in it.
A shard is searched for one query after the other. The lists' highest scores, in ascending
order, tell which lists are essential: a document outside all of these cannot reach the
lowest score among the best found so far. Documents of the essential lists are candidates; the
other lists are asked from the highest bound down, and the maximum of the block in which a
candidate would lie rejects it before the block is unpacked. What a task has found for a
query in its earlier shards raises the bar for the later ones. The best of all tasks are merged.

The scores are integers: w * ((1000000000 tf) div (1000 tf + 20 m)) summed over a query's
different terms, with m = 50 + (50 n N div L) for a document of n terms.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, open_folder, shared_folder, table, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 50
#: Postings in a block, bytes of text in a shard, terms of queries that are searched together.
BLOCK = 128
SHARD_BYTES = 32 << 20
QUERY_TERMS = 500_000

_TERMS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NONE = np.zeros(0, np.int64)


def terms_of(text: str | None) -> list[str]:
    """Runs of ASCII letters and digits and of other non-ASCII characters, A-Z lower-cased."""
    return _TERMS.findall(text.encode().lower().decode()) if text else []  # bytes: ASCII only


def term_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TERM)), F.lit(0)).cast("long")


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


# --- postings -----------------------------------------------------------------


def _narrow(numbers: np.ndarray) -> tuple[int, bytes]:
    """The numbers in the fewest of 1, 2, 4 or 8 bytes each."""
    most = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1) or w == 8)
    return width, numbers.astype(f"<i{width}" if width > 1 else "u1").tobytes()


def _wide(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}" if width > 1 else "u1").astype(np.int64)


def pack(docs: np.ndarray, tfs: np.ndarray) -> bytes:
    """A block: the widths, the first document and the gaps, and the frequencies."""
    gap_width, gaps = _narrow(np.diff(docs, prepend=0))
    tf_width, counts = _narrow(tfs)
    return bytes([gap_width, tf_width]) + gaps + counts


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    gap_width, tf_width = block[0], block[1]
    size = (len(block) - 2) // (gap_width + tf_width)
    middle = 2 + size * gap_width
    return np.cumsum(_wide(gap_width, block[2:middle])), _wide(tf_width, block[middle:])


class Shard:
    """The index of a shard of documents, numbered by ascending id; null ids come last."""

    def __init__(self, doc_ids: list[int | None], sizes: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.doc_ids = doc_ids
        #: m of each document; Python's integers, as 50 n N may not fit a long.
        self.m = np.array([50 + 50 * n * n_docs // max(n_terms, 1) for n in sizes.tolist()], np.int64)
        self.lists: dict[int, int] = {}
        self.counts, self.tops, self.first_blocks = [], [], [0]
        self.last_docs, self.block_tops, self.blocks = [], [], []

    def add(self, term: int, docs: np.ndarray, tfs: np.ndarray) -> None:
        """The postings of a term, ascending."""
        self.lists[term] = len(self.counts)
        worth = impacts(tfs, self.m[docs])
        for start in range(0, len(docs), BLOCK):
            part = slice(start, start + BLOCK)
            self.blocks.append(pack(docs[part], tfs[part]))
            self.last_docs.append(int(docs[part][-1]))
            self.block_tops.append(int(worth[part].max()))
        self.counts.append(len(docs))
        self.tops.append(int(worth.max()))
        self.first_blocks.append(len(self.blocks))

    def row(self, number: int) -> dict:
        order = sorted(self.lists)
        return {
            "shard": number,
            "terms": order,
            "counts": [self.counts[self.lists[term]] for term in order],
            "data": pickle.dumps(self, protocol=5),
        }


def index_shard(
    texts: list[tuple[int | None, list[int]]], sizes: np.ndarray, n_docs: int, n_terms: int
) -> Shard:
    """texts: id and numbers of the asked terms of each document; sizes: all its terms."""
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is None, texts[k][0] or 0))
    shard = Shard([texts[k][0] for k in order], sizes[order], n_docs, n_terms)
    lengths = np.fromiter((len(texts[k][1]) for k in order), np.int64, len(order))
    doc = np.repeat(np.arange(len(order)), lengths)
    term = np.fromiter((t for k in order for t in texts[k][1]), np.int64, int(lengths.sum()))
    both, tf = np.unique(term * max(len(order), 1) + doc, return_counts=True)
    term, doc = np.divmod(both, max(len(order), 1))
    edges = np.flatnonzero(np.diff(term, prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        shard.add(int(term[a]), doc[a:b], tf[a:b])
    return shard


# --- search --------------------------------------------------------------------


class Searcher:
    """Searches one shard; blocks that were unpacked once are kept while it is searched."""

    def __init__(self, shard: Shard) -> None:
        self.shard, self.unpacked = shard, {}
        self.last_docs = np.array(shard.last_docs, np.int64)
        self.block_tops = np.array(shard.block_tops, np.int64)

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        if number not in self.unpacked:
            docs, tfs = unpack(self.shard.blocks[number])
            self.unpacked[number] = docs, impacts(tfs, self.shard.m[docs])
        return self.unpacked[number]

    def _blocks(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(number) for number in numbers]
        return tuple(np.concatenate([part[k] for part in parts] or [_NONE]) for k in (0, 1))

    def search(self, query: list[tuple[int, int]], best: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best of a query of (term, weight), and their scores:
        all of the `best` highest above 0 that reach `bar`, and maybe others."""
        shard = self.shard
        lists = [(w * shard.tops[k], w, k) for term, w in query if w and (k := shard.lists.get(term)) is not None]
        lists.sort()
        bounds = np.cumsum([0] + [top for top, _, _ in lists])
        # The longest run of the lowest lists that together stay below the bar.
        essential = max(int(np.searchsorted(bounds, max(bar, 1), "left")) - 1, 0)
        docs, scores = _NONE, _NONE
        for _, w, k in lists[essential:]:
            found, worth = self._blocks(range(shard.first_blocks[k], shard.first_blocks[k + 1]))
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, w * worth])
        docs, place = np.unique(docs, return_inverse=True)
        scores = _sums(place, scores, len(docs))
        for k in range(essential - 1, -1, -1):
            bar = max(bar, _bar(scores, best))
            open_ = scores + bounds[k + 1] >= bar
            docs, scores = docs[open_], scores[open_]
            if not len(docs):
                break
            self._ask(lists[k], docs, scores, bounds[k], bar)
        return docs, scores

    def _ask(self, asked: tuple[int, int, int], docs: np.ndarray, scores: np.ndarray, rest: int, bar: int) -> None:
        """Adds what a list that is not essential gives to the candidates that can still reach
        the bar by the maximum of their block; the scores of the others stay below it."""
        _, w, k = asked
        first, last = self.shard.first_blocks[k], self.shard.first_blocks[k + 1]
        at = first + np.searchsorted(self.last_docs[first:last], docs, "left")
        inside = np.flatnonzero(at < last)
        inside = inside[scores[inside] + w * self.block_tops[at[inside]] + rest >= bar]
        if not len(inside):
            return
        found, worth = self._blocks(np.unique(at[inside]).tolist())
        place = np.searchsorted(found, docs[inside])
        place[place == len(found)] = 0
        here = found[place] == docs[inside]
        scores[inside[here]] += w * worth[place[here]]


def _sums(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(size, np.int64)
    np.add.at(total, place, values)
    return total


def _bar(scores: np.ndarray, best: int) -> int:
    """The score that the best of these reach at least, 1 if they are fewer than asked for."""
    return max(int(np.partition(scores, -best)[-best]), 1) if len(scores) >= best else 1


class Heap:
    """The best documents of a query so far."""

    def __init__(self, best: int) -> None:
        self.best, self.rows, self.bar = best, [], 1

    def add(self, doc_ids: list[int | None], scores: list[int]) -> None:
        rows = [
            (-score, doc_id is None, doc_id or 0)
            for doc_id, score in zip(doc_ids, scores, strict=True)
            if score >= self.bar
        ]
        self.rows = sorted(self.rows + rows)[: self.best]
        if len(self.rows) == self.best:
            self.bar = -self.rows[-1][0]


# --- jobs ------------------------------------------------------------------------


def _load(file: str):
    system, path = open_folder(file)
    with system.open_input_stream(path) as stream:
        return pickle.loads(stream.read())


def query_blocks(queries: DataFrame, block_terms: int = QUERY_TERMS) -> list[str]:
    """Files of the queries in blocks of about `block_terms` terms, in the shared folder: the
    numbers of a block's different terms, and each query's id, its text's hash and terms.

    Equal queries (id and text) are one; those without a term have no result and are left out."""
    spark = queries.sparkSession
    asked = written(queries.select("item_id", "text").distinct(), "queries")
    size = term_count(F.col("text"))
    blocks = (asked.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] + block_terms - 1) // block_terms
    folder = shared_folder(spark, "query-blocks")

    def prepare(rows: pd.DataFrame) -> pd.DataFrame:
        numbers: dict[str, int] = {}
        found = []
        for key, text in zip(rows["key"], rows["text"], strict=True):
            different = sorted(set(terms_of(text)))
            found.append((int(key), [numbers.setdefault(term, len(numbers)) for term in different]))
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        name, temporary = f"{rows['block'].iloc[0]}", f"{root}/.{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as stream:
            stream.write(pickle.dumps((numbers, found), protocol=5))
        system.move(temporary, f"{root}/{name}")  # a task tried again leaves one whole file
        return pd.DataFrame({"file": [f"{folder}/{name}"]})

    if not blocks:
        return []
    key = F.xxhash64("item_id", "text")
    dealt = asked.filter(size > 0).select("text", key.alias("key"), F.pmod(key, F.lit(blocks)).alias("block"))
    return sorted(r["file"] for r in dealt.groupBy("block").applyInPandas(prepare, "file string").collect())


def build_index(
    docs: DataFrame, queries: str, n_docs: int, n_terms: int, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The index of all documents for the terms of a block of queries, as a written table:
    shard, terms, counts (documents that hold a term) and the packed shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _load(queries)[0].get
        texts, sizes, size, number = [], [], 0, 0

        def row() -> pa.RecordBatch:
            shard = index_shard(texts, np.array(sizes, np.int64), n_docs, n_terms)
            return pa.RecordBatch.from_pylist([shard.row(number)], schema=kind)

        for batch in by_bytes(batches, "text", 2 << 20):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                terms = terms_of(text)
                sizes.append(len(terms))
                texts.append((doc_id, [t for t in map(look, terms) if t is not None]))
            size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if size >= shard_bytes:
                yield row()
                texts, sizes, size, number = [], [], 0, number + 1
        if texts:
            yield row()

    schema = "shard int, terms array<int>, counts array<long>, data binary"
    kind = pa.schema(
        [("shard", pa.int32()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("data", pa.binary())]
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(ids.mapInArrow(build, schema), "search-index")


def term_weights(index: DataFrame, n_docs: int) -> str:
    """A folder with a table of the asked terms' weights, from the documents that hold each."""
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("e")).groupBy("e.terms").agg(F.sum("e.counts").alias("df"))
    weight = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.col("df") + 1)))
    path = shared_folder(index.sparkSession, "term-weights")
    held.select(F.col("terms").alias("term"), weight.alias("weight")).coalesce(1).write.parquet(path)
    return path


def _read_weights(folder: str) -> dict[int, int]:
    import pyarrow.dataset as ds

    system, path = open_folder(folder)
    found = ds.dataset(path, filesystem=system, format="parquet").to_table(["term", "weight"])
    return dict(zip(found["term"].to_pylist(), found["weight"].to_pylist(), strict=True))


def search_index(index: DataFrame, queries: str, weights: str, best: int = BEST) -> DataFrame:
    """key, doc_id, score: the best documents of each query in the shards of each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, worth = _load(queries)[1], _read_weights(weights)
        heaps = {key: Heap(best) for key, _ in asked}
        for batch in batches:
            for data in batch.column("data"):
                searcher = Searcher(pickle.loads(data.as_buffer()))
                for key, terms in asked:
                    heap = heaps[key]
                    query = [(term, worth[term]) for term in terms if term in worth]
                    docs, scores = searcher.search(query, best, heap.bar)
                    if len(docs):
                        heap.add([searcher.shard.doc_ids[d] for d in docs.tolist()], scores.tolist())
        rows = [(key, None if null else doc, -score) for key, heap in heaps.items() for score, null, doc in heap.rows]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        for start in range(0, len(rows), 100_000):
            yield pa.record_batch(
                [pa.array(column[start : start + 100_000], pa.int64()) for column in columns], ["key", "doc_id", "score"]
            )

    return index.select("data").mapInArrow(search, "key long, doc_id long, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    best: int = BEST,
    shard_bytes: int = SHARD_BYTES,
    block_terms: int = QUERY_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each query, scores above 0.

    docs: doc_id, text; queries: item_id, text. Of equal scores the smaller doc_id is first,
    null last; repeated documents count by themselves, repeated queries are one, and queries of
    one id with different texts are ranked by themselves. Null texts have no terms. All
    documents are indexed, for the terms that queries ask for; queries come in blocks of bounded
    size, each with an index of its own.
    """
    spark = docs.sparkSession
    n = term_count(F.col("text"))
    size = docs.agg(F.count_if(n > 0).alias("docs"), F.coalesce(F.sum(n), F.lit(0)).alias("terms")).first()
    parts = spark.createDataFrame([], "key long, doc_id long, score long")
    for block in query_blocks(queries, block_terms):
        index = build_index(docs, block, size["docs"], size["terms"], shard_bytes)
        weights = term_weights(index, size["docs"])
        parts = parts.unionByName(search_index(index, block, weights, best))
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    names = queries.select("item_id", F.xxhash64("item_id", "text").alias("key")).distinct()
    return names.join(ranked, "key").select("item_id", "rank", "doc_id", "score")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
postings AS (SELECT doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM docs) GROUP BY ALL),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, size GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), size GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0) WHERE rank <= 50
"""
