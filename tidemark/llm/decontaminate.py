"""Benchmark decontamination by suffix arrays over the words of the training documents.

Documents are cut into shards that fit a task. In each shard the word suffixes that could
start a match (their first words follow each other in some benchmark item) are sorted; every
different window of the benchmark is then searched in the sorted order, all at once. The range
that starts with a window's words gives all its verbatim occurrences, which mark words by the
differences of ranges. Occurrences that cannot be extended to the left are extended word by
word to the right, for the items that hold the window there; that gives the longest match of
every text and item that share a window. Shorter matches have neighbours in the order: those of
each benchmark suffix among the texts', and of each text's suffixes among the benchmark's.

Benchmarks are cut into blocks of bounded size, prepared by a job each as a file in the shared
folder; a task searches its shards for one block after the other, and documents are read once.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, open_folder, shared_folder, table, written

WINDOW = 10
#: Bytes of text in a shard, words of benchmark items in a block, pairs of an occurrence and an
#: item extended at a time, matches in a batch that leaves a task.
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 500_000
PAIRS = 1 << 20
BATCH_MATCHES = 100_000

_WORDS = 500_000

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and other non-ASCII characters, with A-Z lower-cased."""
    return _WORDS.findall(text.encode().lower().decode()) if text else []  # bytes: ASCII only


def _keys(numbers: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The `width` word numbers from each start on, as byte strings that sort like them."""
    columns = numbers[starts[:, None] + np.arange(width)].astype(">u4")
    return np.ascontiguousarray(columns).view(f"S{4 * width}").ravel()


def _shared(
    numbers: np.ndarray, places: np.ndarray, others: np.ndarray, suffixes: np.ndarray
) -> np.ndarray:
    """How many words follow alike from each place of `numbers` and suffix of `others` on."""
    length, alive = np.zeros(len(places), np.int64), np.arange(len(places))
    while len(alive):
        one = numbers[np.minimum(places[alive] + length[alive], len(numbers) - 1)]
        other = others[np.minimum(suffixes[alive] + length[alive], len(others) - 1)]
        alive = alive[(one == other) & (other > 0)]
        length[alive] += 1
    return length


class Benchmark:
    """The items of a block as one row of word numbers, 0 after each, and its suffixes.

    Words are numbered from 1 within the block; a word that no item has gets no number and
    ends every match.
    """

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW) -> None:
        self.window = window
        self.item_ids = [item for item, words in items if words]
        lists = [words for _, words in items if words]
        self.vocabulary: dict[str, int] = {}
        for words in lists:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        numbers, owner, left = [], [], []
        for item, words in enumerate(lists):
            numbers += [self.vocabulary[word] for word in words] + [0]
            owner += [item] * len(words) + [-1]
            left += [*range(len(words), 0, -1), 0]
        self.numbers = np.array(numbers + [0] * window, np.int64)
        owner, left = np.array(owner, np.int64), np.array(left, np.int64)
        sizes = np.array([len(words) for words in lists], np.int64)
        self.suffixes = np.flatnonzero(owner >= 0)
        self.owner, self.left = owner[self.suffixes], left[self.suffixes]
        #: Words that must match: a whole window, or a whole item that is shorter than one.
        self.need = np.where(
            self.left >= window,
            window,
            np.where((self.left == sizes[self.owner]) if len(lists) else False, self.left, 0),
        )
        self.keys = _keys(self.numbers, self.suffixes, window)
        self.order = np.argsort(self.keys, kind="stable")
        self._number_windows()
        # Starts of matches: pairs of words that follow each other in an item, and items of
        # one word.
        first, second = self.numbers[self.suffixes], self.numbers[self.suffixes + 1]
        self.base = len(self.vocabulary) + 1
        self.pairs = np.unique(first[second > 0] * self.base + second[second > 0])
        single = np.zeros(self.base, bool)
        single[first[(self.need == 1)]] = True
        self.single = single

    def _number_windows(self) -> None:
        """The different windows, and for each the classes of suffixes that start with it: a
        class has one word before them (0: none)."""
        asked = np.flatnonzero(self.need)
        need = self.need[asked]
        words = self.numbers[self.suffixes[asked][:, None] + np.arange(self.window)].astype(">u4")
        beyond = np.arange(self.window) >= need[:, None]
        words[beyond] = 0
        low = np.ascontiguousarray(words).view(f"S{4 * self.window}").ravel()
        words = words.copy()
        words[beyond] = 0xFFFFFFFF
        high = np.ascontiguousarray(words).view(f"S{4 * self.window}").ravel()
        _, first, window = np.unique(low, return_index=True, return_inverse=True)
        self.low, self.high, self.width = low[first], high[first], need[first]
        before = self.numbers[self.suffixes[asked] - 1]  # the last number is a 0
        order = np.lexsort((asked, before, window))
        window, before, self.class_suffixes = window[order], before[order], asked[order]
        starts = np.flatnonzero(np.diff(window * self.numbers.max(initial=0) + window + before, prepend=-1))
        self.class_before, self.class_starts = before[starts], np.append(starts, len(order))
        self.window_classes = np.searchsorted(window[starts], np.arange(len(self.low) + 1))


class Shard:
    """Word numbers of the texts of a batch, and what they hold of one block."""

    def __init__(self, texts: list[list[str]], bench: Benchmark) -> None:
        self.bench = bench
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes + 1)  # a 0 after each text, so that no match crosses texts
        self.starts = self.ends - 1 - sizes
        look = bench.vocabulary.get
        self.numbers = np.zeros(int(self.ends[-1] if len(self.ends) else 0) + bench.window, np.int64)
        for start, words in zip(self.starts.tolist(), texts, strict=True):
            self.numbers[start : start + len(words)] = [look(word, 0) for word in words]
        # The suffixes to sort.
        first, second = self.numbers[:-1], self.numbers[1:]
        self.known = np.flatnonzero(first)
        paired = first[self.known] * bench.base + second[self.known]
        place = np.searchsorted(bench.pairs, paired)
        place[place == len(bench.pairs)] = 0
        self.unsorted = self.known[
            (bench.pairs[place] == paired if len(bench.pairs) else False) | bench.single[first[self.known]]
        ]
        keys = _keys(self.numbers, self.unsorted, bench.window)
        order = np.argsort(keys, kind="stable")
        self.suffixes, self.keys = self.unsorted[order], keys[order]
        # All occurrences of the windows: the range of suffixes that start with one.
        self.lower = np.searchsorted(self.keys, bench.low, "left")
        self.upper = np.searchsorted(self.keys, bench.high, "right")

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def hit(self) -> np.ndarray:
        """Places of words inside an occurrence of a window, ascending."""
        edges = np.zeros(len(self.numbers) + 1, np.int64)
        windows = np.flatnonzero(self.upper > self.lower)
        counts = (self.upper - self.lower)[windows]
        places = self.suffixes[_ranges(self.lower[windows], counts)]
        np.add.at(edges, places, 1)
        np.add.at(edges, places + np.repeat(self.bench.width[windows], counts), -1)
        return np.flatnonzero(np.cumsum(edges[:-1]) > 0)

    def window_matches(self) -> pd.DataFrame:
        """The longest match of each text and item that share a window: text, item, longest, at."""
        bench, found = self.bench, []
        windows = np.flatnonzero(self.upper > self.lower)
        counts = (self.upper - self.lower)[windows]
        places = self.suffixes[_ranges(self.lower[windows], counts)]
        window = np.repeat(windows, counts)
        # Occurrences that go on to the left lie inside others: only classes with another word
        # before them are looked at, or with none.
        classes = bench.window_classes[window + 1] - bench.window_classes[window]
        for some in _slices(classes, PAIRS):
            at = np.repeat(places[some], classes[some])
            kind = _ranges(bench.window_classes[window[some]], classes[some])
            before = self.numbers[at - 1]  # the last number is a 0
            open_ = (before == 0) | (before != bench.class_before[kind])
            at, kind = at[open_], kind[open_]
            sizes = bench.class_starts[kind + 1] - bench.class_starts[kind]
            for few in _slices(sizes, PAIRS):
                place = np.repeat(at[few], sizes[few])
                suffix = bench.class_suffixes[_ranges(bench.class_starts[kind[few]], sizes[few])]
                length = _shared(self.numbers, place, bench.numbers, bench.suffixes[suffix])
                found.append(_longest(self.text_of(place), bench.owner[suffix], length, place))
                if len(found) > 16:
                    found = [_merged(found)]
        return _merged(found)

    def other_matches(self, settled: np.ndarray) -> pd.DataFrame:
        """Shorter matches: the longest of each item with any text, and of each text that is not
        `settled` with any item."""
        bench = self.bench
        # The neighbours of each benchmark suffix's place share most with it.
        at = np.searchsorted(self.keys, bench.keys, "left")
        best_length = np.zeros(len(bench.suffixes), np.int64)
        best_place = np.zeros(len(bench.suffixes), np.int64)
        for side in (at - 1, at):
            valid = np.flatnonzero((side >= 0) & (side < len(self.keys)))
            place = self.suffixes[side[valid]]
            length = _shared(self.numbers, place, bench.numbers, bench.suffixes[valid])
            better = length > best_length[valid]
            best_length[valid[better]], best_place[valid[better]] = length[better], place[better]
        matched = np.flatnonzero(best_length)
        of_items = _longest(
            self.text_of(best_place[matched]), bench.owner[matched], best_length[matched], best_place[matched]
        )
        # A known word by itself, then what follows alike from the suffixes that start with two.
        text = self.text_of(self.known)
        places = np.concatenate([self.known[np.flatnonzero(np.diff(text, prepend=-1))], self.unsorted])
        text = self.text_of(places)
        places, text = places[~settled[text]], text[~settled[text]]
        at = np.searchsorted(bench.keys[bench.order], _keys(self.numbers, places, bench.window), "left")
        longest, suffix = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        for side in (at - 1, at):
            valid = np.flatnonzero((side >= 0) & (side < len(bench.order)))
            theirs = bench.suffixes[bench.order[side[valid]]]
            length = _shared(self.numbers, places[valid], bench.numbers, theirs)
            better = length > longest[valid]
            longest[valid[better]] = length[better]
            suffix[valid[better]] = bench.order[side[valid[better]]]
        best = np.lexsort((places, -longest, text))
        best = best[np.flatnonzero(np.diff(text[best], prepend=-1))]
        of_texts = _longest(text[best], bench.owner[suffix[best]], longest[best], places[best])
        return _merged([of_items, of_texts])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges that begin at `starts`, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices that have about `most` in sum each, one entry at least."""
    part = (np.cumsum(sizes) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    yield from (slice(a, b) for a, b in zip(edges, edges[1:]) if a < b)


def _longest(text: np.ndarray, item: np.ndarray, longest: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """One row of each text and item: its longest match, the first of several."""
    order = np.lexsort((at, -longest, item, text))
    text, item, longest, at = (column[order] for column in (text, item, longest, at))
    first = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
    return pd.DataFrame({"text": text[first], "item": item[first], "longest": longest[first], "at": at[first]})


def _merged(found: list[pd.DataFrame]) -> pd.DataFrame:
    none = np.zeros(0, np.int64)
    both = pd.concat([_longest(none, none, none, none), *found])
    return _longest(*(both[column].to_numpy(np.int64) for column in ("text", "item", "longest", "at")))


def search_shard(texts: list[list[str]], bench: Benchmark) -> tuple[Shard, np.ndarray, pd.DataFrame]:
    """What a shard holds of a block of the benchmark.

    Returns the shard, the places of its words that are hit, and a frame of text, item,
    longest (words of a verbatim match of the two), at (place of its first word), occurs (a window
    of the item occurs in the text). Where one occurs, `longest` is that of the longest match of
    the text and the item. Of the others the frame has at least the longest match of each text
    with any item, and of each item with any text of the shard unless that is a single word.
    """
    shard = Shard(texts, bench)
    occurring = shard.window_matches()
    settled = np.zeros(len(texts), bool)
    settled[occurring.loc[occurring["longest"] >= bench.window, "text"].to_numpy(np.int64)] = True
    others = shard.other_matches(settled)
    told = pd.MultiIndex.from_frame(occurring[["text", "item"]])
    others = others[~pd.MultiIndex.from_frame(others[["text", "item"]]).isin(told)]
    both = pd.concat([occurring.assign(occurs=True), others.assign(occurs=False)])
    return shard, shard.hit(), both.sort_values(["text", "item"])


def benchmark_blocks(
    benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> list[str]:
    """Files of the prepared blocks of a benchmark, one path per block, in the shared folder.

    Different items are dealt to blocks by hash, so that a block has about `block_words` words;
    items that are equal in id and text are one. Each block is prepared in a task of its own.
    """
    spark = benchmark.sparkSession
    items = written(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct(),
        "benchmark",
    )
    words = F.regexp_count("text", F.lit(WORD)).cast("long")
    blocks = (items.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0] + block_words - 1) // block_words
    folder = shared_folder(spark, "benchmark-blocks")

    def prepare(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["item_id", "text"], na_position="last")
        rows = zip(block["item_id"], block["text"], strict=True)
        named = [(None if pd.isna(item) else item, words_of(text)) for item, text in rows]
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        name, temporary = f"{root}/{block['block'].iloc[0]}", f"{root}/.{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as stream:
            stream.write(pickle.dumps(Benchmark(named, window), protocol=5))
        system.move(temporary, name)  # a task tried again leaves one whole file
        return pd.DataFrame({"file": [f"{folder}/{block['block'].iloc[0]}"]})

    if not blocks:
        return []
    dealt = items.filter(words > 0).withColumn("block", F.expr(f"pmod(xxhash64(item_id, text), {blocks})"))
    return sorted(r["file"] for r in dealt.groupBy("block").applyInPandas(prepare, "file string").collect())


class _Blocks:
    """The prepared blocks of a task, one of them in memory."""

    def __init__(self, files: list[str]) -> None:
        self.files, self.at, self.last = files, None, None

    def __iter__(self) -> Iterator[Benchmark]:
        for file in self.files:
            if self.at != file:
                system, path = open_folder(file)
                with system.open_input_stream(path) as stream:
                    self.at, self.last = file, pickle.loads(stream.read())
            yield self.last


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    block_words: int = BLOCK_WORDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Each row of docs as `row`, with n_words, hits and matches.

    hits: numbers of the words inside any occurrence of an item's window, ascending.
    matches: item, longest (words of a verbatim match), the word it starts at, and whether one of
    the item's windows occurs in the document. For an item that occurs it is the longest match
    of the two, and the longest of all is that of the document with any item, however documents
    are batched; which shorter ones are told beside them is not fixed. Null texts and texts without
    words have no hits; items without words have no windows; repeated items and repeated
    documents each count by themselves, and item ids are compared as strings. The columns
    of docs, or those of `carry`, ride along in `row`, whatever their names. A task's memory is
    bounded by its shard, the block in memory and the matches of one text, however many items
    share a passage and however often a text repeats it.
    """
    files = benchmark_blocks(benchmark, window, block_words)
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"), F.col("text").alias("text")
    )
    schema = found.select(
        "row",
        F.expr("0L").alias("n_words"),
        F.expr("cast(array() as array<bigint>)").alias("hits"),
        F.expr(
            "cast(array() as array<struct<item_id:string,longest:bigint,at:bigint,occurs:boolean>>)"
        ).alias("matches"),
    ).schema

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(files)
        for batch in by_bytes(batches, "text", shard_bytes):
            texts = [words_of(text) for text in batch.column("text").to_pylist()]
            hits, matches = [np.zeros(0, np.int64)], []
            starts = np.cumsum([0] + [len(words) + 1 for words in texts])[:-1]
            for bench in blocks:
                shard, hit, rows = search_shard(texts, bench)
                hits, starts = [np.union1d(hits[0], hit)], shard.starts
                names = pa.array(bench.item_ids, pa.string()).take(pa.array(rows["item"].to_numpy(np.int64)))
                matches.append((rows, names))
            yield from _told(batch.column("row"), texts, starts, hits[0], matches)

    return found.mapInArrow(search, schema)


def _told(
    row: pa.Array,
    texts: list[list[str]],
    starts: np.ndarray,
    hits: np.ndarray,
    matches: list[tuple[pd.DataFrame, pa.Array]],
) -> Iterator[pa.RecordBatch]:
    """Output rows of a shard, in batches of a bounded number of matches."""
    owner = np.searchsorted(starts, hits, "right") - 1
    hit_ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    within = hits - starts[owner]
    rows = pd.concat([r for r, _ in matches]) if matches else _merged([]).assign(occurs=False)
    names = pa.concat_arrays([pa.array([], pa.string()), *(n for _, n in matches)])
    text = rows["text"].to_numpy(np.int64)
    order = np.argsort(text, kind="stable")
    match_ends = np.searchsorted(text[order], np.arange(len(texts) + 1))
    for part in _slices(np.diff(match_ends) + 1, BATCH_MATCHES):
        some = order[match_ends[part.start] : match_ends[part.stop]]
        columns = [names.take(pa.array(some))]
        columns += [
            pa.array(rows["longest"].to_numpy(np.int64)[some]),
            pa.array(rows["at"].to_numpy(np.int64)[some] - starts[text[some]]),
            pa.array(rows["occurs"].to_numpy(bool)[some]),
        ]
        told = pa.StructArray.from_arrays(columns, ["item_id", "longest", "at", "occurs"])
        edges = match_ends[part.start : part.stop + 1] - match_ends[part.start]
        hit_edges = hit_ends[part.start : part.stop + 1]
        yield pa.record_batch(
            [
                row.slice(part.start, part.stop - part.start),
                pa.array([len(words) for words in texts[part]], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(hit_edges - hit_edges[0], pa.int32()), pa.array(within[hit_edges[0] : hit_edges[-1]])
                ),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), told),
            ],
            ["row", "n_words", "hits", "matches"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and longest per document."""
    found = find_matches(docs, benchmark, carry=["doc_id"], **options)
    items = F.array_sort(
        F.array_distinct(F.transform(F.filter("matches", lambda m: m["occurs"]), lambda m: m["item_id"]))
    )
    # Items without an id have windows like any other and sort last, as an empty string.
    named = F.transform(items, lambda i: F.coalesce(i, F.lit("")))
    return found.select(
        "row.doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["longest"])), F.lit(0)).alias("longest"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs, with all their columns.

    The same search as `find_matches`; matches are not extended, as one hit decides."""
    files = benchmark_blocks(benchmark, window, block_words)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(files)
        for batch in by_bytes(batches, "text", shard_bytes):
            texts = [words_of(text) for text in batch.column("text").to_pylist()]
            clean = np.ones(len(texts), bool)
            for bench in blocks:
                shard = Shard(texts, bench)
                clean[shard.text_of(shard.hit())] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("longest")


OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
found AS (SELECT p.r, p.i, p.size, v.item_id FROM places p JOIN windows v USING (size, words)),
hits AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
