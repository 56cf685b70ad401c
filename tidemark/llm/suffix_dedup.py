"""Removal of repeated byte strings, over all documents.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier. To bring equal
strings together without shuffling every suffix, each string elects an anchor: the place of
the least hash of `GRAM` bytes in it. Equal strings elect equal anchors, so only anchors
whose hash occurs twice can matter, and every repeat shows in the passage around an anchor:
the bytes that a string over it may reach. Equal passages are reduced to one, with the place
of the first and their number.

Passages around equal grams form a group. In a group, what follows the gram and, backwards,
what precedes it are sorted by a suffix array (built by groups of Lyndon prefixes, see
`suffix_sort`, over blocks of bytes); the common prefixes of neighbours in both orders
tell for every string over the gram which passages share it, and so where it starts first.
A group of more than `HOT_GROUP` different passages is not gathered in a task: its strings
are grouped by Spark, which reduces them before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, free_shuffles, table, written
from tidemark.llm.suffix_sort import suffix_array

LENGTH = 100
GRAM = 32
#: Different passages around one gram that a task sorts, and passages sorted at a time.
HOT_GROUP = 20_000
#: Passages that a task remembers while it cuts them.
HELD_PASSAGES = 100_000
#: Blocks into which what follows or precedes a gram is cut, to be sorted.
BLOCKS = 3
SORTED_PASSAGES = 4000
BATCH_BYTES = 2 << 20
_NULL_KEY = -(2**63)
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 2**32, 256, dtype=np.uint32)

DOC = "doc_key long, doc_hash long"


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes, never 0, of all runs of `gram` bytes (a power of two), by doubling."""
    hashes = _BYTE[data]
    width, factor = 1, 0x9E3779B1
    while width < gram:
        if len(hashes) <= width:
            return np.zeros(0, np.uint32)
        hashes = hashes[:-width] * np.uint32(factor) + hashes[width:]
        factor = factor * factor % 2**32
        width *= 2
    hashes ^= hashes >> np.uint32(16)
    hashes *= np.uint32(0x85EBCA6B)
    hashes ^= hashes >> np.uint32(13)
    return np.maximum(hashes, np.uint32(1))


def gram_names(data: np.ndarray, places: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of the runs of `gram` bytes at some places."""
    names = np.zeros(len(places), np.uint64)
    for at in range(0, gram, 8):
        rows = data[places[:, None] + np.arange(at, at + 8)]
        names = (names ^ np.ascontiguousarray(rows).view(np.uint64).ravel()) * np.uint64(0x9E3779B97F4A7C15)
        names ^= names >> np.uint64(32)
        names *= np.uint64(0xBF58476D1CE4E5B9)
        names ^= names >> np.uint64(29)
    return names


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Least (or greatest) of each run of `width` values."""
    done, result = 1, values
    while done * 2 <= width:
        result = least(result[:-done], result[done:])
        done *= 2
    if done < width:
        result = least(result[: len(result) - (width - done)], result[width - done :])
    return result


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Places of the anchors in documents laid end to end, and names of the grams there."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    width = length - gram + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(data, gram)
    least = _sliding(hashes, width, np.minimum)  # one for each string of `length` bytes
    inside = np.zeros(len(least) + 1, np.int64)
    long_enough = ends - starts >= length
    np.add.at(inside, starts[long_enough], 1)
    np.add.at(inside, np.minimum(ends[long_enough] - length + 1, len(least)), -1)
    least = np.where(np.cumsum(inside[:-1]) > 0, least, np.uint32(0))  # none crosses documents
    pad = np.zeros(width - 1, np.uint32)
    reach = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    places = np.flatnonzero((hashes == reach) & (reach > 0))
    return places, gram_names(data, places, gram)


def _laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return [value.as_buffer().to_pybytes() for value in batch.column("text")]


def _documents(docs: DataFrame) -> DataFrame:
    """doc_key and doc_hash tell and order documents; `doc`, their hash, finds one again.
    Two documents of one `doc` share their lists of places, which costs a look."""
    texts = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_KEY)).alias("doc_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("doc_hash", F.xxhash64("text"))
    return texts.withColumn("doc", F.xxhash64("doc_key", "doc_hash"))


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc and place of the rows whose gram the row before or after has too; rows are
    sorted by gram. Holds one batch and one row, however often a gram occurs."""
    last: tuple[int, int, int] | None = None
    told = True
    for batch in batches:
        if not batch.num_rows:
            continue
        gram = batch.column("gram").to_numpy()
        doc, place = batch.column("doc").to_numpy(), batch.column("place").to_numpy()
        if last is not None:
            gram = np.concatenate([[last[0]], gram])
            doc, place = np.concatenate([[last[1]], doc]), np.concatenate([[last[2]], place])
        same = gram[1:] == gram[:-1]
        twice = np.zeros(len(gram), bool)
        twice[1:] |= same
        twice[:-1] |= same
        last = (int(gram[-1]), int(doc[-1]), int(place[-1]))
        known = bool(twice[-1])
        if len(twice) > len(batch):
            twice[0] &= not told
        told = known
        yield pa.record_batch(
            [pa.array(doc[twice], pa.int64()), pa.array(place[twice], pa.int32())], ["doc", "place"]
        )


def _shared_places(texts: DataFrame, length: int) -> DataFrame:
    """doc, places: the anchors whose gram occurs twice, in documents that have any.

    One shuffle of 20 bytes an anchor; of a hot gram every document sends its anchors,
    a small part of all that it has.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            data, ends = _laid(_bytes_of(batch))
            places, hashes = anchors(data, ends, length)
            doc = np.searchsorted(ends, places, "right")
            start = np.concatenate([[0], ends])[doc]
            yield pa.record_batch(
                [
                    batch.column("doc").take(pa.array(doc)),
                    pa.array((places - start).astype(np.int32)),
                    pa.array(hashes.view(np.int64)),
                ],
                ["doc", "place", "gram"],
            )

    rows = texts.select("doc", "text").mapInArrow(find, "doc long, place int, gram long")
    spread = rows.repartition("gram").sortWithinPartitions("gram")
    found = spread.mapInArrow(_twice, "doc long, place int")
    return found.groupBy("doc").agg(F.collect_set("place").alias("places"))


PASSAGE = (
    "id binary, left int, right int, passage binary, n long, "
    "first_key long, first_hash long, first_place int"
)


def _passage_rows(texts: DataFrame, length: int) -> DataFrame:
    """Rows of two kinds: for each anchor doc, place and passage id; and for each passage
    that a task meets (again after every `HELD_PASSAGES`) the passage, how many anchors
    have it and the first of them.

    A passage is `length - GRAM` bytes, the gram, and as many bytes, filled up with zeros
    beyond the document; its id also hashes how many bytes of both sides are filled.
    """
    side = length - GRAM
    size = GRAM + 2 * side

    names = ["doc_key", "doc_hash", "place", *(c.split()[0] for c in PASSAGE.split(", "))]
    kinds = [
        *(pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()),
        *(pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()),
    ]

    def rows(*columns) -> pa.RecordBatch:
        """The columns given, by name; nulls in the others."""
        size, given = len(columns[0][1]), dict(columns)
        return pa.record_batch(
            [
                given[name] if isinstance(given.get(name), pa.Array) else pa.array(given.get(name, [None] * size), kind)
                for name, kind in zip(names, kinds, strict=True)
            ],
            names,
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}  # id: left, right, passage, n, first

        def passages() -> pa.RecordBatch:
            left, right, passage, n, first = zip(*seen.values(), strict=True)
            first_key, first_hash, first_place = zip(*first, strict=True)
            columns = (list(seen), left, right, passage, n, first_key, first_hash, first_place)
            return rows(*zip(names[3:], columns, strict=True))

        for batch in by_bytes(batches, "text", BATCH_BYTES):
            keys, hashes = (batch.column(c).to_pylist() for c in ("doc_key", "doc_hash"))
            docs, places, ids = [], [], []
            found = zip(_bytes_of(batch), batch.column("places").to_pylist(), keys, hashes, strict=True)
            for number, (text, listed, key, hashed) in enumerate(found):
                at = np.sort(np.array(listed, np.int64))
                at = at[at <= len(text) - GRAM]
                padded = np.zeros(len(text) + 2 * side, np.uint8)
                padded[side : side + len(text)] = np.frombuffer(text, np.uint8)
                left = np.minimum(at, side).tolist()
                right = np.minimum(len(text) - GRAM - at, side).tolist()
                at = at.tolist()
                for low in range(0, len(at), 4096):
                    data = padded[np.array(at[low : low + 4096])[:, None] + np.arange(size)].tobytes()
                    for k in range(low, min(low + 4096, len(at))):
                        passage = data[(k - low) * size : (k - low + 1) * size]
                        name = xxhash.xxh128_digest(passage + bytes((left[k], right[k])))
                        held = seen.get(name)
                        if held is None:
                            seen[name] = [left[k], right[k], passage, 1, (key, hashed, at[k])]
                        else:
                            held[3] += 1
                            held[4] = min(held[4], (key, hashed, at[k]))
                        ids.append(name)
                docs += [number] * len(at)
                places += at
            doc = pa.array(docs, pa.int64())
            yield rows(
                ("doc_key", batch.column("doc_key").take(doc)),
                ("doc_hash", batch.column("doc_hash").take(doc)),
                ("place", places),
                ("id", ids),
            )
            if len(seen) > HELD_PASSAGES:
                yield passages()
                seen.clear()
        if seen:
            yield passages()

    return texts.mapInArrow(cut, f"{DOC}, place int, {PASSAGE}")


def _shared(groups: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows, group by group, by a suffix array over their blocks of bytes,
    and how many bytes each row shares with the one before it there; -1 where a group begins.

    A row is its group's number and `BLOCKS` blocks. Rows are equally long, so that no two
    different rows are compared beyond their ends, and equal rows may come in any order.
    """
    n, size = rows.shape
    block = -(-size // BLOCKS)
    padded = np.zeros((n, BLOCKS * block), np.uint8)
    padded[:, :size] = rows
    _, names = np.unique(padded.view(f"S{block}"), return_inverse=True)
    text = np.empty((n, BLOCKS + 1), np.int64)
    text[:, 0] = groups
    text[:, 1:] = names.reshape(n, BLOCKS) + int(groups.max(initial=0)) + 1
    suffixes = np.array(suffix_array(text.ravel().tolist()), np.int64)
    order = suffixes[suffixes % (BLOCKS + 1) == 0] // (BLOCKS + 1)
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    first[groups[order[1:]] != groups[order[:-1]]] = -1
    return order, np.concatenate([[-1], first])


class _Sides:
    """What follows (or precedes) the gram in each passage, sorted within groups."""

    def __init__(self, groups: np.ndarray, rows: np.ndarray) -> None:
        seen: dict[tuple[int, bytes], int] = {}
        pairs = zip(groups.tolist(), rows, strict=True)
        self.which = np.array(
            [seen.setdefault((group, row.tobytes()), len(seen)) for group, row in pairs], np.int64
        )
        distinct = np.zeros(len(seen), np.int64)
        distinct[self.which] = np.arange(len(rows))
        own = groups[distinct]
        rivals = np.flatnonzero(np.bincount(own)[own] > 1)  # others have nothing to sort against
        self.alone = np.setdiff1d(np.arange(len(seen)), rivals)
        self.kind = np.empty(len(seen), np.int64)
        self.kind[self.alone] = np.arange(len(self.alone)) + len(seen)
        if len(rivals):
            order, self.shared = _shared(own[rivals], rows[distinct[rivals]])
            self.sorted = rivals[order]
        else:
            self.sorted, self.shared = rivals, np.zeros(0, np.int64)

    def equal(self, width: int) -> np.ndarray:
        """A number for each passage, the same for those of a group that share `width` bytes."""
        self.kind[self.sorted] = np.cumsum(self.shared < width)
        return self.kind[self.which]


def judge_strings(
    groups: np.ndarray,
    passages: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
    rank: np.ndarray,
    counts: np.ndarray,
    length: int = LENGTH,
) -> np.ndarray:
    """For each passage and each string over its gram: 0 not repeated, 1 it also starts
    earlier than every place of the passage, 2 than every place but the first.

    `groups` are ascending numbers; `rank` orders the passages by their first place. Column
    k is the string that takes k bytes after the gram.
    """
    side = length - GRAM
    n = len(groups)
    states = np.zeros((n, side + 1), np.uint8)
    after = _Sides(groups, passages[:, side + GRAM :])
    before = _Sides(groups, passages[:, :side][:, ::-1])
    for k in range(side + 1):
        valid = np.flatnonzero((left >= side - k) & (right >= k))
        if not len(valid):
            continue
        pairs = after.equal(k)[valid] * (4 * n + 4) + before.equal(side - k)[valid]
        kinds, kind = np.unique(pairs, return_inverse=True)
        first = np.full(len(kinds), np.iinfo(np.int64).max)
        np.minimum.at(first, kind, rank[valid])
        states[valid, k] = np.where(
            rank[valid] > first[kind], 1, np.where(counts[valid] > 1, 2, 0)
        )
    return states


def _judged(passages: DataFrame, length: int, hot_group: int) -> DataFrame:
    """Passages with their states, group by group; those without a repeated string left
    out, and those of groups larger than `hot_group` with no states yet."""
    side = length - GRAM
    column = np.arange(side + 1)
    names = [c.split()[0] for c in PASSAGE.split(", ")]

    def alone(row: list) -> bytes:
        _, left, right, _, n, _ = row
        return np.where((left >= side - column) & (right >= column) & (n > 1), 2, 0).astype(np.uint8).tobytes()

    def told(rows: list[list], states: list[bytes | None]) -> pa.RecordBatch:
        kept = [(row, state) for row, state in zip(rows, states, strict=True) if state is None or any(state)]
        hot = [state is None for _, state in kept]
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        arrays = [
            pa.array([row[k] if k in (0, 4) or far else None for (row, _), far in zip(kept, hot, strict=True)], kind)
            for k, kind in enumerate(kinds)
        ]
        arrays += [
            pa.array([row[5][k] for row, _ in kept], kind)
            for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))
        ]
        return pa.record_batch([*arrays, pa.array([s for _, s in kept], pa.binary())], [*names, "states"])

    def sort(groups: list[list[list]]) -> pa.RecordBatch:
        rows = [row for group in groups for row in group]
        rank = np.empty(len(rows), np.int64)
        rank[sorted(range(len(rows)), key=lambda k: rows[k][5])] = np.arange(len(rows))
        states = judge_strings(
            np.repeat(np.arange(len(groups)), [len(group) for group in groups]),
            np.frombuffer(b"".join(row[3] for row in rows), np.uint8).reshape(len(rows), -1),
            np.array([row[1] for row in rows]),
            np.array([row[2] for row in rows]),
            rank,
            np.array([row[4] for row in rows]),
            length,
        )
        return told(rows, [state.tobytes() for state in states])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by gram and id; the parts of one id become one passage."""
        held: list[list[list]] = []
        singles: list[list] = []
        group: list[list] = []
        size, gram, hot = 0, None, False

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal held, singles, size
            if hot:
                yield told(group, [None] * len(group))
            elif len(group) == 1:  # nothing to sort it against
                singles.append(group[0])
                if len(singles) >= 10_000:
                    yield told(singles, [alone(row) for row in singles])
                    singles = []
            elif group:
                if held and size + len(group) > SORTED_PASSAGES:
                    yield sort(held)
                    held, size = [], 0
                held.append(group)
                size += len(group)

        for batch in batches:
            values = [batch.column(c).to_pylist() for c in names]
            firsts = list(zip(*values[5:], strict=True))
            for row in map(list, zip(*values[:5], firsts, strict=True)):
                own = row[3][side : side + GRAM]
                if own != gram:
                    yield from closed()
                    group, gram, hot = [], own, False
                if group and group[-1][0] == row[0]:
                    group[-1][4] += row[4]
                    group[-1][5] = min(group[-1][5], row[5])
                    continue
                if len(group) > hot_group:  # too many to sort here: they go on as they are
                    hot = True
                    yield told(group[:-1], [None] * (len(group) - 1))
                    group = group[-1:]
                group.append(row)
        yield from closed()
        if singles:
            yield told(singles, [alone(row) for row in singles])
        if held:
            yield sort(held)

    gram = F.expr(f"substring(passage, {side + 1}, {GRAM})")
    spread = passages.withColumn("gram", gram).repartition("gram").sortWithinPartitions("gram", "id")
    return spread.select(*names).mapInArrow(judge, f"{PASSAGE}, states binary")


def _judged_hot(passages: DataFrame, length: int) -> DataFrame:
    """States of passages of groups too large for a task: strings are grouped by their bytes."""
    side = length - GRAM
    first = F.struct("first_key", "first_hash", "first_place").alias("first")
    strings = (
        passages.select("id", "left", "right", "passage", "n", first)
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(side))))
        .withColumn("valid", (F.col("left") >= side - F.col("k")) & (F.col("right") >= F.col("k")))
    )
    valid = strings.filter("valid").withColumn("string", F.expr(f"substring(passage, k + 1, {length})"))
    best = valid.groupBy("string", "k").agg(F.min("first").alias("best"))
    judged = valid.join(best, ["string", "k"]).select(
        "id",
        "k",
        F.when(F.col("first") > F.col("best"), 1).when(F.col("n") > 1, 2).otherwise(0).alias("state"),
    )
    listed = strings.filter("NOT valid").select("id", "k", F.lit(0).alias("state")).union(judged)
    marks = F.transform(
        F.array_sort(F.collect_list(F.struct("k", "state"))),
        lambda s: F.lpad(F.hex(s["state"]), 2, "0"),
    )
    states = listed.groupBy("id").agg(F.unhex(F.array_join(marks, "")).alias("states"))
    return passages.drop("states").join(states, "id")


def _spans(places: DataFrame, length: int) -> DataFrame:
    """doc, start, end of the repeated bytes around each anchor, as few spans as there are."""
    side = length - GRAM

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            states = np.frombuffer(
                b"".join(batch.column("states").to_pylist()), np.uint8
            ).reshape(batch.num_rows, side + 1)
            later = ~batch.column("is_first").to_numpy(zero_copy_only=False)
            gone = (states == 1) | ((states == 2) & later[:, None])
            edges = np.diff(np.pad(gone.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, first = np.nonzero(edges == 1)
            last = np.nonzero(edges == -1)[1]
            # String k starts `side - k` bytes before the gram.
            base = batch.column("place").to_numpy()[row].astype(np.int64) - side
            pick = pa.array(row)
            yield pa.record_batch(
                [
                    batch.column("doc_key").take(pick),
                    batch.column("doc_hash").take(pick),
                    pa.array(base + first),
                    pa.array(base + last - 1 + length),
                ],
                ["doc_key", "doc_hash", "start", "end"],
            )

    return places.mapInArrow(spans, f"{DOC}, start long, end long")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, hot_group: int = HOT_GROUP
) -> DataFrame:
    """doc_key, doc_hash and spans (start, end) of repeated bytes, for documents that have any.

    doc_key is the id, the least number for null; doc_hash the hash of the text. Documents
    are in the order of both; rows equal in both are one document.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes")
    spark, texts = docs.sparkSession, _documents(docs)
    wanted = (
        texts.select("doc", "doc_key", "doc_hash", "text")
        .join(_shared_places(texts, length), "doc")
        .dropDuplicates(["doc", "doc_key", "doc_hash"])
    )
    around = written(
        _passage_rows(wanted.select("doc_key", "doc_hash", "text", "places"), length), "passages"
    )
    free_shuffles(spark)
    different = around.filter("passage IS NOT NULL").drop("doc_key", "doc_hash", "place")
    told = written(_judged(different, length, hot_group), "string-states")
    hot = told.filter("states IS NULL")
    if hot.take(1):
        told = told.filter("states IS NOT NULL").union(
            _judged_hot(hot, length).select(*told.columns)
        )
        told = written(told, "all-states")
    free_shuffles(spark)
    places = around.filter("passage IS NULL").select("doc_key", "doc_hash", "place", "id")
    hits = places.join(
        told.select("id", "states", "first_key", "first_hash", "first_place"), "id"
    )
    is_first = F.expr(
        "doc_key = first_key AND doc_hash = first_hash AND place = first_place"
    ).alias("is_first")
    spans = _spans(hits.select("doc_key", "doc_hash", "place", "states", is_first), length)
    listed = spans.groupBy("doc_key", "doc_hash").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )
    listed = written(listed, "repeated-spans")
    free_shuffles(spark)
    return listed


def merged(spans: list[tuple[int, int]] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover, in order."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans or []):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def _with_spans(docs: DataFrame, **options) -> DataFrame:
    spans = repeated_spans(docs, **options)
    return _documents(docs).join(spans, ["doc_key", "doc_hash"], "left")


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) for every row.

    Null texts count as empty. Matches never cross documents; null ids come before all
    others; among equal ids the order is that of the texts' hashes, and rows equal in id and
    text are one document that does not repeat itself. `kept` need not be valid UTF-8.
    """

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            texts = _bytes_of(batch)
            runs = [
                merged([(s["start"], s["end"]) for s in spans or []])
                for spans in batch.column("spans").to_pylist()
            ]
            kept = []
            for text, gone in zip(texts, runs, strict=True):
                ends = [0, *(end for _, end in gone)]
                starts = [*(start for start, _ in gone), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends, starts, strict=True)))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(text) for text in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                    pa.array([len(gone) for gone in runs], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        _with_spans(docs, **options)
        .select("doc_id", "text", "spans")
        .mapInArrow(
            remove,
            f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
        )
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
