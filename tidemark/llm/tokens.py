"""Token counts and token ids of whole texts, in Arrow batches.

A text is cut into pieces at places where the tokenizer's own pattern must cut: before a
single blank that has something other than white space on both sides. No token crosses
such a place, so the ids of a text are the ids of its pieces one after the other, however
long the text is; texts beyond a batch are cut there, too. The different pieces of a batch
that a task does not know yet are joined by blanks again and encoded by one call; a piece
starts where a token starts with a blank. What is known is bounded in bytes and ends with
the task. Only byte-level BPE with the usual pattern, no normalizer and no prefix blank is
cut like this; texts for any other tokenizer are encoded whole, a batch in a call.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Bytes of text encoded at a time; bytes of pieces and their ids that a task remembers;
#: characters in each text of a call to the library.
BATCH_BYTES = 4 << 20
REMEMBERED_BYTES = 48 << 20
CALL_BYTES = 64 << 10

_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Texts that are not cut at all their blanks: white space of another kind, blanks at an end,
#: next to one another or to a line feed.
_ODD = (
    r"^ | $|  |\n | \n|[\t\r\x0b\x0c\x1c-\x1f]|"
    r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_MARKS = ".,;:!?"
_MARKED = r"\pL[.,;:!?]$"
_BLANK = "Ġ"  # how byte-level vocabularies write the blank
_TOKENIZERS: dict[str, object] = {}


def pieces_of(texts: pa.Array) -> pa.Array:
    """The texts as lists of pieces, cut at their safe blanks, which are left out."""
    odd = pc.match_substring_regex(texts, _ODD)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    plain = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    cut = pa.array([_SAFE.split(text) for text in texts.filter(odd).to_pylist()], plain.type)
    is_odd = odd.to_numpy(zero_copy_only=False)
    place = np.where(is_odd, len(plain) + np.cumsum(is_odd) - 1, np.cumsum(~is_odd) - 1)
    return pa.concat_arrays([plain, cut]).take(pa.array(place))


def _parts(text: str, most: int) -> Iterator[str]:
    """The text in parts of about `most` characters; each but the first follows a safe blank."""
    start = 0
    while (cut := _SAFE.search(text, start + most)) is not None:
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at `starts`, run after run."""
    ends = np.cumsum(sizes, dtype=np.int64)
    places = np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)
    places += np.arange(len(places), dtype=np.int32)
    return places


class _Memory:
    """Pieces, each with its ids in one array; given up as a whole when it is full."""

    def __init__(self, most_bytes: int) -> None:
        self.most_bytes = most_bytes
        self.clear()

    def clear(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.ids, self.starts, self.sizes = (np.zeros(0, kind) for kind in (np.uint32, np.int32, np.int32))

    @property
    def bytes(self) -> int:
        return self.pieces.nbytes + self.ids.nbytes + self.starts.nbytes + self.sizes.nbytes

    def find(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece, or -1."""
        return pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy()

    def add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.starts = np.concatenate([self.starts, starts.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])


class Encoder:
    """The tokenizers library with a memory of pieces: ids as little-endian 32-bit integers."""

    def __init__(self, path: str, remembered_bytes: int = REMEMBERED_BYTES) -> None:
        self.tokenizer, self.cuts, self.blank_starts = _tokenizer(path)
        self.memory = _Memory(remembered_bytes)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has, from one call to the library."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        return ids, np.fromiter(map(len, found), np.int64, len(found))

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of different pieces that follow a blank; unknown ones are encoded.

        The pattern must cut before a mark of punctuation that ends a piece and follows a
        letter, so what is before the mark is encoded once for all marks."""
        memory = self.memory
        odd = pc.or_(pc.match_substring(pieces, " "), pc.equal(pieces, "")).to_numpy(zero_copy_only=False)
        marked = pc.match_substring_regex(pieces, _MARKED).to_numpy(zero_copy_only=False) & ~odd
        stems = pc.utf8_slice_codeunits(pieces.filter(pa.array(marked)), 0, -1)
        number = memory.find(pa.concat_arrays([pieces, stems])).copy()
        number, stem_number = number[: len(pieces)], number[len(pieces) :]
        new = number < 0
        if not new.any():
            return number
        new_marked = new[marked]
        stems, stem_number = stems.filter(pa.array(new_marked)), stem_number[new_marked]
        marked, blank, plain = (np.flatnonzero(new & kind) for kind in (marked, odd, ~marked & ~odd))

        if len(blank):
            number[blank] = len(memory.pieces) + np.arange(len(blank))
            there = pieces.take(pa.array(blank))
            memory.add(there, *self._encode([f" {piece}" for piece in there.to_pylist()]))
        # Pieces without a mark, and what is before the mark of others where nobody knows it.
        there = pieces.take(pa.array(plain))
        unknown = np.flatnonzero(stem_number < 0)
        missing = stems.take(pa.array(unknown)).dictionary_encode()
        same = pc.fill_null(pc.index_in(missing.dictionary, value_set=there), -1).to_numpy().copy()
        more = np.flatnonzero(same < 0)
        same[more] = len(there) + np.arange(len(more))
        number[plain] = len(memory.pieces) + np.arange(len(plain))
        stem_number[unknown] = len(memory.pieces) + same[missing.indices.to_numpy()]
        there = pa.concat_arrays([there, missing.dictionary.take(pa.array(more))])
        if len(there):
            texts = there.to_pylist()
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) // CALL_BYTES
            edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
            ids, _ = self._encode([" " + " ".join(texts[a:b]) for a, b in pairwise(edges)])
            memory.add(there, ids, np.diff(np.flatnonzero(self.blank_starts[ids]), append=len(ids)))
        if len(marked):
            number[marked] = len(memory.pieces) + np.arange(len(marked))
            there = pieces.take(pa.array(marked))
            ids, sizes = self._encode(list(_MARKS))
            mark = pc.index_in(pc.utf8_slice_codeunits(there, -1), value_set=pa.array(list(_MARKS))).to_numpy()
            starts = len(memory.ids) + np.cumsum(sizes) - sizes
            starts = np.stack([memory.starts[stem_number], starts[mark]], 1)
            sizes = np.stack([memory.sizes[stem_number], sizes[mark]], 1)
            ids = np.concatenate([memory.ids, ids])[_runs(starts.ravel(), sizes.ravel())]
            memory.add(there, ids, sizes.sum(1))
        return number

    def _part(self, texts: pa.Array, heads: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids and how many each text has; without `heads`, each text follows a blank."""
        memory = self.memory
        if memory.bytes > memory.most_bytes:
            memory.clear()
        lists = pieces_of(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets -= offsets[0]
        starts, sizes = np.zeros(len(pieces), np.int32), np.zeros(len(pieces), np.int32)
        later = np.ones(len(pieces), bool)
        head_ids = np.zeros(0, np.uint32)
        if heads:
            later[offsets[:-1]] = False
            head_ids, sizes[~later] = self._encode(pieces.take(pa.array(offsets[:-1])).to_pylist())
            pieces = pieces.filter(pa.array(later))
        known = pieces.dictionary_encode()
        piece = self._numbers(known.dictionary)[known.indices.to_numpy()]
        starts[later], sizes[later] = memory.starts[piece], memory.sizes[piece]
        starts[~later] = len(memory.ids) + np.cumsum(sizes[~later]) - sizes[~later]
        ids = np.concatenate([memory.ids, head_ids])[_runs(starts, sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[offsets]
        return ids, np.diff(ends)

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, null as empty, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.cuts:
            return self._encode(texts.to_pylist())
        if len(texts) > 1 or pc.binary_length(texts[0]).as_py() <= 2 * BATCH_BYTES:
            return self._part(texts, heads=True)
        found = [
            self._part(pa.array([part], texts.type), heads=not number)[0]
            for number, part in enumerate(_parts(texts[0].as_py(), BATCH_BYTES))
        ]
        ids = np.concatenate(found)
        return ids, np.array([len(ids)])

    def encode(self, texts: pa.Array) -> list[bytes]:
        ids, sizes = self.ids_of(texts)
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [data[start:end] for start, end in zip([0, *ends], ends)]

    def count(self, texts: pa.Array) -> np.ndarray:
        return self.ids_of(texts)[1]


def _tokenizer(path: str) -> tuple[object, bool, np.ndarray]:
    """The worker's tokenizer of that vocabulary, loaded once; whether texts may be cut at safe
    blanks for it; and which of its ids start with a blank."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        before = described.get("pre_tokenizer") or {}
        cuts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and not described.get("normalizer")
            and not any(
                re.search(r"[\s.,;:!?]", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                for t in described["added_tokens"]
            )
        )
        vocabulary = tokenizer.get_vocab()
        starts = np.zeros(max(vocabulary.values()) + 1, bool)
        starts[[number for token, number in vocabulary.items() if token.startswith(_BLANK)]] = True
        _TOKENIZERS[path] = tokenizer, cuts, starts
    return _TOKENIZERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; other columns are not read.

    Only lengths leave the Arrow function. Null and empty texts have no bytes and no
    tokens; ids may be null or repeat, each row is counted by itself. `path` must name the
    vocabulary on every executor.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Encoder(path)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            texts = pc.fill_null(batch.column("text"), "")
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pc.cast(pc.binary_length(texts), pa.int64()),
                    pa.array(use.count(texts), pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
