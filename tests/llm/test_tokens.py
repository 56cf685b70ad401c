import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from tests.llm.frames import empty, messy
from tidemark.llm import token_files, tokens
from tidemark.llm.common import shared_folder

PATH = public_tokenizers.path(tokens.VOCABULARY)
ODD = [
    "a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!", "'s", "'", "<|endoftext|>",
    "<|", "|>", "1", "٣", " ", " ", "\x1c", "\x85", "×", "中", "😀", " x", " the", "\r\n",
    "​", "I’m", "'ll", "½", "ª",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_pieces_give_the_ids_of_whole_texts(library):
    rng = random.Random(11)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(20_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    use = tokens.Encoder(PATH)
    got = [
        np.frombuffer(ids, "<u4").tolist()
        for start in range(0, len(texts), 3_000)
        for ids in use.encode(pa.array(texts[start : start + 3_000]))
    ]
    assert got == want


def test_the_memory_stays_bounded_and_right(library):
    use = tokens.Encoder(PATH, remembered_bytes=20_000)
    for k in range(30):
        texts = [f"word{j} and word{j + k}, then word." for j in range(40)]
        want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
        assert use.count(pa.array(texts)).tolist() == want
        assert use.memory.bytes < 40_000


def test_unknown_pieces_are_encoded_in_few_calls(library):
    use, calls = tokens.Encoder(PATH), []
    encode = use._encode
    use._encode = lambda texts: calls.append(len(texts)) or encode(texts)
    texts = [f"start{j} word{j} and{j % 7} more, of it" for j in range(5_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in use.encode(pa.array(texts))] == want
    assert len(calls) <= 4


def test_texts_beyond_a_batch_are_cut_at_safe_blanks(library, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_BYTES", 40)
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice([*ODD, "word", " and", ", so", " "]) for _ in range(120))
        use = tokens.Encoder(PATH)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(use.encode(pa.array([text]))[0], "<u4").tolist() == want
    assert tokens.Encoder(PATH).encode(pa.array([], pa.string())) == []
    assert tokens.Encoder(PATH).encode(pa.array([None, ""], pa.string())) == [b"", b""]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    use = tokens.Encoder(path)
    assert not use.cuts
    text = "Some  text,\nwith  blanks"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False)
    assert use.count(pa.array([text])).tolist() == [len(want.ids)]


def test_counts_of_a_messy_table(spark, library):
    docs = messy(spark)
    want = sorted(
        (str(r["doc_id"]), len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 512)
        for r in docs.collect()
        for t in [r["text"] or ""]
    )
    got = sorted((str(r[0]), *r[1:]) for r in tokens.token_counts(docs, PATH).collect())
    assert got == want
    assert tokens.token_counts(empty(spark), PATH).collect() == []


def ordered_ids(docs, library):
    rows = [
        (r["doc_id"] is not None, r["doc_id"] or 0, library.encode(r["text"] or "", add_special_tokens=False).ids + [0])
        for r in docs.collect()
    ]
    return sorted(rows, key=lambda r: r[:2])


@pytest.mark.parametrize("shard_bytes", [10**9, 4000])
def test_files_give_back_all_ids(spark, library, shard_bytes):
    docs = messy(spark)
    manifest = token_files.write_token_files(
        docs, PATH, shared_folder(spark, "test-ids"), shard_bytes=shard_bytes
    )
    assert (manifest.count() > 3) == (shard_bytes == 4000)
    got = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r["start"])
    want = ordered_ids(docs, library)
    assert [r["doc_id"] for r in got] == [key if known else None for known, key, _ in want]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    crc = lambda ids: zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((len(i), crc(i)) for _, _, i in want)


def test_empty_table(spark):
    assert token_files.token_files(empty(spark), PATH, shared_folder(spark, "test-ids")).collect() == []


def shard(docs):
    sink = pa.BufferOutputStream()
    writer = token_files.ShardWriter(sink)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    assert writer.close()[:2] == (len(docs), sum(len(ids) for _, ids in docs))
    return sink.getvalue().to_pybytes()


class Counting:
    """A random access file that remembers what was read."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.read += n
        return self.data[at : at + n]


def test_a_reader_unpacks_only_the_frames_it_needs():
    rng = np.random.default_rng(1)
    docs = [(k // 2, rng.integers(0, 50_000, 20_000).tolist()) for k in range(60)]
    data = shard([(None, [9]), *docs])
    file = Counting(data)
    reader = token_files.ShardReader(file)
    assert len(reader.seek) > 10
    assert [ids.tolist() for ids in reader.get(17)] == [ids for key, ids in docs if key == 17]
    assert file.read < len(data) / 4
    assert reader.get(999) == []
    assert [ids.tolist() for ids in reader.get(None)] == [[9]]


def test_frames_stand_alone_and_the_file_is_plain_zstandard():
    data = shard([(k, [k] * 70_000) for k in range(3)])
    reader = token_files.ShardReader(Counting(data))
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(whole) == reader.seek["unpacked"].sum()
    assert next(iter(reader.frame(2)))[0] == 2


def test_a_damaged_frame_is_told():
    data = bytearray(shard([(k, list(range(k, k + 70_000))) for k in range(3)]))
    data[10] ^= 0xFF
    reader = token_files.ShardReader(Counting(bytes(data)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(reader.frame(0))
    assert next(iter(reader.frame(1)))[0] == 1
    with pytest.raises(ValueError):
        token_files.ShardReader(Counting(bytes(data[:-1])))
