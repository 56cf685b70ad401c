"""Near duplicates by MinHash bands, odd sketches and exact checks on full shingle sets.

A node is a distinct shingle set, whatever number of documents have it. `SAMPLES` MinHash
values of a node serve twice: the first ones, in bands, find candidates; all of them, folded
into a bitmap of parities (an odd sketch), verify candidates: the bits in which two sketches
differ count the samples in which the sets differ, and at high similarity they do so
precisely. Only pairs that the sketches let pass are compared on their full sets.

Pairs inside a band's group are never listed as such. First every node is compared with one
node of its group; then, in groups that still hold nodes of several components, nodes of
different components are compared by sketch inside the join, which puts out passing pairs
only. So a group of copies costs as many rows as it has nodes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, by_bytes, table, written

SHINGLE = 5
PERCENT = 80
SAMPLES = 1024
BANDS, BAND_ROWS = 32, 4
SKETCH_BITS = 4096
#: Standard deviations of the sketch's estimate by which a pair may miss the threshold.
MARGIN = 5.0
BATCH_BYTES = 2 << 20
_BLOCK = 128

_WORD = re.compile(WORD)
_rng = np.random.default_rng(20240229)
_FACTORS = (_rng.integers(0, 2**31, SAMPLES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFTS = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    A text of fewer words than a shingle has one shingle, of all its words; without words
    it has none.
    """
    words = [_WORD.findall(text.encode().lower().decode()) if text else [] for text in texts]
    flat = [word for text in words for word in text]
    hashes = (
        pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
        if flat
        else np.zeros(0, np.uint64)
    )
    sets, start = [], 0
    for text in words:
        own = hashes[start : start + len(text)]
        start += len(text)
        width = min(size, len(own))
        total = np.full(max(0, len(own) - width + 1) if width else 0, width, np.uint64)
        for k in range(width):
            total = _mixed(total + own[k : len(own) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        sets.append(np.unique(total))
    return sets


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketch (64-bit words) of a set that is not empty."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    room = np.empty((_BLOCK, SAMPLES), np.uint32)
    for at in range(0, len(short), _BLOCK):
        part = short[at : at + _BLOCK, None]
        values = room[: len(part)]
        np.multiply(part, _FACTORS, out=values)
        np.add(values, _SHIFTS, out=values)
        np.minimum(least, values.min(axis=0), out=least)
    number = np.arange(SAMPLES, dtype=np.uint64)
    tagged = _mixed(least.astype(np.uint64) | (number << np.uint64(32)))
    rows = tagged[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    keys = np.zeros(BANDS, np.uint64)
    for k in range(BAND_ROWS):
        keys = _mixed(keys + rows[:, k])
    odd = np.bincount((tagged % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return keys.view(np.int64), np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_differing_bits(percent: int = PERCENT, margin: float = MARGIN) -> int:
    """Bits in which the sketches of a pair at the threshold differ, at most but for the margin."""
    share = 1 - percent / 100
    differing = 2 * SAMPLES * share
    spread = 2 * math.sqrt(SAMPLES * share * (1 - share))
    slope = math.exp(-2 * differing / SKETCH_BITS)
    noise = math.sqrt(SKETCH_BITS * (1 - slope * slope) / 4)
    expected = SKETCH_BITS / 2 * (1 - slope)
    # The parity noise of one bitmap is smaller than that of independent bits; this bounds it.
    return math.ceil(expected + margin * math.hypot(spread * slope, noise / 2))


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            signed = [signature(s) if len(s) else (None, None) for s in sets]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([keys for keys, _ in signed], pa.list_(pa.int64())),
                    pa.array([sketch for _, sketch in signed], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "node", "n_shingles", "keys", "sketch"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        sign,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, node binary, "
        "n_shingles long, keys array<long>, sketch array<long>",
    )


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, shingles of the nodes, from the texts of one document for each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            yield pa.record_batch(
                [
                    batch.column("node"),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "shingles"],
            )

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).alias("d")
    wanted = (
        texts.join(
            nodes.alias("n"),
            (F.col("d.text_hash") == F.col("n.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("n.doc_id")),
        )
        .select("n.node", "d.text")
    )
    return wanted.mapInArrow(build, "node binary, shingles array<long>")


def _differing(left: str, right: str) -> Column:
    words = SKETCH_BITS // 64
    return sum(
        (F.bit_count(F.get(F.col(left), F.lit(k)).bitwiseXOR(F.get(F.col(right), F.lit(k)))) for k in range(words)),
        F.lit(0),
    )


def _first_common_band(left: str, right: str) -> Column:
    """The first band in which two nodes meet: there they are compared, and nowhere else."""
    return F.coalesce(
        *[
            F.when(F.get(F.col(left), F.lit(k)) == F.get(F.col(right), F.lit(k)), k)
            for k in range(BANDS)
        ]
    )


def _may_link(percent: int, margin: float) -> Column:
    sizes = 100 * F.least("a.n_shingles", "b.n_shingles") >= percent * F.greatest(
        "a.n_shingles", "b.n_shingles"
    )
    return sizes & (_differing("a.sketch", "b.sketch") <= most_differing_bits(percent, margin))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (low, high) whose full sets are similar enough."""
    one = pairs.join(sets.select(F.col("node").alias("low"), F.col("shingles").alias("s")), "low")
    two = one.join(sets.select(F.col("node").alias("high"), F.col("shingles").alias("t")), "high")
    common = F.size(F.array_intersect("s", "t"))
    return two.filter(100 * common >= percent * (F.size("s") + F.size("t") - common)).select(
        "low", "high"
    )


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of a table of links (low, high); roots are least nodes.

    Alternates the two star steps of the well-known distributed algorithm; each round is
    written, so that plans stay short and a lost executor costs one round. Hot nodes are
    reduced by a partial minimum; the join back is split by adaptive execution.
    """
    edges = written(
        links.select(F.least("low", "high").alias("v"), F.greatest("low", "high").alias("u"))
        .filter("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("m").alias("v"), F.col("v").alias("u"))
            .filter("u <> v")
            .distinct()
        )
        large = written(large, "large-star")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.m").alias("v"), F.col("e.u").alias("u"))
            .filter("u <> v")
            .distinct()
        )
        edges = written(small, "small-star")
        told = edges.agg(
            F.count("*"), F.countDistinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(told) == before:
            break
        before = tuple(told)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _grouped(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, margin: float = MARGIN
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows of docs, the nodes with their first document, and node, root of the linked."""
    signed = written(_signatures(docs, size), "signatures")
    nodes = written(
        signed.filter("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("keys").alias("keys"),
            F.any_value("sketch").alias("sketch"),
        )
        .select("node", "first.doc_id", "first.text_hash", "n_shingles", "keys", "sketch"),
        "nodes",
    )
    placed = nodes.select("node", "doc_id", F.posexplode("keys").alias("band", "key"))
    groups = (
        placed.groupBy("key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first"),
            F.count("*").alias("n"),
        )
        .filter("n > 1")
        .select("key", F.col("first.node").alias("center"))
    )
    members = written(placed.join(groups, "key").select("band", "key", "node", "center"), "band-members")
    candidates = written(
        nodes.join(members.select("node").distinct(), "node", "left_semi"), "candidates"
    )
    sketches = candidates.select("node", "n_shingles", "sketch")
    sets = written(_sets(docs, candidates, size).dropDuplicates(["node"]), "shingle-sets")

    def passing(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(sketches.alias("a"), F.col("low") == F.col("a.node"))
            .join(sketches.alias("b"), (F.col("high") == F.col("b.node")) & _may_link(percent, margin))
            .select("low", "high")
        )

    star = written(
        members.filter("node <> center")
        .select(F.least("node", "center").alias("low"), F.greatest("node", "center").alias("high"))
        .distinct(),
        "star-pairs",
    )
    links = written(_linked(passing(star), sets, percent), "star-links")
    roots = components(links)
    rooted = members.join(roots, "node", "left").select(
        "band", "key", "node", F.coalesce("root", "node").alias("root")
    )
    mixed = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    across = written(
        rooted.join(mixed.select("key"), "key").join(candidates.drop("doc_id", "text_hash"), "node"),
        "mixed-members",
    )
    rest = (
        across.alias("a")
        .join(
            across.alias("b"),
            (F.col("a.key") == F.col("b.key"))
            & (F.col("a.root") < F.col("b.root"))
            & _may_link(percent, margin)
            & (_first_common_band("a.keys", "b.keys") == F.col("a.band")),
        )
        .select(
            F.least("a.node", "b.node").alias("low"), F.greatest("a.node", "b.node").alias("high")
        )
        .join(star, ["low", "high"], "left_anti")
    )
    more = written(_linked(rest, sets, percent), "cross-links")
    if more.take(1):
        roots = components(links.union(more))
    return signed, nodes, roots


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of docs.

    Two documents are linked if `100 * |common shingles| >= percent * |all shingles|`;
    component_id is the smallest doc_id reachable over links. Documents without words are
    linked with nothing. Null ids join a component but do not name it, unless it has no
    other; rows of one id and text are one document, told apart only by their caller.
    Shingles are compared by 64-bit hashes. A linked pair is missed with a chance below
    one in a million (no band in common, or sketches beyond the margin).
    """
    signed, nodes, roots = _grouped(docs, **options)
    named = roots.join(nodes.select("node", "doc_id"), "node").groupBy("root").agg(
        F.min("doc_id").alias("component_id")
    )
    of_node = roots.join(named, "root").select("node", "component_id")
    alone = nodes.join(of_node, "node", "left").select(
        "node", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return (
        signed.select("doc_id", "text_hash", "n_shingles", "node")
        .join(alone, "node", "left")
        .withColumn(
            "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "text_hash", "n_shingles", "component_id", "kept")
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, and every document without words, with all its columns.

    Rows of one id and text count as repeated and leave one. Of the others in a component the
    one with the least id stays, of one id the one with the least hash of its text, and one
    without an id only where none has one.
    """
    signed, nodes, roots = _grouped(docs, **options)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    of_component = (
        nodes.join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node"))
        .agg(first)
        .select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    )
    wordless = signed.filter("n_shingles = 0").select("doc_id", "text_hash").distinct()
    kept = of_component.union(wordless)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    found = rows.join(
        kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")), "left_semi"
    )
    return found.dropDuplicates(["doc_id", "text_hash"]).select("row.*")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=4)
    return found.drop("text_hash")


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 3], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n_common FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * n_common >= 80 * (x.n + y.n - n_common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a, a AS b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
named AS (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN words ON words.r = reach.b GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id IS NOT DISTINCT FROM coalesce(component_id, doc_id) AS kept
FROM words LEFT JOIN sizes USING (r) LEFT JOIN named USING (r)
"""
