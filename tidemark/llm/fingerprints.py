"""Document fingerprints: one-permutation MinHash, densified, as packed low-order bits.

Each shingle of five words is hashed once. Its leading bits name a bin, the others compete
for the bin's minimum; an empty bin takes the value of a full one, found by hashing the bin
and an attempt until one is full, so that two texts agree in a bin with the chance of their
Jaccard similarity, however short they are. Of each bin the four lowest bits are kept: one
hexadecimal digit. Texts that differ agree in a digit by chance once in sixteen times, which
the likeness of two fingerprints takes out again.

Everything is DataFrame expressions over one row at a time: no shingle leaves its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lower_ascii, table, written

SHINGLE = 5
BINS = 256
BITS = 4
#: Attempts at a full bin by hashing; where all fail, the full bin of the least hash is taken.
ATTEMPTS = 24
_VALUE_BITS = 48
_EMPTY = (1 << _VALUE_BITS) - 1
_PER_LONG = 64 // BITS
#: Fixed value: the four-bit numbers 1 in all places of a long.
_ONES = 0x1111111111111111
#: Ranges of ids into which documents are cut to find the next one; bytes of text in a group.
CELLS = 65_536
GROUP_BYTES = 1 << 20


def _bin_of(value: Column) -> Column:
    return F.shiftright(value, _VALUE_BITS)


def with_fingerprint(rows: DataFrame, text: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """rows with `name`, the fingerprint of the column `text` as 16 longs.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer words than
    a shingle has, but not none, is one shingle. A text without words, or null, has no
    fingerprint: an empty array.
    """
    words, hashes, least = f"__{name}_words", f"__{name}_hashes", f"__{name}_least"
    full, dense = f"__{name}_full", f"__{name}_dense"
    n = F.size(words)
    width = F.least(n, F.lit(shingle))
    # Each step is a column of its own that the next one reads many times.
    rows = rows.withColumn(
        words,
        F.transform(
            F.regexp_extract_all(F.coalesce(lower_ascii(F.col(text)), F.lit("")), F.lit(WORD), F.lit(0)),
            lambda word: F.xxhash64(word),
        ),
    )
    starts = F.when(n > 0, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))
    # Words beyond the end of a short text are null, which xxhash64 passes over.
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]))
    # Leading bits: the bin; the others: the value. An empty value for each bin ends its run.
    each = F.transform(
        hashed, lambda h: F.shiftrightunsigned(h, 64 - (BINS.bit_length() - 1) - _VALUE_BITS)
    )
    empties = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.shiftleft(i.cast("long"), _VALUE_BITS) + F.lit(_EMPTY)
    )
    rows = rows.withColumn(hashes, F.sort_array(F.concat(each, empties)))
    firsts = F.filter(
        hashes, lambda x, i: (i == 0) | (_bin_of(x) != _bin_of(F.get(hashes, i - 1)))
    )
    mask = F.lit(_EMPTY)
    rows = rows.withColumn(least, F.transform(firsts, lambda x: F.nullif(x.bitwiseAND(mask), mask)))
    rows = rows.withColumn(
        full, F.filter(F.transform(least, lambda x, i: F.struct(i.alias("bin"), x.alias("value"))), lambda b: b["value"].isNotNull())
    )

    def attempt(i: Column, k: int) -> Column:
        return F.get(least, F.pmod(F.xxhash64(i, F.lit(k)), F.lit(BINS)).cast("int"))

    def by_least_hash(i: Column) -> Column:
        return F.array_min(F.transform(full, lambda b: F.struct(F.xxhash64(i, b["bin"]), b["value"])))["value"]

    # A value is hashed with its bin, so that one that fills many bins has other bits in each.
    low = F.lit((1 << BITS) - 1).cast("long")
    filled = F.transform(
        least,
        lambda x, i: F.xxhash64(
            F.coalesce(x, *[attempt(i, k) for k in range(ATTEMPTS)], by_least_hash(i)), i
        ).bitwiseAND(low),
    )
    only = F.get(full, F.lit(0))["value"]
    rows = rows.withColumn(
        dense,
        F.when(F.size(full) == 0, F.array().cast("array<bigint>"))
        .when(F.size(full) == 1, F.transform(least, lambda x, i: F.xxhash64(only, i).bitwiseAND(low)))
        .otherwise(filled),
    )
    longs = F.transform(
        F.when(F.size(dense) > 0, F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1))).otherwise(
            F.array().cast("array<int>")
        ),
        lambda j: F.aggregate(
            F.slice(dense, j * _PER_LONG + 1, _PER_LONG),
            F.lit(0).cast("long"),
            lambda packed, x: F.shiftleft(packed, BITS).bitwiseOR(x),
        ),
    )
    return rows.withColumn(name, longs).drop(words, hashes, least, full, dense)


def fingerprint_text(longs: str) -> Column:
    """A fingerprint as hexadecimal digits, one for each bin; an empty one is the empty text."""
    return F.lower(F.array_join(F.transform(longs, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(one: str, other: str) -> Column:
    """The estimated Jaccard similarity of two texts by their fingerprints, 0 to 1.

    The share of equal digits, less what chance makes equal. Two empty fingerprints are alike,
    an empty one and another are not."""

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(_ONES))).cast("int")

    unequal = F.aggregate(F.zip_with(one, other, differing), F.lit(0), lambda total, n: total + n)
    equal = 1 - unequal / F.lit(float(BINS))
    chance = 1 / (1 << BITS)
    both = (F.size(one) > 0) & (F.size(other) > 0)
    return (
        F.when(both, F.greatest(F.lit(0.0), (equal - chance) / (1 - chance)))
        .when((F.size(one) == 0) & (F.size(other) == 0), F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with `fingerprint` (hexadecimal digits of its text); other columns stay."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "fingerprint"]
    found = with_fingerprint(docs.select(F.struct(*kept).alias("row"), F.col("text").alias("text")), "text", "longs")
    return found.select("row.*", fingerprint_text("longs").alias("fingerprint"))


def _cell(doc_id: Column, low: int, high: int) -> Column:
    """The range of an id: equal widths between the least and the highest id, in order. Rows
    without an id come last, by hash."""
    # In decimals: the difference of two longs may not be one.
    least, width = (F.lit(str(x)).cast("decimal(20,0)") for x in (low, high - low + 1))
    cell = F.floor((doc_id.cast("decimal(20,0)") - least) * F.lit(CELLS) / width).cast("long")
    cell = F.when(doc_id.isNotNull(), F.least(cell, F.lit(CELLS - 1)))
    return F.coalesce(cell, F.lit(CELLS) + F.shiftrightunsigned(F.col("text_hash"), 56))


def with_next(rows: DataFrame, made: Callable[[DataFrame], DataFrame], carried: list[str]) -> DataFrame:
    """rows (doc_id, text and others) with what `made` adds to each and `next`: the columns
    `carried` of the next row by id, null last, then by the text's hash; after the last row
    comes the first.

    Ids are counted in ranges, neighbouring ranges are joined to groups of about equal bytes,
    and each group is sorted by itself, with a copy of the first row of the next one at its
    end. Texts are shuffled once. Rows of one id are in one group; ids should tell rows apart.
    """
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    span = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = span["low"] or 0, span["high"] or 0
    placed = rows.withColumn("cell", _cell(F.col("doc_id"), low, high))
    key = F.struct(
        F.col("cell"),
        F.col("doc_id"),
        F.shiftrightunsigned("text_hash", 1).alias("half"),  # unsigned, as the ranges of rows without id
        F.col("text_hash"),
    )
    cells = written(
        placed.groupBy("cell").agg(
            F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("bytes"), F.min(key).alias("first")
        ),
        "id-ranges",
    )
    along = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    grouped = cells.withColumn(
        "group", F.floor(F.coalesce(F.sum("bytes").over(along), F.lit(0)) / GROUP_BYTES).cast("int")
    )
    groups = grouped.select("cell", "group")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("first"))
    ring = Window.orderBy("group")
    before = F.coalesce(F.lag("group").over(ring), F.max("group").over(Window.partitionBy()))
    heads = firsts.select("first.cell", "first.doc_id", "first.text_hash", before.alias("group"))
    copies = (
        placed.join(
            F.broadcast(heads.withColumnsRenamed({"cell": "c", "doc_id": "d", "text_hash": "h"})),
            (F.col("cell") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")),
        )
        .drop("c", "d", "h")
        .dropDuplicates(["group"])
        .withColumn("copy", F.lit(True))
    )
    dealt = placed.join(F.broadcast(groups), "cell").withColumn("copy", F.lit(False))
    along = Window.partitionBy("group").orderBy("copy", key)
    following = made(dealt.unionByName(copies)).withColumn("next", F.lead(F.struct(*carried)).over(along))
    return following.filter(~F.col("copy")).drop("copy", "group", "cell", "text_hash")


def compare_edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter of code points replaced by as many of the next
    document's first ones. Null texts count as empty. `near_edited` is the likeness of the
    fingerprints of a text and its edited text, `near_next` of it and the next document's.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - quarter), F.left(F.col("next.text"), quarter))
    paired = with_next(
        texts, lambda rows: with_fingerprint(rows, "text", "longs"), ["text", "longs"]
    ).select(
        "doc_id", n.cast("long").alias("n_chars"), "longs", F.col("next.longs").alias("next_longs"), edited.alias("edited")
    )
    return with_fingerprint(paired, "edited", "edited_longs").select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text("longs").alias("fingerprint"),
        fingerprint_text("edited_longs").alias("edited_fingerprint"),
        likeness("longs", "edited_longs").alias("near_edited"),
        likeness("longs", "next_longs").alias("near_next"),
    )


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents"))
