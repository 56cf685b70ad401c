"""Mix sources to target weights: hash keys, prefix sums of sizes, a cut at each budget.

Everything is DataFrame expressions. A document's key is an MD5 of its id, so keys are
uniform and their leading digits are equal ranges: no sampling is needed to sort by range,
and a source with a third of all rows falls into as many ranges as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, table, written

#: Leading hexadecimal digits of the key that make a range: 65,536 ranges in each source.
RANGE_DIGITS = 4
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2


def word_count(text: Column) -> Column:
    """Maximal runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_name() -> Column:
    """What a row's key is made of: its id, or without one a hash of its text, so that very
    many rows without an id are dealt over all ranges."""
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))


def mix_key(name: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), name))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size).

    Weights repeat along the sources in code point order, null last. A target is
    `min(2 * size, level * weight)`, where the level spends `share` of all sizes: what
    resharing the excess of full sources by weight comes to. Sources without words get 0.
    The windows run over one row per source.
    """
    along = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(along) - 1) % len(weights) + 1).cast("int"),
    )
    cap = F.col("source_size") * float(MOST_EPOCHS)
    everything = Window.partitionBy()
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sizes.select("source", "source_size", weight.alias("weight"), cap.alias("cap"))
        .withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn(
            "open",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        )
        # A source is full if the rest, dealt over it and those after it, exceeds its cap.
        .withColumn("full", F.col("rest") * F.col("weight") / F.col("open") >= F.col("cap"))
    )
    first_open = F.min(
        F.when(~F.col("full"), F.struct("cap_rank", "rest", "open"))
    ).over(everything)
    return (
        rows.withColumn("cap_rank", F.row_number().over(by_fill))
        .withColumn("level", first_open)
        .select(
            "source",
            "source_size",
            F.when(
                F.col("level").isNull() | F.col("full") & (F.col("cap_rank") < F.col("level.cap_rank")),
                F.col("cap"),
            )
            .otherwise(F.col("level.rest") * F.col("weight") / F.col("level.open"))
            .alias("target"),
        )
    )


def mix(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    seed: str = "mix",
) -> DataFrame:
    """How often each row is taken so that the sources meet their targets.

    `rows`: row columns plus `doc_id`, `mix_name` (`row_name`), `source`, `size` (long); all are kept, with
    source_size, target and `epochs` added (0, 1 or 2 times). In each source rows are
    sorted by key; a prefix sum over the ranges of keys and one inside each range give
    the words before a row. Full epochs take every row; in the last one a row is taken
    while the words before it and half its own fit into what is left, so that a source
    misses its target by half a document at most.

    Null sources are a source of their own, rows without words are never taken, rows
    with one doc_id are told apart by size, and rows equal in both are interchangeable.
    """
    keyed = rows.withColumn("mix_key", mix_key(F.col("mix_name"), seed)).withColumn(
        "mix_range", F.substring("mix_key", 1, RANGE_DIGITS)
    )
    ranges = written(
        keyed.groupBy("source", "mix_range").agg(F.sum("size").alias("range_size")), "mix-ranges"
    )
    targets = source_targets(
        ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, share
    )
    earlier = (
        Window.partitionBy("source")
        .orderBy("mix_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
        .alias("r")
        .join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
        .select("r.source", "mix_range", "range_start", "source_size", "target")
    )
    inside = (
        Window.partitionBy("source", "mix_range")
        .orderBy("mix_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.withColumn("range_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = placed.alias("p").join(
        offsets.alias("o"),
        F.col("p.source").eqNullSafe(F.col("o.source"))
        & (F.col("p.mix_range") == F.col("o.mix_range")),
    )
    before = F.col("o.range_start") + F.col("p.range_before")
    full = F.floor(F.col("o.target") / F.expr("nullif(o.source_size, 0)"))
    left = F.col("o.target") - full * F.col("o.source_size")
    epochs = (
        F.when(F.col("p.size") == 0, F.lit(0))
        .otherwise(full + F.when(before + F.col("p.size") / 2.0 <= left, 1).otherwise(0))
        .cast("long")
    )
    return both.select(
        *[F.col(f"p.`{c}`") for c in rows.columns], "o.source_size", "o.target", epochs.alias("epochs")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents, each row as often as the mix takes it, with their own columns.

    Extra columns travel along under any name, those of this operator included.
    """
    whole = docs.select(
        "doc_id",
        row_name().alias("mix_name"),
        "source",
        word_count(F.col("text")).alias("size"),
        F.struct("*").alias("row"),
    )
    taken = mix(whole, **options).filter("epochs > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "epochs"))).select("row.*")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    size = word_count(F.col("text")).alias("size")
    sized = docs.select("doc_id", row_name().alias("mix_name"), "source", size)
    return mix(written(sized, "mix-sizes"), **options).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size")).alias("taken"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS k
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM per_source),
filled AS (
  SELECT *, row_number() OVER fill AS cap_rank,
         (sum(source_size) OVER ()) * 1.5::DOUBLE
           - coalesce(sum(cap) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM weighed WINDOW fill AS (ORDER BY cap / weight, source NULLS LAST)),
level AS (
  SELECT cap_rank AS level_rank, rest AS level_rest, open AS level_open
  FROM filled WHERE NOT rest * weight / open >= cap ORDER BY cap_rank LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN level_rank IS NULL OR cap_rank < level_rank THEN cap ELSE level_rest * weight / level_open END::DOUBLE AS target
  FROM filled LEFT JOIN level ON true),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(target / source_size)
         + CASE WHEN before + size / 2.0 <= target - floor(target / source_size) * source_size
                THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed WHERE size > 0
UNION ALL
SELECT doc_id, size, source_size, target, 0::BIGINT FROM placed WHERE size = 0
"""
