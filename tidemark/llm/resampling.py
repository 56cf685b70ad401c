"""Importance resampling towards a target distribution, by hashed n-gram features.

A line feed separates words, so a text is its lines one after the other. The features of
each different line of the corpus are hashed once and multiplied by the line's occurrences;
runs of words that cross lines are few and added for each text by itself. The counts of the
buckets in corpus and target give each bucket a gain, a document's weight is the mean gain
of its features, and Gumbel noise from a hash of its id turns the highest scores into a
sample without replacement. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, small, table, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MOST_WORDS = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
#: A line that makes up more than this share of all lines is hot: there are at most as many
#: hot lines as the inverse, whatever the corpus.
HOT_SHARE = 1 / 10_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def line_buckets(words: str, most_words: int, buckets: int) -> Column:
    """The bucket of every run of 1 to `most_words` words in an array column."""

    def runs(size: int) -> Column:
        starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1)))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: _bucket(F.array_join(F.slice(words, i, size), " "), buckets),
        )

    single = F.transform(words, lambda word: _bucket(word, buckets))
    return F.concat(single, *[runs(size) for size in range(2, most_words + 1)])


def crossing_buckets(lines: str, most_words: int, buckets: int) -> Column:
    """The bucket of every run of 2 to `most_words` words that begins in one line of a text and
    ends in another; `lines` is an array column of the lines' words.

    Only the first and last words of a line can be in one; a null stands for the others."""
    if most_words < 2:
        return F.array().cast("array<int>")
    edge = most_words - 1

    def ends(words: Column, line: Column) -> Column:
        few = F.concat(
            F.slice(words, 1, edge), F.array(F.lit(None).cast("string")), F.slice(words, -edge, edge)
        )
        kept = F.when(F.size(words) <= 2 * edge, words).otherwise(few)
        return F.transform(kept, lambda w: F.struct(line.alias("line"), w.alias("word")))

    flat = F.flatten(F.transform(F.filter(lines, lambda words: F.size(words) > 0), ends))

    def runs(size: int) -> Column:
        starts = F.when(F.size(flat) >= size, F.sequence(F.lit(1), F.size(flat) - (size - 1)))
        each = F.transform(
            F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.slice(flat, i, size)
        )
        cross = F.filter(
            each,
            lambda run: (run[0]["line"] != run[size - 1]["line"])
            & ~F.exists(run, lambda w: w["word"].isNull()),
        )
        return F.transform(
            cross, lambda run: _bucket(F.array_join(F.transform(run, lambda w: w["word"]), " "), buckets)
        )

    return F.concat(*[runs(size) for size in range(2, most_words + 1)])


def _line_key(line: Column) -> Column:
    """128 bits by which a line is known."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def distinct_lines(texts: DataFrame, most_words: int, buckets: int) -> DataFrame:
    """Each different line of the column `text`: key, occurrences, n_words, buckets.

    Occurrences are counted in the map tasks already, so a line that is everywhere sends one
    row per task."""
    counted = (
        texts.select(F.explode(F.split("text", "\n", -1)).alias("line"))
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return (
        counted.select(_line_key(F.col("line")).alias("key"), "occurrences", words_of(F.col("line")).alias("words"))
        .select(
            "key", "occurrences", F.size("words").alias("n_words"), line_buckets("words", most_words, buckets).alias("buckets")
        )
    )


def bucket_counts(lines: DataFrame, crossing: DataFrame) -> DataFrame:
    """bucket, n: features of all texts in each bucket."""
    inside = lines.select(F.explode("buckets").alias("bucket"), "occurrences")
    across = crossing.select(F.explode("crossing").alias("bucket"), F.lit(1).cast("long").alias("occurrences"))
    return inside.unionByName(across).groupBy("bucket").agg(F.sum("occurrences").alias("n"))


def _texts(rows: DataFrame, most_words: int, buckets: int, *columns: Column) -> DataFrame:
    """One row per text with the keys of its lines and the buckets of runs that cross them."""
    lines = F.split("text", "\n", -1)
    crossing = F.array().cast("array<int>")
    if most_words > 1:
        rows = rows.withColumn("__lines", F.transform(lines, words_of))
        crossing = crossing_buckets("__lines", most_words, buckets)
    return rows.select(
        *columns,
        F.transform(lines, _line_key).alias("keys"),
        F.coalesce(crossing, F.array().cast("array<int>")).alias("crossing"),
    )


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """The gain of each bucket; there are `buckets` of them, whatever the corpus."""
    total = corpus.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    s_all, t_all = total.first()[0], target.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    s, t = (F.coalesce(F.col(c), F.lit(0)) for c in ("s", "t"))
    rate = ((t + 1) * F.lit(s_all + buckets)) / ((s + 1) * F.lit(t_all + buckets))
    both = corpus.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    rows = both.select("bucket", F.floor(1000 * F.log(rate)).alias("gain")).collect()
    unseen = corpus.sparkSession.range(1).select(
        F.floor(1000 * F.log(F.lit(s_all + buckets) / F.lit(t_all + buckets)))
    )
    found = [unseen.first()[0]] * buckets
    for row in rows:
        found[row["bucket"]] = row["gain"]
    return found


def _gain_sum(buckets: str, of_bucket: list[int]) -> Column:
    table_of = F.split(F.lit(",".join(map(str, of_bucket))), ",").cast("array<bigint>")
    return F.aggregate(buckets, F.lit(0).cast("long"), lambda total, b: total + F.get(table_of, b))


def weights(
    docs: DataFrame, target: DataFrame, most_words: int = MOST_WORDS, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_words, n_features and weight of each row of docs.

    Hot lines are joined by a broadcast (at most `1 / HOT_SHARE` of them), the others by
    shuffle. Null and empty texts have no features and weight 0; ids may be null or repeat,
    each row is weighed by itself.
    """
    texts = docs.select("doc_id", "text")
    lines = written(distinct_lines(texts, most_words, buckets), "lines")
    rows = written(
        _texts(texts, most_words, buckets, F.monotonically_increasing_id().alias("row"), F.col("doc_id")),
        "line-keys",
    )
    theirs = target.select("text")
    target_counts = bucket_counts(
        distinct_lines(theirs, most_words, buckets), _texts(theirs, most_words, buckets)
    )
    of_bucket = gains(
        written(bucket_counts(lines, rows), "corpus-buckets"), written(target_counts, "target-buckets"), buckets
    )
    weighed = written(
        lines.filter(F.size("buckets") > 0).select(
            "key",
            "occurrences",
            "n_words",
            F.size("buckets").alias("n_features"),
            _gain_sum("buckets", of_bucket).alias("gain"),
        ),
        "line-gains",
    )
    all_lines = lines.agg(F.coalesce(F.sum("occurrences"), F.lit(0))).first()[0]
    hot = F.col("occurrences") > int(all_lines * HOT_SHARE) + 1
    asked = rows.select("row", "doc_id", F.explode("keys").alias("key"))
    parts = [F.col(c).cast("long") for c in ("n_words", "n_features", "gain")]
    known = F.broadcast(weighed.filter(hot).select("key"))
    each = [
        asked.join(F.broadcast(weighed.filter(hot)), "key"),
        asked.join(known, "key", "left_anti").join(weighed.filter(~hot), "key"),
    ]
    none = F.lit(0).cast("long")
    found = rows.select(
        "row",
        "doc_id",
        none.alias("n_words"),
        F.size("crossing").cast("long").alias("n_features"),
        _gain_sum("crossing", of_bucket).alias("gain"),
    )
    for part in each:
        found = found.unionByName(part.select("row", "doc_id", *parts))
    sums = found.groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")])
    mean = F.when(F.col("n_features") > 0, F.expr("gain - pmod(gain, n_features)") / F.col("n_features"))
    return sums.select(
        "doc_id", "n_words", "n_features", F.coalesce(mean, F.lit(0)).cast("long").alias("weight")
    )


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, by a hash of the id; a null id is hashed as `null`."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    most_words: int = MOST_WORDS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each row of docs; rank is null if not drawn.

    Of the N documents with `least_words` words, `percent` of a hundred are drawn: the highest
    scores, ties to smaller ids, null last. Scores are integers, so the documents above a score
    are counted by a table of scores, and only those of one score are sorted together.
    """
    scored = written(
        weights(docs, target, most_words, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)),
        "scores",
    )
    able = scored.filter(F.col("n_words") >= least_words)
    by_score = written(able.groupBy("score").agg(F.count(F.lit(1)).alias("n")), "score-counts")
    drawn = percent * (by_score.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // 100
    before = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = by_score.select("score", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("above"))
    above = above.filter(F.col("above") < drawn)
    ties = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    ranked = (
        able.join(small(above), "score")
        .withColumn("rank", F.col("above") + F.row_number().over(ties))
        .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    )
    others = scored.join(small(above.select("score")), "score", "left_anti").unionByName(
        scored.filter(F.col("n_words") < least_words).join(small(above.select("score")), "score", "left_semi")
    )
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionByName(
        others.select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT n, n AS c, 0 AS k FROM (SELECT unnest(range(256)) AS n)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
asked AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
owned AS (SELECT r, unnest(w) AS word FROM docs),
counted AS (SELECT r, word, count(*) AS n FROM owned GROUP BY ALL),
spelt AS (
  SELECT word, regexp_extract_all(hex(encode(word)), '..') AS bytes
  FROM (SELECT DISTINCT word FROM (SELECT word FROM counted UNION ALL SELECT word FROM asked))),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, [('0x' || b)::BIGINT FOR b IN bytes]),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % 10000 AS bucket
  FROM spelt, crc),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM counted JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM asked JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0)::BIGINT FROM s) + 10000))::DOUBLE
                                 / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0)::BIGINT FROM t) + 10000))::DOUBLE))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
sums AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS gain
  FROM counted JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
weighed AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
         CASE WHEN n_features > 0 THEN (gain - ((gain % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight
  FROM docs LEFT JOIN sums USING (r)),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM weighed),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20),
drawn AS (SELECT r, rank FROM ranked WHERE rank <= 10 * (SELECT count(*) FROM ranked) // 100)
SELECT doc_id, n_features, weight::BIGINT AS weight, score::BIGINT AS score, rank
FROM scored LEFT JOIN drawn USING (r)
"""
