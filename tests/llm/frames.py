"""Small tables with everything in them that an operator must stand."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # columns whose names clash with those that operators make
    "size long, row string, counts string, kept string, node string, text_hash string, "
    "hits string, matches string, taken string, epochs string, shard string, n_tokens string"
)
WIDTH = 17


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (doc_id, text, lang, source), the rest is filled."""
    filled = [(*row, None if row[1] is None else len(row[1]), 7, *["x"] * (WIDTH - 6)) for row in rows]
    return spark.createDataFrame(filled, SCHEMA)


def vocabulary(n: int = 400, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    parts = ["an", "the", "or", "si", "ka", "mo", "ré", "lu", "ß", "ten"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, words: int, known: list[str]) -> str:
    return " ".join(rng.choice(known) for _ in range(words))


def messy_rows(seed: int = 5) -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows and copies."""
    rng, known = random.Random(seed), vocabulary()
    base = prose(rng, 120, known)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", "b"),
        (4, "word", None, None),
        (None, base, "en", "a"),
        (None, prose(rng, 80, known), None, "b"),
        (None, None, None, None),
        (10, base, "en", "a"),
        (11, base, "de", "c"),
        (11, base, "de", "c"),
        (12, prose(rng, 70, known), "fr", "c"),
        (12, prose(rng, 75, known), "fr", "c"),
        (13, prose(rng, 4000, known), "en", ""),
        (14, "x" * 5000, "en", "b"),
        (15, "\n".join(["same line again"] * 60), "en", "b"),
        (16, "ä<|endoftext|> ö  ü\r\n\n中文 😀", "zh", "b"),
        (-5, base + " " + prose(rng, 3, known), "en", "a"),
    ]
    return rows + [(k, prose(rng, rng.randint(1, 200), known), "en", "hot") for k in range(100, 130)]


def messy(spark: SparkSession) -> DataFrame:
    return documents(spark, messy_rows())


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
