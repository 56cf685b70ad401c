"""Documents to a training mix in five stages, each of which works on what the last one kept.

quality        documents that the quality rules reject go
near_dedup     one document of each group of near duplicates stays
decontaminate  documents that hold a passage of the benchmark go
mix            documents are taken as often as their source's target weight asks for
token_files    token ids in files of independent frames, and where each document is in them

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next one's documents. All but the last keep the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import remove_written, shared_folder, ships_package, table
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.neardup import drop_near_duplicates
from tidemark.llm.quality import keep_good
from tidemark.llm.token_files import token_files
from tidemark.llm.tokens import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


@ships_package
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


@ships_package
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


@ships_package
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


@ships_package
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


@ships_package
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document taken twice is in the files twice, one copy after the other."""
    return token_files(
        docs, public_tokenizers.path(VOCABULARY), shared_folder(spark, "token-files")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontamination),
    ("mix", mix),
    ("token_files", tokens),
]

#: SQL cannot express the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`; every stage's rows are in the shared folder, what
    it made on the way is removed."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "corpus")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        remove_written(spark)
    return docs
