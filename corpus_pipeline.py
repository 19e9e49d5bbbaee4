"""The corpus pipeline: five stages over ``documents``.

Each stage reads what the stage before has written.  All but the last return
the columns of ``documents``; the last returns one row per document of the
mixed corpus with its token ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from arealytics.llm import bpe, language, mixing, ngram_join, toxicity
from arealytics.llm.common import remainder
from arealytics.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a main language go."""
    model = language.learn(docs, remainder("doc_id", 5) != 0)
    return language.in_known_language(docs, model)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels, lambda key: remainder(key, 3) != 1)
    return toxicity.without_toxic(docs, model)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents stays."""
    return ngram_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.emit(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return bpe.encode(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        with_ids=True,
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_near_duplicates),
    ("mix", mixed),
    ("encode", encoded),
]

# trained models and byte-pair encoding have no SQL form
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("ids"))
