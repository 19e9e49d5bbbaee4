"""The registered queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arealytics.llm.bitsliced import SEARCH_SQL
from arealytics.llm.merkle import MERKLE_SQL
from arealytics.llm.mixing import MIX_SQL
from arealytics.llm.topk import TOPK_SQL
from arealytics.llm.warc import WARC_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from arealytics.llm.bpe import encode

    return encode(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query("op3_url_rules")
def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm.url_rules import filter_urls

    return filter_urls(table(spark, folder, "pages"))


@query("op6_mix_sources", MIX_SQL)
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm.mixing import mix

    return mix(table(spark, folder, "documents"))


@query("op7_warc_index", WARC_SQL)
def warc_index(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm.warc import capture_histories

    return capture_histories(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op2_exact_top_k", TOPK_SQL)
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from arealytics.llm.topk import top_k

    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op9_hilbert_neighbours")
def hilbert_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from arealytics.llm.curves import nearest

    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op8_ngram_join")
def ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm.ngram_join import similar_documents

    return similar_documents(table(spark, folder, "documents"))


@query("op5_language_mixture")
def language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm import language
    from arealytics.llm.common import remainder

    documents = table(spark, folder, "documents")
    model = language.learn(documents, remainder("doc_id", 5) != 0)
    return language.identify(documents, model).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "shares"
    )


@query("op10_nnpu_toxicity")
def nnpu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from arealytics.llm import toxicity
    from arealytics.llm.common import remainder

    documents = table(spark, folder, "documents")
    model = toxicity.learn(
        documents, table(spark, folder, "labels"), lambda key: remainder(key, 3) != 1
    )
    return toxicity.score(documents, model).select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


@query("op4_pitman_yor")
def pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from arealytics.llm.common import remainder
    from arealytics.llm.pitman_yor import score_corpus

    held_out = remainder("doc_id", 5) == 1
    scored, model = score_corpus(table(spark, folder, "documents"), ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query("op13_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm.common import remainder
    from arealytics.llm.merkle import manifest

    return manifest(table(spark, folder, "documents"), remainder("doc_id", 2) == 0)


@query("op12_bitsliced_search", SEARCH_SQL)
def bitsliced_search(spark: SparkSession, folder: str) -> DataFrame:
    from arealytics.llm.bitsliced import search

    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("candidates")


@query("op11_quadratic_quality")
def quadratic_quality(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from arealytics.llm import quality
    from arealytics.llm.common import remainder
    from arealytics.session import pin

    described = pin(quality.describe(table(spark, folder, "documents")))
    model = quality.learn(described, table(spark, folder, "labels"), lambda key: remainder(key, 4) != 2)
    return quality.score(described, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.GOOD_FROM, 1).otherwise(0).alias("predicted"),
    )
