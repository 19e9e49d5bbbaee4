"""The corpus pipeline from end to end on small tables."""

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

EXTRA = ("row", "id", "_mix_key", "_ngram_row", "_number", "n", "member")


@pytest.fixture
def tables(spark, tmp_path):
    source = "/root/testdata/sf0.001"

    def write(change=lambda df: df):
        documents = change(spark.read.parquet(f"{source}/documents.parquet"))
        documents.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        spark.read.parquet(f"{source}/labels.parquet").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return write


def stages(spark, folder):
    """What each stage returns, from what the one before it kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        yield name, docs


def test_stages_keep_columns_and_clean_documents(spark, tables):
    folder = tables(lambda df: df.withColumns({c: F.concat(F.lit(c), "doc_id") for c in EXTRA}))
    before = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = before.columns, {r[0] for r in before.select("doc_id").collect()}
    sizes = {}
    for name, docs in stages(spark, folder):
        sizes[name] = docs.count()
        kept = {r[0] for r in docs.select("doc_id").distinct().collect()}
        assert kept <= ids
        if name != "encode":
            assert docs.columns == columns
            wrong = F.lit(False)
            for c in EXTRA:
                wrong = wrong | (F.col(c) != F.concat(F.lit(c), F.col("doc_id")))
            assert docs.where(wrong).isEmpty()
        ids = kept
    assert list(sizes) == ["language", "toxicity", "near_duplicates", "mix", "encode"]
    assert sizes["language"] > 0.9 * before.count()
    assert sizes["language"] >= sizes["toxicity"] >= sizes["near_duplicates"] > 0.5 * sizes["toxicity"]
    assert sizes["encode"] == sizes["mix"] > sizes["near_duplicates"]


def test_run_gives_the_rows_of_its_last_stage(spark, tables):
    folder = tables()
    found = corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256")
    *_, (_, last) = stages(spark, folder)
    assert sorted(found.collect()) == sorted(last.select("doc_id", "n_tokens", "ids_sha256").collect())


def test_run_on_an_empty_table_and_without_labels(spark, tables):
    assert corpus_pipeline.run(spark, tables(lambda df: df.limit(0))).count() == 0
    # no language is labelled, so none is rejected
    folder = tables(lambda df: df.withColumn("lang", F.lit(None).cast("string")))
    (_, first), *_ = stages(spark, folder)
    letters = spark.read.parquet(f"{folder}/documents.parquet").where(F.col("text").rlike(r"\p{L}"))
    assert first.count() == letters.count() > 0
