"""The corpus pipeline: quality classifier, exact dedup, near-dedup, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; stages are written as Parquet
and read again by run(). All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarn.llm import bpe, common, decontaminate, exact, minhash, quality


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (fitted on the labels of docs)."""
    return quality.keep_good(docs, quality.train(docs, common.load(spark, sf_dir, "labels")))


def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of each group of equal texts: that of the smallest doc_id."""
    return exact.deduplicate(docs)


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of each component of near-duplicates (five words, similarity 0.8): that of the smallest doc_id."""
    return minhash.deduplicate(docs, 5, 80)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    return decontaminate.decontaminate(docs, common.load(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the whole texts: count and digest, and the digest of what they decode to."""
    return bpe.round_trip(docs)


STAGES = [("quality", good), ("exact", exact_once), ("near", near_once), ("decontaminate", clean), ("bpe", tokens)]

#: Classifier, alignment and tokenizer cannot be put in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What earlier stages wrote is deleted once the next one is stored."""
    docs, began = common.load(spark, sf_dir, "documents"), common.mark()
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = common.new_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        common.sweep(spark, began, (docs,))
    return docs
