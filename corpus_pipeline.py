"""A corpus for training, in stages: quality, near-duplicates, repeated passages,
benchmark passages, encoding.

Each stage reads what its predecessor kept, from Parquet, and its decisions take effect:
rejected documents go, one document of each near-duplicate group stays, repeated sentences are
cut out of the texts, documents with benchmark windows go, and the rest is encoded. All stages but
the last return the columns of ``documents``. Nulls, empty tables, ties and repeated rows are
handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import bpe, decontaminate, quality_crf, simhash, substring_dedup
from postloom.llm.common import bucket_of, written
from postloom.llm.queries import WORD_TOKENIZER, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the usable rows, calls good."""
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"), bucket_of("doc_id", 3) != 1)
    return quality_crf.keep_good(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose fingerprints (shingles of three words) link at two or fewer
    differing bits the document with the smallest id."""
    return simhash.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated sentences; one of which nothing is left goes."""
    cut = substring_dedup.remove_repeats(docs)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_sentences")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(
            F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of each document that is left."""
    return bpe.encode_texts(docs, WORD_TOKENIZER).drop("decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", encoding),
]

#: Classifier, near-duplicates and encoding have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return docs
