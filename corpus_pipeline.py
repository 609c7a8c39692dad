"""Corpus pipeline: quality, near-duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents, and an empty table gives an empty one.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import decontaminate, packing, quality, queries, secrets, simhash
from matchloom.llm.common import crc32_of_id, shared_dir, table

ROW = "_row"


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and n_chars, and the whole row to pass on."""
    return docs.select("doc_id", "text", "n_chars", F.struct(*docs.columns).alias(ROW))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labels outside the held-out third, as op5 does.

    Null texts are scored as empty ones, repeated rows one by one. No column may be named as ``ROW``.
    """
    labels = table(spark, sf_dir, "labels").filter(crc32_of_id(F.col("doc_id")) % 3 != 1)
    found = quality.scored(_rows(docs), quality.learn(docs, labels), (ROW,))
    return found.filter("score >= 0.5").select(f"{ROW}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group; of repeated rows of that id and text one. Null and wordless texts are one group."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Null texts stay, and of repeated rows all or none."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated rows too, with secrets replaced by a mark and n_chars put right; null texts stay null."""
    return secrets.redacted(docs, vocabularies=tuple(map(public_tokenizers.path, queries.WORD_VOCABULARIES)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece of each document goes; null texts count as empty, repeated rows are documents of their own."""
    found = packing.packed(docs, public_tokenizers.path(queries.PACKING_VOCABULARY))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]

#: Tokenizing and classifying can't be said in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
