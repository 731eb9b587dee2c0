"""A corpus from raw documents to packed sequences, each stage one operator.

Quality rules drop documents, line dedup cuts out repeated passages (documents left without a word go), the
n-gram Jaccard join keeps the smallest id of each group, secrets are masked, and what is left is packed.
Stages that change a text bring ``n_chars`` up to date. Rows with a null id stay until they are packed.
Between stages the documents are a Parquet table in the checkpoint folder; ``run`` leaves the last one only, and
none of the tables that a stage writes for itself.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.llm.jaccard_join import jaccard_groups
from gridmetrics.llm.line_dedup import without_repeated_passages
from gridmetrics.llm.packing import packed_documents
from gridmetrics.llm.quality import quality_cascade
from gridmetrics.llm.queries import CLOSING_ID, SEQUENCE_TOKENS
from gridmetrics.llm.secret_scan import without_secrets
from gridmetrics.llm.storage import checkpoint_folder
from gridmetrics.workspace import drop_folder, passing_folders

#: Words of a shingle and similarity in percent from which documents are near duplicates.
SHINGLE_WORDS, NEAR_PERCENT = 5, 80


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the length of the text where they have a column for it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects."""
    return quality_cascade(docs, name="_failed_rule").where("_failed_rule is null").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later copies of repeated passages; those without a word left go."""
    left = without_repeated_passages(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _measured(left).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near duplicates; one row of each id."""
    groups = jaccard_groups(docs, SHINGLE_WORDS, NEAR_PERCENT)
    others = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(others, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null")).select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret masked."""
    return _measured(without_secrets(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their token ids, and their places in sequences."""
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS, CLOSING_ID)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("secret scan", mask_secrets),
    ("packing", pack),
]

#: Line dedup and what follows it cannot be said in SQL; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        with passing_folders(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            drop_folder(spark, f"{folder}/{number - 1}")
    return docs
