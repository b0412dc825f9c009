"""The corpus pipeline: documents through its stages, each written as Parquet and read again as the next one's input.

Toxic documents go, one document of each group of near-duplicates stays, secrets are masked, and what is left is packed
into sequences. Every stage works on all that the one before kept, and all but the last return the columns of `documents`.

Defined results: rows with null texts are empty documents and stay; rows with null ids stay, since they are nobody's
copies; rows that repeat an id are one document, of which one row stays; an empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateflow.llm import jaccard, packing, secrets, toxicity
from plateflow.session import shared_folder, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels that are not held out, does not reject."""
    ship_package(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component of linked documents."""
    ship_package(spark)
    return jaccard.keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by the name of its kind; `n_chars` follows the text."""
    ship_package(spark)
    masked = secrets.redact(docs)
    length = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    return masked.withColumn("n_chars", length) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its place in a sequence of 2048 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: Learned scores, n-gram components and tokenizers are beyond SQL; tests/llm/test_pipeline.py has the plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents below `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
