"""From raw documents to packed training sequences.

Every stage works on all that the one before it kept and writes its result to the shared folder;
all but the last return the columns of ``documents``. Rows are told apart by numbers of their own, so those with
equal or null ids are judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import decontaminate, nearcopies, packing, pii, toxicity
from concord.llm.common import free_name, table
from concord.session import stage


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; nothing is learned from held-out labels."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_of(F.col("text"), model) < toxicity.THRESHOLD)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id, decided row by row."""
    return nearcopies.first_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs, decided row by row."""
    number = free_name(docs)
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "pipeline-rows")
    found = decontaminate.overlap(rows.select(F.col(number).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select(F.col("doc_id").alias(number))
    return rows.join(hit, number, "left_anti").select(docs.columns)


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    path = packing.tokenizer_path("byte_bpe_50k.json")
    return packing.pack(docs, path, ids=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_copies_out),
    ("decontamination", benchmark_out),
    ("personal_data", personal_data_out),
    ("packing", packed),
]

#: Tokenization and boosted trees have no SQL form; tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
