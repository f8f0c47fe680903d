"""Cleaning a document corpus in stages, each written as Parquet and read again as the input of the next.

Toxic documents go, one document of each near-duplicate group stays, passages that an earlier document also holds are
cut, personal data are masked, and what is left is packed into token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.llm.exchange import NO_ID
from cartouche.llm.graph import released
from cartouche.llm.katz import remainder
from cartouche.llm.packing import pack_documents
from cartouche.llm.personal import mask_personal
from cartouche.llm.shipping import ship
from cartouche.llm.signature_tree import jaccard_classes
from cartouche.llm.substrings import remove_repeats
from cartouche.llm.toxicity import score_toxicity, train_toxicity
from cartouche.sources.scratch import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, ``n_chars`` counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else docs.select(columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled rows does not call toxic."""
    ship(spark)
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), remainder() != 0)
    return score_toxicity(docs, model).where("predicted = 0").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; repeated rows stay once.

    Groups without any id keep every distinct text.
    """
    ship(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("__key")
    kept = released(jaccard_classes(docs).where("doc_id <=> component_id").select(key).distinct(), "kept")
    # join and window share one shuffle of the texts, by the key
    found = docs.select("*", key).join(kept, "__key")
    copy = F.row_number().over(W.partitionBy("__key", F.xxhash64("text")).orderBy(F.lit(0)))
    return found.withColumn("__copy", copy).where("__copy = 1").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 50 words that a document with a smaller id also holds; others unchanged."""
    ship(spark)
    cut = remove_repeats(docs)
    return with_text(cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))), docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    ship(spark)
    return with_text(mask_personal(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of at most 1024 tokens."""
    ship(spark)
    return pack_documents(docs, "byte_bpe_50k.json")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages),
    ("personal data", personal_data), ("packing", packing),
]
ORACLE_SQL = None  # SQL cannot express the trained stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
