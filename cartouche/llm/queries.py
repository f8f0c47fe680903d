"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartouche.llm.hnsw import approximate_neighbours
from cartouche.llm.itq import near_duplicates
from cartouche.llm.katz import katz_scores, remainder
from cartouche.llm.lexical import lexical_search
from cartouche.llm.packing import pack_documents
from cartouche.llm.personal import find_personal
from cartouche.llm.pieces import round_trip
from cartouche.llm.repair import audit_conversations, damaged
from cartouche.llm.sharding import SHARDS, shard_rows
from cartouche.llm.shipping import ship
from cartouche.llm.signature_tree import jaccard_classes
from cartouche.llm.substrings import remove_repeats
from cartouche.llm.topk import top_k
from cartouche.llm.toxicity import score_toxicity, train_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of vectors with a cosine of 0.95 or more."""
    return near_duplicates(embeddings(spark, sf_dir))


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return jaccard_classes(documents(spark, sf_dir))


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows of highest inner product for every hundredth vector."""
    return top_k(embeddings(spark, sf_dir))


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and the text that they decode to."""
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    return round_trip(documents(spark, sf_dir), model).select(
        "doc_id", F.greatest(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_xxhash64"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text."""
    return find_personal(documents(spark, sf_dir)).drop("text")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by models of the labelled rows outside the held-out fifth."""
    docs = documents(spark, sf_dir)
    held_out = remainder() == 0
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of equal row counts, uniformly shuffled."""
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(rows, ["doc_id", "text_crc32", "size"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after windows of 50 words that an earlier document also holds are cut."""
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff log-probability of every text, learned from four fifths of them."""
    return katz_scores(documents(spark, sf_dir), remainder() != 1, remainder() == 1)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in sequences of at most 1024."""
    return pack_documents(documents(spark, sf_dir), "byte_bpe_50k.json")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and their cheapest repairs; conversations that lost every row as empty ones."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = audit_conversations(damaged(rows)).withColumnRenamed("conv_id", "__found")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("__found")), "left").drop("__found")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty near rows of large inner product for every twentieth vector, from a graph index."""
    return approximate_neighbours(embeddings(spark, sf_dir))
