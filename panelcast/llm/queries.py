"""The registered queries of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.conversations import damaged, repair_report
from panelcast.llm.credentials import secret_report, secret_spans
from panelcast.llm.embedding_dedup import near_vectors
from panelcast.llm.exact_dedup import exact_duplicates
from panelcast.llm.html_text import extract_main_text
from panelcast.llm.merkle import document_leaves, manifest, verified
from panelcast.llm.mixing import mix
from panelcast.llm.near_dedup import near_duplicates
from panelcast.llm.packing import Capacity, pack
from panelcast.llm.quality import score_quality
from panelcast.llm.sharding import byte_shards
from panelcast.llm.token_shards import token_shards
from panelcast.llm.toxicity import score_toxicity
from panelcast.sources.spool import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Capacity(tokens=2048))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chars_whole")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "group_key")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files go to a new folder in the shared one."""
    return token_shards(table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), shards=16)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares by the square root of bytes, one epoch; ``mix_rate`` rounded, as sums of doubles differ in the last digits."""
    mixed = mix(table(spark, sf_dir, "documents"), alpha=0.5, epochs=1.0, seed=17)
    return mixed.withColumn("mix_rate", F.round("mix_rate", 6))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(manifest(document_leaves(table(spark, sf_dir, "documents"))))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(secret_spans(table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))


REGISTERED = (
    op1_best_fit_packing,
    op2_embedding_near_dedup,
    op3_html_extraction,
    op4_exact_dedup,
    op5_minhash_near_dedup,
    op6_quality_classifier,
    op7_token_shards,
    op8_toxicity,
    op9_sharding,
    op10_mixing,
    op11_merkle_manifest,
    op12_secret_scan,
    op13_conversation_repair,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in REGISTERED}
