"""From documents to token ids: language ID, exact dedup, near-dedup, mixing and BPE, each stage stored as Parquet."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.llm import bpe, exact, language, mix, simhash
from variantry.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from their own labels."""
    return language.keep_identified(docs, language.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents left out or repeated so that sources have their weights."""
    return mix.mix(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document (little-endian unsigned 32-bit numbers), and the digest of the text they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    decoded = F.sha2(bpe.decode(F.col("ids"), vocabulary), 256)
    # Stored in between, so that tasks which encode need no second worker that decodes.
    return stored(bpe.encode(docs, vocabulary), "ids").select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), decoded.alias("decoded_sha256"), "ids"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_bpe", encode_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: SQL has no naive Bayes, SimHash or BPE; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLES: dict[str, str] = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
