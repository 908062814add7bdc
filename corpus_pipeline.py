"""Documents to tokens in five stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from surveyloom.llm import decontaminate, mixing, simhash, tokenbin, toxicity  # noqa: E402
from surveyloom.llm.frames import new_path, stored  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the machine learns from the labelled ones among them."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score_column(model) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (3-word shingles, 3 bits): that with the smallest doc_id."""
    return simhash.keep_one(docs, width=3, radius=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents: one row for each epoch that takes words of a document."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the token files."""
    path = new_path(spark, "pipeline-tokens")
    tokenbin.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenbin.token_table(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: A fitted machine, XXH64 majorities and a tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
