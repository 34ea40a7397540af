"""A corpus pipeline over `documents`: filter, deduplicate, mask, mix, encode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe_codec, mixing, quality_rules, secret_scan, simhash
from folioforge.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    trusted = quality_rules.trusted_by_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judged(docs, trusted, leave_out=True).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: fingerprints of 3-word shingles, linked at 3 or
    fewer differing bits."""
    return simhash.keep_one_per_class(docs)


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask."""
    return secret_scan.mask_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit), n_tokens and digests of the ids and of the text decoded from them."""
    return bpe_codec.encoding_digests(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_masks),
    ("source mixing", source_mix),
    ("encoding", encode),
]

#: Hashes and tokenizers are beyond SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each on what its predecessor has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
