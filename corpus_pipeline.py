"""From raw documents to tokens: five stages, each an operator of tremorlake.llm.

Documents the quality classifier rejects go; lines that are boilerplate across
sources go; one document of each near-duplicate group stays; the sources are mixed
to their target weights; what is left is encoded. Each stage is written as Parquet
and read again as the documents of the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm import bytepair, lines, mixing, quality, simhash
from tremorlake.llm.common import saved, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those the classifier rejects."""
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without boilerplate lines but the first of each; n_chars follows the text."""
    kept, _ = lines.dedup_lines(docs)
    result = kept.select(*docs.columns)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return result


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_of_each(docs, simhash.SHINGLE, simhash.MAX_BITS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs as often as the mix takes them."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the hashes of ids and of decoded bytes, and the ids of every document of the mix."""
    return bytepair.encode_and_decode(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

# The classifier, the fingerprints and the encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
