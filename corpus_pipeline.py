"""From raw documents to token files: five stages, each a Spark job over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assaywright.llm import decontaminate, mixing, quality, simhash, tokens
from assaywright.llm.common import table
from assaywright.llm.queries import END_ID, tokenizer_path
from assaywright.operators.storage import stored

#: Quality, tokens and SimHash are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mix, once per copy, in the order of the curriculum."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document where its ids are and their checksum, read back from the files."""
    return tokens.round_trip(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), [])
    return STAGES[-1][1](spark, docs, sf_dir)
