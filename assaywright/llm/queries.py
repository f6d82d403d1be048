"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, clusters, decontaminate, language, mixing, negatives, quality, repeats, secrets, simhash, templates, tokens, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
END_ID = 2


def tokenizer_path() -> str:
    """The vocabulary file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, oracle: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


@query("op5_source_mix", mixing.REPORT_SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op2_simhash_groups")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


@query("op3_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@query("op4_token_frames")
def token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


@query("op9_decontamination", decontaminate.REPORT_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_language_centroids")
def language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


@query("op7_chat_format")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    said = r"\### Assistant: </turn> ok"
    kinds = dict(conversations.dtypes)
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], ["conv_id", "turn", "role", "text"])
    added = added.withColumns({c: added[c].cast(kinds[c]) for c in added.columns})
    return chat.report(conversations, added)


@query("op8_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op10_repeat_removal")
def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


@query("op6_line_templates")
def line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.report(table(spark, sf_dir, "documents"))


@query("op13_centroid_clusters", clusters.report_sql())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clustered(table(spark, sf_dir, "embeddings")).drop("measured")


@query("op12_toxicity")
def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_hard_negatives", negatives.REPORT_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.report(table(spark, sf_dir, "embeddings"))
