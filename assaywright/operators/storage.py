"""Cutting lineage: intermediate key sets are stored, so a lost executor costs a re-read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode with none set."""
    context = spark.sparkContext
    known = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="assaywright-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, paths: list[str], by: Sequence[str] = ()) -> DataFrame:
    """The frame computed once, written to the shared folder and read back from there from then on.

    ``paths`` collects what was written, for ``release``; ``by`` names columns with a folder per value.
    """
    path = new_path(df.sparkSession, "stored")
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete what ``stored`` wrote; frames that read it are of no use afterwards."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    paths.clear()
