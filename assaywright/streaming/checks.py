"""The same checks on streams: row rules, windowed summaries and duplicates within a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.storage import new_path
from ..plans.table_check import TableCheck
from ..rules import Rule
from ..sinks import writers


def parquet_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """New parquet files at a path (a folder, or a file standing alone) as a stream."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.schema(schema)
    return reader.parquet(f"{folder}/[{name[0]}]{name[1:]}")


def watched(stream: DataFrame, time_column: str, delay: str) -> DataFrame:
    """The stream with a watermark; times without a zone are read in the session's zone."""
    if dict(stream.dtypes)[time_column] == "timestamp_ntz":
        stream = stream.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return stream.withWatermark(time_column, delay)


def row_failures(stream: DataFrame, rules: Sequence[Rule], run_date: str, batch_id: int) -> DataFrame:
    """Detail rows of row-local rules; stateless, so it runs unchanged on a stream."""
    refused = [r.rule_id for r in rules if not r.is_row_local]
    if refused:
        raise ValueError(f"rules {refused} need more than one row and cannot run on a stream")
    return TableCheck(stream, rules, run_date, batch_id).detail()


def windowed_summary(
    stream: DataFrame, rules: Sequence[Rule], time_column: str, window: str = "1 day", delay: str = "1 day"
) -> DataFrame:
    """Counts and pass rate per rule and tumbling window; rows later than ``delay`` are dropped.

    All rules share one stateful aggregate with one state row per window.  Rows
    without a readable time belong to no window that could close: each is passed
    on as it comes, a row per rule with a NULL window; ``merged_windows`` adds them up.
    """
    check = TableCheck(stream, rules, "1970-01-01 00:00:00")
    chunk = list(enumerate(check.rules))
    rows = check.rows.withColumn("__time", F.col(time_column).try_cast("timestamp"))
    aggregates, entries = check.local_aggregates(chunk)
    ids = F.array(*[F.lit(rule.rule_id) for rule in check.rules])
    wide = rows.withWatermark("__time", delay).groupBy(F.window("__time", window))
    wide = wide.agg(F.count(F.lit(1)).alias("total"), *aggregates)
    long = wide.select("window", "total", F.inline(F.array(*entries)))
    no_window = F.lit(None).cast("struct<start:timestamp,end:timestamp>").alias("window")
    untimed = rows.where(F.col("__time").isNull())
    untimed = untimed.select(no_window, F.lit(1).cast("long").alias("total"), F.inline(F.array(*check.local_counts_of_row(chunk))))
    long = long.unionByName(untimed)
    passed = F.col("total") - F.col("missing") - F.col("failed")
    return long.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.element_at(ids, F.col("__rule") + 1).alias("rule_id"),
        F.col("total").alias("total_record_count"),
        (F.col("total") - F.col("missing")).alias("no_of_complete_records"),
        passed.alias("total_passed_count"),
        (F.col("missing") + F.col("failed")).alias("no_of_failures"),
        (passed / F.col("total")).alias("value"),
    )


def merged_windows(written: DataFrame) -> DataFrame:
    """What ``windowed_summary`` wrote so far, one row per rule and window, the NULL window included."""
    counts = ("total_record_count", "no_of_complete_records", "total_passed_count", "no_of_failures")
    merged = written.groupBy("window_start", "window_end", "rule_id").agg(*[F.sum(c).alias(c) for c in counts])
    return merged.withColumn("value", F.col("total_passed_count") / F.col("total_record_count"))


def first_seen(
    stream: DataFrame, keys: Sequence[str], time_column: str, delay: str, spread: int = 16
) -> DataFrame:
    """Each key once, as long as its copies arrive within the watermark.

    Copies of a key are first thinned in ``spread`` separate shares (by a hash of
    the record and its source partition), so a key that floods the stream does not fall to one task whole;
    at most ``spread`` copies reach the second step.  ``spread=1`` skips the first.
    """
    rows = watched(stream, time_column, delay)
    if spread > 1:
        share = F.pmod(F.xxhash64(*[F.col(c) for c in stream.columns], F.spark_partition_id()), F.lit(spread))
        rows = rows.withColumn("__share", share).dropDuplicatesWithinWatermark([*keys, "__share"]).drop("__share")
    return rows.dropDuplicatesWithinWatermark(list(keys))


def windowed_duplicates(
    stream: DataFrame, keys: Sequence[str], time_column: str, window: str, delay: str
) -> DataFrame:
    """Keys seen more than once in a tumbling window; state ends with the watermark."""
    grouped = watched(stream, time_column, delay).groupBy(F.window(time_column, window), *keys)
    counted = grouped.agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where(F.col("duplicate_count") > 1).select(
        F.col("window.start").alias("window_start"), *keys, "duplicate_count"
    )


def write_available(
    stream: DataFrame, target: str, checkpoint: str | None = None, partitions: Sequence[str] = ()
) -> StreamingQuery:
    """Process what is there now into a parquet folder (exactly once per checkpoint), then stop.

    Detail rows go to a log partitioned like the batch logs with
    ``partitions=LOG_PARTITIONS``; the file sink keeps that exactly-once as well.
    The sink keeps a list of its files, beside which readers see no others, so a
    folder that holds batch results is refused: give the stream a folder of its
    own and read both with ``writers.read_log``.
    """
    if writers.holds_files(stream.sparkSession, target) and not writers.streamed(stream.sparkSession, target):
        raise ValueError(f"{target} holds results of batch runs, which a stream's file list would hide")
    checkpoint = checkpoint or new_path(stream.sparkSession, "stream-state")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.outputMode("append").trigger(availableNow=True).start(target)
