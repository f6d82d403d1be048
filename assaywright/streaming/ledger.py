"""Streams whose micro-batches are runs: each is published whole, once, in place of an earlier attempt.

``foreachBatch`` may hand over a micro-batch again after a failure.  Here its
results are written elsewhere and published as the run (stream, number of the
micro-batch), see ``sinks.commit``; a second attempt replaces the first.  So a
stream shares one log with batch runs, which publish in the same way, and plain
readers see all rows.

A stream is known by its name.  By default that is made from the checkpoint
folder, where Spark counts the micro-batches; whoever starts over with a new
checkpoint and wants the old results replaced names the stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.storage import release, stored
from ..plans.table_check import TableCheck
from ..rules import Rule
from ..sinks import commit, writers

NOTES = "_newest"
ON_TIME, LATE, UNTIMED = "on_time", "late", "untimed"
COUNTS = ("total_record_count", "no_of_complete_records", "total_passed_count", "no_of_failures")


def stream_name(checkpoint: str) -> str:
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _run(name: str, number: int) -> str:
    return f"{name}-{number:012d}"


def _started(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def publish_available(stream: DataFrame, target: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Process what is there now into a result log that batch runs may share, then stop.

    Every micro-batch is a run of its own in the log; replaying one changes nothing.
    """
    called = name or stream_name(checkpoint)

    def publish(batch: DataFrame, number: int) -> None:
        writers.publish_run(_run(called, number), {target: batch})

    return _started(stream, checkpoint, publish)


def _newest_before(spark: SparkSession, folder: str, number: int) -> int | None:
    """The latest event time (microseconds) of all micro-batches before this one."""
    files = commit.Files(spark)
    before = [n for n in files.names(folder) if n[:1].isdigit() and int(n.split(".")[0]) < number]
    return files.read(f"{folder}/{before[-1]}")["newest"] if before else None


def _note_newest(spark: SparkSession, folder: str, number: int, newest: int | None) -> None:
    """Note the latest event time up to this micro-batch; a replay needs the note before it, none older."""
    files = commit.Files(spark)
    files.make(folder)
    files.write(f"{folder}/{number:012d}.json", {"newest": newest})
    for old in files.names(folder):
        if old[:1].isdigit() and int(old.split(".")[0]) < number - 1:
            files.delete(f"{folder}/{old}")


def count_windows(
    stream: DataFrame,
    rules: Sequence[Rule],
    time_column: str,
    target: str,
    checkpoint: str,
    window: str = "1 day",
    delay: str = "1 day",
    name: str | None = None,
) -> StreamingQuery:
    """Count rows per rule and tumbling window, late and untimed rows included, into a folder of partial counts.

    A row is late if its window ended at or before the watermark: the latest event
    time of all earlier micro-batches less ``delay``.  Spark's windowed aggregate
    drops such rows unseen; here they are counted apart (``kind`` late), and rows
    without a readable time too (``kind`` untimed, no window).  So the counts of
    the three kinds add up to all rows.

    A micro-batch is one partial aggregate that leaves a row per rule, window and
    kind; nothing is kept in a state store, and ``window_counts`` adds the parts up.
    """
    called = name or stream_name(checkpoint)
    notes = f"{target.rstrip('/')}/{NOTES}/{called}"

    def count(batch: DataFrame, number: int) -> None:
        spark, paths = batch.sparkSession, []
        check = TableCheck(batch, rules, "1970-01-01 00:00:00")
        aggregates, entries = check.local_aggregates(list(enumerate(check.rules)))
        rows = check.rows.withColumn("__time", F.col(time_column).try_cast("timestamp"))
        # a window of its own for rows without a time, so that one pass counts all
        untimed = F.col("__time").isNull()
        rows = rows.withColumn("__untimed", untimed).withColumn("__at", F.coalesce("__time", F.timestamp_micros(F.lit(0))))
        grouped = rows.groupBy(F.window("__at", window), "__untimed")
        counted = grouped.agg(F.count(F.lit(1)).alias("total"), F.unix_micros(F.max("__time")).alias("__newest"), *aggregates)
        before = _newest_before(spark, notes, number)
        try:
            counted = stored(counted, paths)
            here = counted.agg(F.max("__newest")).first()[0]
            known = [t for t in (before, here) if t is not None]
            _note_newest(spark, notes, number, max(known) if known else None)
            watermark = F.timestamp_micros(F.lit(before).cast("long")) - F.expr(f"interval {delay}")
            late = F.coalesce(F.col("window.end") <= watermark, F.lit(False))
            kind = F.when(F.col("__untimed"), UNTIMED).when(late, LATE).otherwise(ON_TIME)
            ids = F.array(*[F.lit(rule.rule_id) for rule in check.rules])
            long = counted.select("window", "__untimed", kind.alias("kind"), "total", F.inline(F.array(*entries)))
            start, end = (F.when(~F.col("__untimed"), F.col(f"window.{side}")) for side in ("start", "end"))
            passed = F.col("total") - F.col("missing") - F.col("failed")
            values = (F.col("total"), F.col("total") - F.col("missing"), passed, F.col("missing") + F.col("failed"))
            part = long.select(
                start.alias("window_start"),
                end.alias("window_end"),
                F.element_at(ids, F.col("__rule") + 1).alias("rule_id"),
                "kind",
                *[value.alias(label) for value, label in zip(values, COUNTS)],
            )
            writers.publish_run(_run(called, number), {target: part}, partitions=())
        finally:
            release(spark, paths)

    return _started(stream, checkpoint, count)


def window_counts(spark: SparkSession, target: str) -> DataFrame:
    """What ``count_windows`` counted so far, one row per rule, window and kind, with the pass rate."""
    parts = writers.read(spark, target)
    added = parts.groupBy("window_start", "window_end", "rule_id", "kind").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return added.withColumn("value", F.col("total_passed_count") / F.col("total_record_count"))
