"""Streams over the events table, run to completion into parquet; checked against batch SQL."""

from __future__ import annotations

from assaywright import Compare, Rule
from assaywright.catalog.builtin import build
from assaywright.operators.storage import new_path
from assaywright.plans.table_check import TableCheck
from assaywright.sinks import writers
from assaywright.streaming import checks as C
from pyspark.sql import functions as F

from . import sql as S
from .fixtures import table
from .registry import ORACLES, query

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
#: The events with the times of some users lost.
UNTIMED = "(select * replace (case when user_id % 7 = 0 then null else ts end as ts) from events)"
ERRORS = Rule(
    "R_errors", ("event_type",), object="events", composite_columns=("event_id",),
    violation=Compare("event_type", "=", "error"),
)
VALUES = Rule("R_value", ("value",), object="events", violation=Compare("value", ">", 50))
SHAPES = build("DQ_015", "event_type", object="events")


def events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return C.parquet_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema)


def finished(stream):
    target = new_path(stream.sparkSession, "stream")
    C.write_available(stream, target).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


IS_ERROR = "lower(trim(event_type)) = 'error'"


@query(
    "stream_row_rules",
    f"""select rule_id, result, rule_violation_details, value, value1 from (
 select event_id, 'R_errors' as rule_id, {S.flag_case(("event_type",), IS_ERROR)} as result,
  {S.details_case(("event_type",), IS_ERROR, "'Condition violated: event_type = ''error'''")}
  as rule_violation_details, event_type as value, cast(event_id as varchar) as value1 from events
 union all
 select event_id, 'R_value', {S.flag_case(("value",), "value > 50")},
  {S.details_case(("value",), "value > 50", "'Condition violated: value > 50'")}, cast(value as varchar), null
 from events) f where result <> 0""",
)
def stream_row_rules(spark, sf_dir):
    failures = C.row_failures(events_stream(spark, sf_dir), [ERRORS, VALUES], S.RUN_DATE, S.BATCH)
    return finished(failures.select("rule_id", "result", "rule_violation_details", "value", "value1"))


@query(
    "stream_into_batch_log",
    ORACLES["stream_row_rules"],
)
def stream_into_batch_log(spark, sf_dir):
    """One rule checked by a batch run, the other by a stream; every row is read back."""
    batch, streamed = new_path(spark, "log"), new_path(spark, "stream-log")
    events = table(spark, sf_dir, "events")
    writers.append_log(TableCheck(events, [VALUES], S.RUN_DATE, S.BATCH).detail(), batch)
    failures = C.row_failures(events_stream(spark, sf_dir), [ERRORS], S.RUN_DATE, S.BATCH)
    C.write_available(failures, streamed, partitions=writers.LOG_PARTITIONS).awaitTermination()
    log = writers.read_log(spark, batch, streamed)
    return log.select("rule_id", "result", "rule_violation_details", "value", "value1")


def daily(rule_id: str, column: str, violated: str, events: str = "events") -> str:
    return f"""select '{rule_id}' as rule_id, day as window_start, day + interval 1 day as window_end,
 count(*) as total_record_count, count(*) filter (where flag <> -1) as no_of_complete_records,
 count(*) filter (where flag = 0) as total_passed_count, count(*) filter (where flag <> 0) as no_of_failures,
 count(*) filter (where flag = 0) / count(*) as value
 from (select date_trunc('day', ts)::timestamp as day, {S.flag_case((column,), violated)} as flag from {events} x) e
 where day + interval 1 day <= (select max(ts) from {events} y) - interval 1 day or day is null group by day"""


@query(
    "stream_daily_summary",
    " union all ".join(
        f"({daily(*part)})"
        for part in (
            ("R_errors", "event_type", IS_ERROR),
            ("R_value", "value", "value > 50"),
            ("DQ_015", "event_type", "false"),
        )
    ),
)
def stream_daily_summary(spark, sf_dir):
    return finished(C.windowed_summary(events_stream(spark, sf_dir), [ERRORS, VALUES, SHAPES], "ts"))


@query(
    "stream_null_time",
    " union all ".join(
        f"({daily(*part, UNTIMED)})" for part in (("R_errors", "event_type", IS_ERROR), ("R_value", "value", "value > 50"))
    ),
)
def stream_null_time(spark, sf_dir):
    events = events_stream(spark, sf_dir)
    events = events.withColumn("ts", F.when(F.col("user_id") % 7 != 0, F.col("ts")))
    return C.merged_windows(finished(C.windowed_summary(events, [ERRORS, VALUES], "ts")))


@query("stream_dedup", "select distinct user_id, event_type from events")
def stream_dedup(spark, sf_dir):
    kept = C.first_seen(events_stream(spark, sf_dir), ["user_id", "event_type"], "ts", "60 days")
    return finished(kept.select("user_id", "event_type"))


@query(
    "stream_duplicates",
    """select hour as window_start, event_type, user_id, count(*) as duplicate_count
 from (select *, date_trunc('day', ts)::timestamp as hour from events) e
 where hour + interval 1 day <= (select max(ts) from events) - interval 1 hour
 group by 1, 2, 3 having count(*) > 1""",
)
def stream_duplicates(spark, sf_dir):
    events = events_stream(spark, sf_dir)
    return finished(C.windowed_duplicates(events, ["event_type", "user_id"], "ts", "1 day", "1 hour"))
