"""Streams fed in parts: late rows, replayed micro-batches and copies that come apart; checked against batch SQL."""

from __future__ import annotations

from assaywright.operators.storage import new_path
from assaywright.plans.table_check import TableCheck
from assaywright.sinks import writers
from assaywright.streaming import checks as C
from assaywright.streaming import copies, ledger
from pyspark.sql import functions as F

from . import sql as S
from .fixtures import table
from .registry import ORACLES, query
from .streams import ERRORS, IS_ERROR, VALUES, events_stream

PARTS = 4
#: Events come by week; a tenth of them two parts late, and those of some users lost their time.
PARTED = """select event_id, case when user_id % 7 = 0 then null else ts end as ts, user_id, event_type, value, props,
 case when user_id % 7 = 0 then event_id % 4
  else least(3, (day(ts) - 1) // 8 + case when event_id % 10 = 0 then 2 else 0 end) end as part from events"""


def parted(events):
    week = F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    untimed = F.col("user_id") % 7 == 0
    part = F.when(untimed, F.col("event_id") % 4).otherwise(F.least(F.lit(3), week))
    return events.withColumn("part", part.cast("int")).withColumn("ts", F.when(~untimed, F.col("ts")))


def feed(events, folder, part):
    """The next part of the events arrives in a folder that a stream watches."""
    events.where(F.col("part") == part).drop("part").write.mode("append").parquet(folder)


def counts(rule: str, column: str, violated: str) -> str:
    flagged = f"""select p.*, date_trunc('day', ts)::timestamp as day, {S.flag_case((column,), violated)} as flag,
 (select max(q.ts) from parted q where q.part < p.part) - interval 1 day as watermark from parted p"""
    return f"""select day as window_start, day + interval 1 day as window_end, '{rule}' as rule_id,
 case when ts is null then 'untimed' when day + interval 1 day <= watermark then 'late' else 'on_time' end as kind,
 count(*) as total_record_count, count(*) filter (where flag <> -1) as no_of_complete_records,
 count(*) filter (where flag = 0) as total_passed_count, count(*) filter (where flag <> 0) as no_of_failures,
 count(*) filter (where flag = 0) / count(*) as value from ({flagged}) f group by 1, 2, 3, 4"""


@query(
    "stream_late_rows",
    f"with parted as ({PARTED}) ({counts('R_errors', 'event_type', IS_ERROR)}) union all ({counts('R_value', 'value', 'value > 50')})",
)
def stream_late_rows(spark, sf_dir):
    """Counts of on time, late and untimed rows; the stream stops and goes on after every part."""
    folder, target, state = (new_path(spark, label) for label in ("arrivals", "windows", "stream-state"))
    events = parted(table(spark, sf_dir, "events"))
    for part in range(PARTS):
        feed(events, f"{folder}/events", part)
        stream = C.parquet_stream(spark, f"{folder}/events", events.drop("part").schema)
        ledger.count_windows(stream, [ERRORS, VALUES], "ts", target, state).awaitTermination()
    return ledger.window_counts(spark, target)


@query("stream_replay", ORACLES["stream_row_rules"])
def stream_replay(spark, sf_dir):
    """A batch run and a stream share one log; the stream is then replayed from its start."""
    log = new_path(spark, "log")
    batch = TableCheck(table(spark, sf_dir, "events"), [VALUES], S.RUN_DATE, S.BATCH)
    writers.publish_run("values", {log: batch.detail()})
    for attempt in range(2):
        failures = C.row_failures(events_stream(spark, sf_dir), [ERRORS], S.RUN_DATE, S.BATCH)
        ledger.publish_available(failures, log, new_path(spark, f"state-{attempt}"), "events").awaitTermination()
    return writers.read(spark, log).select("rule_id", "result", "rule_violation_details", "value", "value1")


@query(
    "stream_all_copies",
    """select event_id, ts, user_id, event_type, value from (select *, count(*) over
 (partition by user_id, cast(floor(value) as bigint)) as copies from events) c where copies > 1""",
)
def stream_all_copies(spark, sf_dir):
    """Events of a user with the same whole value, the first of each included, across three parts."""
    folder, target, state = (new_path(spark, label) for label in ("arrivals", "copies", "stream-state"))
    events = table(spark, sf_dir, "events").withColumn("whole", F.floor("value").cast("long"))
    events = events.withColumn("part", F.col("event_id") % 3)
    for part in range(3):
        feed(events, f"{folder}/events", part)
        stream = C.parquet_stream(spark, f"{folder}/events", events.drop("part").schema)
        found = copies.all_copies(stream, ["user_id", "whole"], "ts", "60 days")
        C.write_available(found, target, state).awaitTermination()
    return spark.read.schema(found.schema).parquet(target).select("event_id", "ts", "user_id", "event_type", "value")
