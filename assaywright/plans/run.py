"""Batch runs: one table, many tables, run totals and the job log."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import bindings as B
from ..conditions import plain_fields
from ..operators.joins import SizeLimit
from ..rules import Rule
from ..sinks import writers
from ..sources import tables as source_tables
from .empty_table import empty_detail, empty_summary
from .table_check import TableCheck

JOB_LOG = (
    "Notebook_Name string, Pipeline_Name string, Layer string, System string, Sub_System string, Run_Date string,"
    " Execution_Start_Time timestamp, Execution_End_Time timestamp, Status string, Details string,"
    " Error_Message string"
)
JOB_KEYS = ("Notebook_Name", "Run_Date", "System", "Sub_System")
STATUS = "object string, rule_id string, passed boolean, error string"


@dataclass(frozen=True)
class RunSettings:
    """Everything a run needs to know besides its rules.

    ``run_name`` tells runs over one table and batch apart that are to stand side by side; without it, they do if they
    have rules of other types.
    """

    run_date: str
    summary_target: str
    detail_target: str
    load_date: int = 0
    year_id: int = 0
    sub_source: str | None = None
    layer: str = ""
    current_year: int = 0
    run_name: str = ""
    limit: SizeLimit = field(default_factory=SizeLimit)

    @property
    def year(self) -> int:
        return self.current_year or int(self.run_date[:4])


@dataclass(frozen=True)
class RuleStatus:
    object: str
    rule_id: str
    passed: bool
    error: str = ""


def unknown_columns(rule: Rule, columns: Sequence[str]) -> list[str]:
    """Columns a rule names that the table lacks; a rule that joins first is left to the analyser."""
    if rule.enrich is not None:
        return []
    known = {c.lower() for c in columns} | {"*"}
    made = {c.alias.lower() for spec in rule.aggregations for c in spec.calculations}
    named = [*rule.columns, *(rule.composite_columns or ())]
    named += [c for spec in rule.aggregations for c in spec.group_by]
    named += sorted((plain_fields(rule.violation) or set()) | ((plain_fields(rule.having) or set()) - made))
    return [c for c in dict.fromkeys(named) if c.lower() not in known]


def usable_rules(df: DataFrame, rules: Sequence[Rule], settings: RunSettings, tables=None):
    """Rules whose plan analyses against the table, and a status for each of the others.

    Analysis reads no data; a rule naming a missing column or table fails here
    and does not disturb the rest.
    """
    kept, statuses = [], []
    for rule in rules:
        unknown = unknown_columns(rule, df.columns)
        if unknown:
            message = f"columns not in the table: {', '.join(unknown)}"
            statuses.append(RuleStatus(rule.object, rule.rule_id, False, message))
            continue
        try:
            trial = TableCheck(df.limit(0), [rule], settings.run_date, settings.load_date, tables=tables)
            trial.flags(rule)
            trial.release()
            kept.append(rule)
        except (PySparkException, ValueError, AttributeError, KeyError) as error:
            statuses.append(RuleStatus(rule.object, rule.rule_id, False, str(error)))
    return kept, statuses


def run_table(
    df: DataFrame,
    rules: Sequence[Rule],
    settings: RunSettings,
    place: Mapping[str, str] | None = None,
    composite_columns: Sequence[str] = (),
    tables=None,
) -> list[RuleStatus]:
    """Check one table and publish both logs together; the returned statuses tell what ran.

    A rerun (same table, batch and kind of rules) replaces what it published before, in both logs.
    """
    sliced = source_tables.slice_table(df, settings.load_date, settings.year_id, settings.sub_source)
    if place is None:
        first = rules[0]
        place = {
            "object": first.object, "system": first.system, "sub_system": first.sub_system, "domain": first.domain,
        }
    run = run_id(place, rules, settings)
    if sliced.isEmpty():
        about = (dict(place), settings.load_date, settings.run_date, settings.layer)
        empty = empty_detail(sliced, about[0], composite_columns, *about[1:])
        writers.publish_run(run, {settings.detail_target: empty, settings.summary_target: empty_summary(sliced, *about)})
        return [RuleStatus(place["object"], "DQ_000", True)]
    kept, statuses = usable_rules(sliced, rules, settings, tables)
    if kept:
        slices = (settings.load_date or None, settings.year_id or None)
        check = TableCheck(sliced, kept, settings.run_date, *slices, tables, settings.limit)
        try:
            logs = {settings.detail_target: check.detail(settings.layer), settings.summary_target: check.summary(settings.layer)}
            writers.publish_run(run, logs)
        finally:
            check.release()
    return statuses + [RuleStatus(rule.object, rule.rule_id, True) for rule in kept]


def run_id(place: Mapping[str, str], rules: Sequence[Rule], settings: RunSettings) -> str:
    """What a rerun has in common with the run before: table, slice, layer, and the name or the rule types."""
    kinds = settings.run_name or sorted({rule.rule_type for rule in rules})
    about = [place[k] for k in ("object", "system", "sub_system", "domain")]
    whole = json.dumps([about, settings.load_date, settings.year_id, settings.sub_source, settings.layer, kinds])
    return hashlib.sha256(whole.encode()).hexdigest()[:24]


def run_bindings(
    spark: SparkSession,
    rules: DataFrame,
    bindings: DataFrame,
    settings: RunSettings,
    tables: Mapping[str, DataFrame] | None = None,
    thresholds: DataFrame | None = None,
    custom: Mapping[str, Callable[..., Rule]] | None = None,
) -> list[RuleStatus]:
    """Check every table the (selected) bindings name; a failing table does not stop the others."""
    chosen = B.accepted(bindings)
    if thresholds is not None:
        rules = B.with_thresholds(rules, thresholds)
    bound = B.expanded(B.bound_rules(rules, chosen))
    by_table: dict = {}
    for row in bound.collect():
        by_table.setdefault((row["database_name"], row["table_name"]), []).append(row)
    statuses: list[RuleStatus] = []
    for target in B.target_tables(chosen).collect():
        name, database = target["table_name"], target["database_name"]
        rows = by_table.get((database, name), [])
        full = f"{database}.{name}"
        place = {
            "object": name, "system": target["system"], "sub_system": target["sub_system"], "domain": target["domain"],
        }
        keys = [c.strip() for c in (target["composite_columns"] or "").split(",") if c.strip()]
        try:
            typed = []
            for row in rows:  # one unusable binding costs only itself
                try:
                    typed += B.to_rules([row], settings.year, custom)
                except Exception as error:
                    statuses.append(RuleStatus(name, row["rule_id"], False, str(error) or type(error).__name__))
            df = tables[full] if tables and full in tables else source_tables.read_table(spark, full)
            statuses += run_table(df, typed, settings, place, keys, tables)
        except Exception as error:  # a table's failure is recorded, the run goes on
            message = str(error) or type(error).__name__
            statuses += [RuleStatus(name, row["rule_id"], False, message) for row in rows] or [
                RuleStatus(name, "", False, message)
            ]
    return statuses


def status_frame(spark: SparkSession, statuses: Sequence[RuleStatus]) -> DataFrame:
    return spark.createDataFrame([(s.object, s.rule_id, s.passed, s.error) for s in statuses], STATUS)


def run_totals(statuses: DataFrame) -> DataFrame:
    """Rules that ran and rules that could not, per table and in total (``object`` NULL)."""
    return statuses.rollup("object").agg(
        F.count_if(F.col("passed")).alias("passed_rules"), F.count_if(~F.col("passed")).alias("failed_rules")
    )


def log_job(
    spark: SparkSession,
    target: str,
    job: Mapping[str, str],
    status: str,
    details: str,
    started: datetime,
    ended: datetime | None = None,
    error: str | None = None,
) -> None:
    """Upsert one job-log row; the start time is the caller's, so later writes keep it.

    A key the job does not name is empty, not NULL, which would match no earlier row.
    """
    names = ("Notebook_Name", "Pipeline_Name", "Layer", "System", "Sub_System", "Run_Date")
    row = tuple(job.get(n) or ("" if n in JOB_KEYS else None) for n in names) + (started, ended, status, details, error)
    writers.merge_upsert(spark.createDataFrame([row], JOB_LOG), target, JOB_KEYS)


def run_job(
    spark: SparkSession,
    rules: DataFrame,
    bindings: DataFrame,
    settings: RunSettings,
    job_target: str,
    job: Mapping[str, str],
    tables: Mapping[str, DataFrame] | None = None,
    now=datetime.now,
    **configuration,
) -> list[RuleStatus]:
    """A whole logged run: Running, then Success, Failed or Failed with the error."""
    started = now()
    about = {**job, "Run_Date": settings.run_date, "Layer": settings.layer}
    log_job(spark, job_target, about, "Running", "Execution started.", started)
    try:
        statuses = run_bindings(spark, rules, bindings, settings, tables, **configuration)
    except Exception as error:
        log_job(spark, job_target, about, "Failed", "Execution failed.", started, now(), str(error))
        raise
    if not statuses:
        log_job(spark, job_target, about, "Success", "No rules selected.", started, now())
        return statuses
    passed = sum(s.passed for s in statuses)
    failed = len(statuses) - passed
    details = f"Execution completed: total_passed_rules = {passed}, total_failed_rules = {failed}"
    log_job(spark, job_target, about, "Failed" if failed else "Success", details, started, now())
    return statuses
