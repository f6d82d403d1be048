"""Summary and detail logs, empty tables, keys, slices and whole runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from assaywright import Compare, Reference, Rule
from assaywright.catalog import values as V
from assaywright.catalog.builtin import build
from assaywright.functions import keys as K
from assaywright.functions.text import as_text
from assaywright.operators.storage import new_path
from assaywright.plans import run as R
from assaywright.plans.empty_table import empty_detail, empty_summary
from assaywright.plans.table_check import TableCheck
from assaywright.sinks import writers
from assaywright.sources import config
from assaywright.sources.tables import read_table, slice_sub_source, text_table

from . import sql as S
from .fixtures import CUSTOMER_DIRTY, ORDERS_DIRTY, duck, from_sql, table
from .registry import add, query

ABOUT = {"object": "customer_dirty", "system": "services", "sub_system": "NQC", "domain": "People"}
KEYS = ("c_custkey", "year_id")
CUSTOMER_COLUMNS = (
    "c_custkey", "c_nationkey", "load_date", "year_id", "sub_source", "segment_raw", "email_raw", "phone_raw",
    "gender_raw", "national_id_raw", "dob_raw", "name_raw",
)
CUSTOMER_BASE = f"select *, load_date as batch_id from ({duck(CUSTOMER_DIRTY)}) c"

SEGMENT = build("DQ_001", "segment_raw", composite_columns=KEYS, **ABOUT)
EMAIL = build("DQ_012", "email_raw", composite_columns=KEYS, critical_attribute="yes", **ABOUT)
GENDER = build("DQ_014", "gender_raw", composite_columns=(), **ABOUT)
PHONE_AGAIN = build("DQ_005", "phone_raw", composite_columns=KEYS, **ABOUT)
NAME_KNOWN = build("DQ_003", "name_raw", reference=Reference("customer", ("c_name",)), **ABOUT)
RULES = (SEGMENT, EMAIL, GENDER, PHONE_AGAIN, NAME_KNOWN)

COPIES = f"count(*) filter (where not {S.missing('phone_raw')}) over (partition by phone_raw)"
SOURCE = f"select *, {COPIES} as copies from ({CUSTOMER_BASE}) b"
UNKNOWN_NAME = "not exists (select 1 from customer k where upper(trim(k.c_name)) = upper(trim(name_raw)))"
CHECKS = {
    SEGMENT: ("segment_raw", "false", "''"),
    EMAIL: ("email_raw", S.no_match("email_raw", V.EMAIL), S.regex_text("email_raw", V.EMAIL)),
    GENDER: ("gender_raw", S.not_in("gender_raw", V.GENDERS), S.in_text("gender_raw", V.GENDERS)),
    PHONE_AGAIN: ("phone_raw", "copies > 1", S.quoted("Condition violated: duplicate_count > 1")),
    NAME_KNOWN: ("name_raw", UNKNOWN_NAME, S.quoted("Consistency check failed for columns: name_raw")),
}


def customer_check(spark, sf_dir, rules=RULES) -> TableCheck:
    dirty = from_sql(spark, sf_dir, CUSTOMER_DIRTY)
    return TableCheck(dirty, rules, S.RUN_DATE, tables={"customer": table(spark, sf_dir, "customer")})


def summary_sql(rules) -> str:
    parts = [S.summary_row(SOURCE, r, S.flag_case((CHECKS[r][0],), CHECKS[r][1])) for r in rules]
    return " union all ".join(f"({p})" for p in parts)


def detail_sql(rules) -> str:
    parts = []
    for rule in rules:
        column, violated, text = CHECKS[rule]
        extra = {"extra": ", duplicate_count := copies", "missing_extra": ", duplicate_count := 0"}
        parts.append(
            S.detail_rows(
                SOURCE, rule, CUSTOMER_COLUMNS, S.flag_case((column,), violated),
                S.details_case((column,), violated, text), **(extra if rule is PHONE_AGAIN else {}),
            )
        )
    return " union all ".join(f"({p})" for p in parts)


add("completeness_customer", lambda s, d: customer_check(s, d, [SEGMENT]).summary(), summary_sql([SEGMENT]))
add("summary_log", lambda s, d: customer_check(s, d).summary(), summary_sql(RULES))
add("detail_log", lambda s, d: customer_check(s, d).detail(), detail_sql(RULES))

LINE_RULES = [
    build("DQ_001", "l_returnflag", object="lineitem"),
    build("DQ_002", "l_quantity", object="lineitem"),
    build("whole_number", "l_linenumber", object="lineitem"),
    build("DQ_006", "l_extendedprice", object="lineitem"),
    build("DQ_009", "l_shipdate", object="lineitem"),
    build("DQ_010", "l_shipdate", object="lineitem"),
    build("DQ_011", "l_linestatus", object="lineitem"),
    build("DQ_015", "l_returnflag", object="lineitem"),
    Rule("R_low", ("l_discount",), object="lineitem", violation=Compare("l_discount", ">", 0.08)),
    Rule("R_tax", ("l_tax",), object="lineitem", violation=Compare("l_tax", "=", 0)),
]
LINE_BASE = f"select *, cast(null as int) as year_id, {S.BATCH} as batch_id from lineitem"
LINE_TESTS = [
    "false", S.no_match("l_quantity", V.DECIMAL_NUMBER), S.no_match("l_linenumber", V.WHOLE_NUMBER),
    S.no_match("l_extendedprice", V.DECIMAL_NUMBER), S.no_match("l_shipdate", V.DATE_SIMPLE),
    S.no_match("l_shipdate", V.DATE_TIME_ISO), S.no_match("l_linestatus", V.ALPHANUMERIC),
    S.no_match("l_returnflag", V.ENGLISH_TEXT), "l_discount > 0.08", "l_tax = 0",
]


add(
    "single_pass_lineitem",
    lambda s, d: TableCheck(table(s, d, "lineitem"), LINE_RULES, S.RUN_DATE, S.BATCH).summary(),
    " union all ".join(
        f"({S.summary_row(LINE_BASE, r, S.flag_case(r.columns, t))})" for r, t in zip(LINE_RULES, LINE_TESTS)
    ),
)


@query(
    "summary_detail_reconcile",
    f"""select {", ".join(f"{S.quoted(r.rule_id)} as rule_id" for r in [SEGMENT])}, year_id, n as no_of_failures,
 n as detail_rows, true as agrees from (select year_id, count(*) as n from ({CUSTOMER_BASE}) b
 where {S.missing("segment_raw")} group by year_id) x
 union all select 'DQ_012', year_id, n, n, true from (select year_id, count(*) as n from ({CUSTOMER_BASE}) b
 where {S.flag_case(("email_raw",), S.no_match("email_raw", V.EMAIL))} <> 0 group by year_id) x""",
)
def reconcile(spark, sf_dir):
    check = customer_check(spark, sf_dir, [SEGMENT, EMAIL])
    listed = check.detail().groupBy("unique_key").agg(F.count(F.lit(1)).alias("detail_rows"))
    both = check.summary().join(listed, "unique_key", "left")
    agrees = (F.col("no_of_failures") == F.col("detail_rows")).alias("agrees")
    return both.select("rule_id", "year_id", "no_of_failures", "detail_rows", agrees)


EMPTY_WHERE = "c_acctbal < -1000000"
EMPTY_BASE = f"select count(*) as n from customer where {EMPTY_WHERE}"
PLACE = {"object": "overdrawn", "system": "services", "sub_system": "NQC", "domain": "People"}
EMPTY_KEY = (
    f"sha256(concat_ws('-', 'DQ_000', 'completeness', 'overdrawn', 'All Columns', '{S.BATCH}', '{S.RUN_DATE}',"
    " 'services', 'NQC', 'People'))"
)


@query(
    "empty_table_summary",
    f"""select {EMPTY_KEY} as unique_key, 'overdrawn' as object, 'All Columns' as attribute_name,
 'completeness' as dimension, 'DQ_000' as rule_id, 'Data Quality' as rule_type, 'services' as system,
 'NQC' as sub_system, 'People' as domain, 'Table Empty Check' as applied_rule, 'Table has no data' as rule_description,
 n as total_record_count, n as no_of_complete_records, n as total_passed_count, n + 1 as no_of_failures,
 cast(0 as double) as value, cast(null as int) as year_id, {S.BATCH} as batch_id,
 cast('{S.RUN_DATE}' as timestamp) as rule_run_date from ({EMPTY_BASE}) e where n = 0""",
)
def empty_summary_query(spark, sf_dir):
    empty = table(spark, sf_dir, "customer").where(EMPTY_WHERE)
    return empty_summary(empty, PLACE, S.BATCH, S.RUN_DATE)


@query(
    "empty_table_detail",
    f"""select {EMPTY_KEY} as unique_key, 'DQ_000' as rule_id, 'completeness' as dimension, 'overdrawn' as object,
 'All Columns' as attribute_name, cast(null as int) as year_id, {S.BATCH} as batch_id,
 cast('{S.RUN_DATE}' as timestamp) as rule_run_date, 'services' as system, 'NQC' as sub_system, 'People' as domain,
 'Data Quality' as rule_type, 'Table Empty Check' as applied_rule, 'Table has no data' as rule_description,
 '{{"message": "Table is empty"}}' as rule_json, 'completeness' as category, '' as critical_attribute,
 '' as model_integrity, '{{}}' as source_table_attributes, 1 as result, 'Table is empty' as rule_violation_details,
 '' as value, 'c_custkey-c_name' as key_columns, '' as values_of_key_columns, 'c_custkey' as key1, '' as value1,
 'c_name' as key2, '' as value2, '' as key3, '' as value3, '' as key4, '' as value4
 from ({EMPTY_BASE}) e where n = 0""",
)
def empty_detail_query(spark, sf_dir):
    empty = table(spark, sf_dir, "customer").where(EMPTY_WHERE)
    return empty_detail(empty, PLACE, ("c_custkey", " c_name"), S.BATCH, S.RUN_DATE)


@query(
    "key_unpack",
    """select 'c_custkey-segment_raw-email_raw' as key_columns,
 concat_ws('||', trim(cast(c_custkey as varchar)), trim(segment_raw), trim(email_raw)) as values_of_key_columns,
 cast(c_custkey as varchar) as value1, lower(segment_raw) as value2, segment_raw as value2_as_is,
 lower(email_raw) as value3, cast(null as varchar) as value4 from (""" + duck(CUSTOMER_DIRTY) + ") c",
)
def key_unpack(spark, sf_dir):
    rows = as_text(from_sql(spark, sf_dir, CUSTOMER_DIRTY))
    keys = ("c_custkey", "segment_raw", "email_raw")
    return rows.select(
        F.lit(K.key_names(keys)).alias("key_columns"),
        K.key_values(keys).alias("values_of_key_columns"),
        K.key_value_at(keys, 0, lower=True).alias("value1"),
        K.key_value_at(keys, 1, lower=True).alias("value2"),
        K.key_value_at(keys, 1).alias("value2_as_is"),
        K.key_value_at(keys, 2, lower=True).alias("value3"),
        K.key_value_at(keys, 3, lower=True).alias("value4"),
    )


ORDER_COLUMNS = ("o_orderkey", "custkey_raw", "date_raw", "number_raw", "status_raw", "o_totalprice")


@query(
    "record_image",
    f"select cast(o_orderkey as varchar) as o_orderkey, {S.image(ORDER_COLUMNS)} as image"
    f" from ({duck(ORDERS_DIRTY)}) o",
)
def record_image(spark, sf_dir):
    rows = as_text(from_sql(spark, sf_dir, ORDERS_DIRTY))
    return rows.select("o_orderkey", K.record_image(ORDER_COLUMNS).alias("image"))


# -- slices --------------------------------------------------------------------------------

TEXT_COLUMNS = ", ".join(f"cast({c} as varchar) as {c}" for c in CUSTOMER_COLUMNS)


@query(
    "batch_slice",
    f"select {TEXT_COLUMNS} from ({duck(CUSTOMER_DIRTY)}) c where load_date = 20241225 and year_id = 2021",
)
def batch_slice(spark, sf_dir):
    return text_table(from_sql(spark, sf_dir, CUSTOMER_DIRTY), load_date=20241225, year_id=2021)


@query("sub_source_slice", f"select * from ({duck(CUSTOMER_DIRTY)}) c where upper(sub_source) = 'NORTH'")
def sub_source_slice(spark, sf_dir):
    return slice_sub_source(from_sql(spark, sf_dir, CUSTOMER_DIRTY), "North")


@query(
    "sub_source_fallback",
    f"select * replace (cast(null as varchar) as sub_source) from ({duck(CUSTOMER_DIRTY)}) c",
)
def sub_source_fallback(spark, sf_dir):
    return slice_sub_source(from_sql(spark, sf_dir, CUSTOMER_DIRTY), "west")


@query(
    "text_view",
    "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")) + " from lineitem",
)
def text_view(spark, sf_dir):
    return as_text(table(spark, sf_dir, "lineitem"))


# -- written logs and whole runs ---------------------------------------------------------------

LAYERED = "select *, 'bronze' as lakehouse_layer from ({}) r"


@query("log_roundtrip_summary", LAYERED.format(summary_sql(RULES)))
def log_roundtrip_summary(spark, sf_dir):
    target = new_path(spark, "summary")
    writers.append_log(customer_check(spark, sf_dir).summary("bronze"), target)
    return spark.read.parquet(target)


@query("log_roundtrip_detail", LAYERED.format(detail_sql(RULES)))
def log_roundtrip_detail(spark, sf_dir):
    target = new_path(spark, "detail")
    writers.append_log(customer_check(spark, sf_dir).detail("bronze"), target)
    return spark.read.parquet(target)


@query(
    "batch_run",
    LAYERED.format(
        " union all ".join(
            f"({S.summary_row(SOURCE, r, S.flag_case((CHECKS[r][0],), CHECKS[r][1]))})" for r in (SEGMENT, EMAIL)
        )
    ),
)
def batch_run(spark, sf_dir):
    settings = R.RunSettings(
        S.RUN_DATE, new_path(spark, "summary"), new_path(spark, "detail"), load_date=S.BATCH, layer="bronze"
    )
    broken = build("DQ_001", "no_such_column", **ABOUT)
    R.run_table(from_sql(spark, sf_dir, CUSTOMER_DIRTY), [SEGMENT, EMAIL, broken], settings)
    return spark.read.parquet(settings.summary_target)


@query(
    "run_totals",
    """select 'c' || c_mktsegment as object, count(*) filter (where c_acctbal >= 0) as passed_rules,
 count(*) filter (where c_acctbal < 0) as failed_rules from customer group by 1
 union all select null, count(*) filter (where c_acctbal >= 0), count(*) filter (where c_acctbal < 0) from customer""",
)
def run_totals(spark, sf_dir):
    statuses = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_mktsegment")).alias("object"), (F.col("c_acctbal") >= 0).alias("passed")
    )
    return R.run_totals(statuses)


@query("anomalies_only", S.row_check(duck(ORDERS_DIRTY), "o_orderkey", "number_raw", "number_raw",
       S.no_match("number_raw", V.DECIMAL_NUMBER), S.regex_text("number_raw", V.DECIMAL_NUMBER))
       + " where rule_violation_flag <> 0")
def anomalies_only(spark, sf_dir):
    check = TableCheck(from_sql(spark, sf_dir, ORDERS_DIRTY), [], S.RUN_DATE)
    flags = check.flags(build("DQ_006", "number_raw"))
    return writers.anomalies_only(flags, True).select(
        F.col("o_orderkey").alias("row_key"), F.col("number_raw").alias("checked_value"), "rule_violation_flag",
        "rule_violation_details",
    )


# Two tables, three rules each way a binding can be read, and one table that does not exist.
BOUND = (
    ("DQ_001", "customer_dirty", "segment_raw, email_raw", "c_custkey"),
    ("DQ_012", "customer_dirty", "email_raw", "c_custkey"),
    ("DQ_006", "orders_dirty", "number_raw", "o_orderkey"),
    ("DQ_009", "orders_dirty", "date_raw", "o_orderkey"),
    ("DQ_001", "no_such_table", "a", ""),
)
RUN_BASES = {
    "customer_dirty": CUSTOMER_BASE,
    "orders_dirty": f"select *, cast(null as int) as year_id, {S.BATCH} as batch_id from ({duck(ORDERS_DIRTY)}) o",
}
RUN_TESTS = {
    "DQ_001": lambda c: "false",
    "DQ_012": lambda c: S.no_match(c, V.EMAIL),
    "DQ_006": lambda c: S.no_match(c, V.DECIMAL_NUMBER),
    "DQ_009": lambda c: S.no_match(c, V.DATE_SIMPLE),
}


def run_parts():
    for rule_id, name, columns, _ in BOUND:
        for column in columns.split(","):
            if name in RUN_BASES:
                place = {"object": name, "system": "services", "sub_system": "NQC", "domain": "All"}
                rule = build(rule_id, column.strip(), **place)
                yield S.summary_row(RUN_BASES[name], rule, S.flag_case(rule.columns, RUN_TESTS[rule_id](column.strip())))


@query("multi_table_run", LAYERED.format(" union all ".join(f"({part})" for part in run_parts())))
def multi_table_run(spark, sf_dir):
    """Configuration tables to logs over several tables; the absent one does not stop the others."""
    rules = spark.createDataFrame(
        [(rule_id, "Data Quality", "ALL", "ALL", "ALL") for rule_id in sorted({b[0] for b in BOUND})],
        "rule_id string, rule_type string, system string, sub_system string, domain string",
    )
    rows = [
        (rule_id, "Data Quality", "services", "NQC", "All", "lake", name, columns, keys, None, None, None, None, None, 1, 1)
        for rule_id, name, columns, keys in BOUND
    ]
    settings = R.RunSettings(
        S.RUN_DATE, new_path(spark, "summary"), new_path(spark, "detail"), load_date=S.BATCH, layer="bronze"
    )
    tables = {
        "lake.customer_dirty": from_sql(spark, sf_dir, CUSTOMER_DIRTY),
        "lake.orders_dirty": from_sql(spark, sf_dir, ORDERS_DIRTY),
    }
    bindings = spark.createDataFrame(rows, config.BINDINGS)
    statuses = R.run_bindings(spark, rules, bindings, settings, tables)
    if {s.object for s in statuses if not s.passed} != {"no_such_table"}:
        raise ValueError(f"unexpected statuses: {statuses}")
    return spark.read.parquet(settings.summary_target)


# -- runs that are repeated or fail -------------------------------------------------------------

RERUN = (SEGMENT, EMAIL)
RERUN_SQL = LAYERED.format(" union all ".join(f"({S.summary_row(SOURCE, r, S.flag_case((CHECKS[r][0],), CHECKS[r][1]))})" for r in RERUN))


def new_settings(spark, run_date=S.RUN_DATE):
    return R.RunSettings(run_date, new_path(spark, "summary"), new_path(spark, "detail"), load_date=S.BATCH, layer="bronze")


def run_again(spark, sf_dir):
    """Two runs over one batch, the first on another day and with more rules: only the second is in the logs."""
    first = new_settings(spark, "2026-01-14 23:00:00")
    second = replace(first, run_date=S.RUN_DATE)
    rows = from_sql(spark, sf_dir, CUSTOMER_DIRTY)
    R.run_table(rows, [*RERUN, GENDER], first)
    R.run_table(rows, list(RERUN), second)
    return second


@query("run_twice", RERUN_SQL)
def run_twice(spark, sf_dir):
    return writers.read_log(spark, run_again(spark, sf_dir).summary_target)


@query("run_detail", LAYERED.format(detail_sql(RERUN)))
def run_detail(spark, sf_dir):
    return writers.read_log(spark, run_again(spark, sf_dir).detail_target)


@query("run_after_crash", RERUN_SQL)
def run_after_crash(spark, sf_dir):
    """A run, then one that fails once its details are written and before its summary is: both logs are as before."""
    settings = new_settings(spark)
    rows = from_sql(spark, sf_dir, CUSTOMER_DIRTY)
    R.run_table(rows, list(RERUN), settings)
    before = writers.read_log(spark, settings.detail_target).count()
    check = customer_check(spark, sf_dir, [GENDER])
    broken = check.summary("bronze").withColumn("value", F.raise_error(F.lit("lost")).cast("double"))
    run = R.run_id(ABOUT, list(RERUN), settings)
    try:
        writers.publish_run(run, {settings.detail_target: check.detail("bronze"), settings.summary_target: broken})
    except Exception as error:
        if "lost" not in str(error):
            raise
    if writers.read_log(spark, settings.detail_target).count() != before:
        raise ValueError("the failed run left details")
    return writers.read_log(spark, settings.summary_target)


@query("run_isolation", RERUN_SQL)
def run_isolation(spark, sf_dir):
    """Rules that cannot run, for a missing column or a missing reference table, do not disturb the others."""
    settings = new_settings(spark)
    bad = [build("DQ_001", "no_such_column", **ABOUT), build("DQ_003", "name_raw", reference=Reference("no_such_table", ("c",)), **ABOUT)]
    statuses = R.run_table(from_sql(spark, sf_dir, CUSTOMER_DIRTY), [bad[0], SEGMENT, bad[1], EMAIL], settings)
    if [s.passed for s in statuses] != [False, False, True, True]:
        raise ValueError(f"unexpected statuses: {statuses}")
    return writers.read_log(spark, settings.summary_target)


@query(
    "job_log",
    """select 'segment ' || c_mktsegment as Notebook_Name, cast(null as varchar) as Pipeline_Name, 'bronze' as Layer,
 'services' as System, '' as Sub_System, '2026-01-15' as Run_Date, timestamp '2026-01-15 08:00:00' as Execution_Start_Time,
 timestamp '2026-01-15 09:00:00' as Execution_End_Time, case when min(c_acctbal) < 0 then 'Failed' else 'Success' end as Status,
 'customers = ' || count(*) as Details, cast(null as varchar) as Error_Message from customer group by c_mktsegment""",
)
def job_log(spark, sf_dir):
    """One logged job per market segment: Running first, then the outcome in the same row."""
    target = new_path(spark, "jobs")
    started, ended = datetime(2026, 1, 15, 8), datetime(2026, 1, 15, 9)
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.min("c_acctbal").alias("least"))
    for segment, n, least in counts.collect():
        job = {"Notebook_Name": f"segment {segment}", "Layer": "bronze", "System": "services", "Run_Date": "2026-01-15"}
        R.log_job(spark, target, job, "Running", "Execution started.", started)
        R.log_job(spark, target, job, "Failed" if least < 0 else "Success", f"customers = {n}", started, ended)
    return writers.read(spark, target)


@query("catalog_table", "select l_orderkey, l_linenumber, l_returnflag from lineitem")
def catalog_table(spark, sf_dir):
    """A table of the catalog, overwritten in one change, read by its name."""
    name = f"lines_{new_path(spark, 'x')[-12:]}"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    writers.create_if_absent(lines, name)
    writers.overwrite(lines.limit(10), name)
    writers.overwrite(lines, name)
    return read_table(spark, f"default.{name}")
