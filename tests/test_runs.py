from datetime import datetime

import pytest

from assaywright import Compare, Param, Rule
from assaywright.catalog import bindings as B
from assaywright.catalog.builtin import build
from assaywright.plans import run as R
from assaywright.plans.table_check import TableCheck
from assaywright.sinks import writers
from assaywright.sources import config
from assaywright.sources.tables import slice_table, text_table

RUN = "2026-01-15 08:30:00"
RULE = "rule_id string, rule_name string, rule_description string, rule_type string, system string, sub_system string, domain string, is_active int"
BINDING = config.BINDINGS


def binding(rule_id, table, columns, keys=None, ref=(None, None, None), system="S", sub="X", domain="D", critical=None):
    return (rule_id, "Data Quality", system, sub, domain, "lake", table, columns, keys, *ref, critical, None, 1, 1)


@pytest.fixture
def settings(tmp_path):
    return R.RunSettings(
        RUN, str(tmp_path / "summary"), str(tmp_path / "detail"), load_date=20240101, layer="bronze", current_year=2026
    )


@pytest.fixture
def rules(frame):
    ids = ("DQ_001", "DQ_003", "DQ_005", "DQ_010", "DQ_012")
    return frame(RULE, *[(i, f"name {i}", f"text {i}", "Data Quality", "ALL", "ALL", "ALL", 1) for i in ids])


@pytest.fixture
def tables(frame):
    people = frame(
        "id int, name string, mail string, load_date int", (1, "a", "x@y.org", 20240101), (1, None, "bad", 20240101),
        (2, "b", "u@v.co", 20240102),
    )
    return {"lake.people": people, "lake.nothing": frame("id int, load_date int"), "lake.codes": frame("c string", ("A",))}


def test_whole_job(spark, frame, rules, tables, settings, tmp_path):
    bindings = frame(
        BINDING,
        binding("DQ_001", "people", "name,mail", "id"), binding("DQ_012", "people", "mail", "id"),
        binding("DQ_001", "people", "NAME", "id"), binding("DQ_005", "people", "id", "id"),
        binding("DQ_003", "people", "name", "id", ("lake", "codes", "c")), binding("DQ_010", "people", "no_column"),
        binding("DQ_001", "nothing", "id", "id,load_date"), binding("DQ_001", "absent", "id"),
        binding("DQ_003", "people", "name"),
    )
    log = str(tmp_path / "jobs")
    job = {"Notebook_Name": "nb", "Pipeline_Name": "p", "System": "S", "Sub_System": "X"}
    clock = iter([datetime(2026, 1, 15, 8), datetime(2026, 1, 15, 9)])
    statuses = R.run_job(spark, rules, bindings, settings, log, job, tables, lambda: next(clock))
    failed = {(s.object, s.rule_id) for s in statuses if not s.passed}
    assert failed == {("people", "DQ_010"), ("absent", "DQ_001")}
    summary = {(r["object"], r["rule_id"], r["attribute_name"]): r for r in spark.read.parquet(settings.summary_target).collect()}
    assert set(summary) == {
        ("people", "DQ_001", "name"), ("people", "DQ_001", "mail"), ("people", "DQ_012", "mail"),
        ("people", "DQ_005", "id"), ("people", "DQ_003", "name"), ("nothing", "DQ_000", "All Columns"),
    } or set(summary) == {
        ("people", "DQ_001", "NAME"), ("people", "DQ_001", "mail"), ("people", "DQ_012", "mail"),
        ("people", "DQ_005", "id"), ("people", "DQ_003", "name"), ("nothing", "DQ_000", "All Columns"),
    }
    assert summary[("people", "DQ_005", "id")]["no_of_failures"] == 2
    assert summary[("people", "DQ_012", "mail")]["applied_rule"] == "name DQ_012"
    assert summary[("people", "DQ_012", "mail")]["batch_id"] == 20240101
    detail = spark.read.parquet(settings.detail_target)
    assert detail.where("object = 'nothing'").first()["key2"] == "load_date"
    assert detail.where("rule_id = 'DQ_005'").count() == 2
    jobs = spark.read.parquet(log).collect()
    assert len(jobs) == 1 and jobs[0]["Status"] == "Failed"
    assert jobs[0]["Execution_Start_Time"] == datetime(2026, 1, 15, 8)
    assert jobs[0]["Execution_End_Time"] == datetime(2026, 1, 15, 9)
    assert jobs[0]["Details"].endswith(f"total_passed_rules = {len(statuses) - 2}, total_failed_rules = 2")
    totals = {r["object"]: (r["passed_rules"], r["failed_rules"]) for r in R.run_totals(R.status_frame(spark, statuses)).collect()}
    assert totals["people"] == (5, 1) and totals[None] == (len(statuses) - 2, 2)
    rejected = B.rejected(bindings).collect()
    assert [r["reject_reason"] for r in rejected] == [
        "Reference fields are missing: reference_database, reference_table_name, reference_columns, for people"
    ]


def test_job_error_is_logged_and_raised(spark, frame, rules, settings, tmp_path):
    log = str(tmp_path / "jobs")
    job = {"Notebook_Name": "nb", "System": "S", "Sub_System": "X"}
    with pytest.raises(Exception):
        R.run_job(spark, rules, frame("wrong int", (1,)), settings, log, job)
    row = spark.read.parquet(log).first()
    assert row["Status"] == "Failed" and row["Error_Message"]


def test_rerun_replaces_its_batch(spark, tables, settings):
    rule = build("DQ_001", "name", object="people", system="S", sub_system="X", domain="D")
    check = R.TableCheck(tables["lake.people"], [rule], RUN)
    writers.append_log(check.summary(), settings.summary_target)
    writers.replace_batches(check.summary().where("batch_id = 20240101"), settings.summary_target)
    assert spark.read.parquet(settings.summary_target).count() == 2


def test_catalog_tables(spark, frame):
    old = frame("k string, v int", ("a", 1), (None, 2))
    assert writers.create_if_absent(old, "merge_target") and not writers.create_if_absent(old, "merge_target")
    writers.append_absent(old, "merge_target", ["k"])
    writers.append_absent(frame("k string, v int", ("a", 9), (None, 9), ("b", 3)), "merge_target", ["k"])
    assert sorted(map(tuple, spark.table("merge_target").collect()), key=repr) == [("a", 1), ("b", 3), (None, 2)]
    writers.merge_upsert(frame("k string, v int", ("a", 7), ("c", 4)), "merge_target", ["k"])
    assert sorted(r["v"] for r in spark.table("merge_target").collect()) == [2, 3, 4, 7]
    writers.merge_delete_insert(frame("k string, v int", (None, 5), ("c", 6)), "merge_target", ["k"])
    assert sorted(r["v"] for r in spark.table("merge_target").collect()) == [3, 5, 6, 7]
    writers.overwrite(old, "merge_target")
    assert spark.table("merge_target").count() == 2


def test_log_table_in_the_catalog(spark, tables):
    check = R.TableCheck(tables["lake.people"], [build("DQ_001", "name", system="S", sub_system="X")], RUN)
    writers.append_log(check.summary("bronze"), "summary_log_table")
    writers.append_log(check.summary("bronze"), "summary_log_table")
    assert spark.table("summary_log_table").count() == 4
    writers.replace_batches(check.summary("bronze").where("batch_id = 20240101"), "summary_log_table")
    assert spark.table("summary_log_table").count() == 3


def test_slices_reach_the_scan(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    df = frame("a string, load_date int, year_id int", ("x", 1, 2020), ("y", 1, 2021), ("z", 2, 2020))
    df.write.partitionBy("load_date").parquet(path)
    sliced = text_table(spark.read.parquet(path), load_date=1, year_id=2020)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "EqualTo(year_id,2020)" in plan
    assert [r["a"] for r in sliced.collect()] == ["x"]
    assert slice_table(frame("a string", ("x",))).columns == ["a", "year_id"]


def test_configuration_files(spark, tmp_path):
    path = tmp_path / "rules.csv"
    head = ",".join(part.split()[0] for part in config.RULES.split(","))
    text = f'{head}\nDQ_001,ALL,Null,Completeness,ALL,ALL,"Say ""no"", please",1,x.json,1,1,Data Quality\n'
    path.write_text("﻿" + text, encoding="utf-8")
    row = config.with_audit(config.read_config_csv(spark, str(path), config.RULES), "lake", day="2026-01-01").first()
    assert row["rule_id"] == "DQ_001" and row["rule_description"] == 'Say "no", please' and row["is_active"] == 1
    assert row["created_by"] == "SYSTEM" and row["source"] == "lake"
    settings = tmp_path / "settings.json"
    settings.write_text('{"domain_specific_columns": ["system","sub_system","domain"]}')
    assert config.read_settings(spark, str(settings))["domain_specific_columns"] == ["system", "sub_system", "domain"]
    settings.write_text("")
    with pytest.raises(ValueError):
        config.read_settings(spark, str(settings))


def test_expansion_pairs_and_pads(frame):
    row = binding("DQ_004", "t", "a, b,c", "k", ("lake", "m", "x,y"), critical="1,2")
    whole = binding("DQ_005", "t", " a,b ", "k", critical="1,2")
    rows = B.expanded(frame(BINDING, row, whole, binding("DQ_004", "T", "A", "k", ("lake", "m", "X")))).collect()
    got = sorted((r["rule_id"], r["column"].lower(), r["reference_column"].lower(), r["critical"]) for r in rows)
    assert [g[:3] for g in got] == [
        ("DQ_004", "a", "x"), ("DQ_004", "b", "y"), ("DQ_004", "c", ""), ("DQ_005", "a,b", ""),
    ]
    assert got[3][3] == "1,2" and got[1][3] == "2" and got[2][3] == ""
    typed = {r.rule_id: r for r in B.to_rules([r for r in rows if r["column"] == "a,b"], 2026)}
    assert typed["DQ_005"].columns == ("a", "b") and typed["DQ_005"].having is not None


def test_bindings_with_keys_of_several_columns(frame):
    row = binding("DQ_004", "t", "a + b,c, d", "k", ("lake", "m", "x+y,z"))
    rows = {r["column"]: r for r in B.expanded(frame(BINDING, row)).collect()}
    rules = {r.columns: r for r in B.to_rules([rows["a + b"], rows["c"]], 2026)}
    assert {c: r.references[0].columns for c, r in rules.items()} == {("a", "b"): ("x", "y"), ("c",): ("z",)}
    for unpaired in (rows["d"], binding_row(frame, "a+b", "x")):
        with pytest.raises(ValueError, match="paired"):
            B.to_rules([unpaired], 2026)
    facts = frame("k int, a string, b int", (1, "p", 1), (2, "p", 2), (3, None, 1), (4, "q", 1))
    known = frame("x string, y int", ("p", 1), ("q", 2), ("p", 3))
    check = TableCheck(facts, [rules["a", "b"]], RUN, 1, tables={"lake.m": known})
    flags = {r["k"]: r["rule_violation_flag"] for r in check.flags(check.rules[0]).collect()}
    assert {int(k): f for k, f in flags.items()} == {1: 0, 2: 1, 3: -1, 4: 1}


def binding_row(frame, columns, theirs):
    return B.expanded(frame(BINDING, binding("DQ_004", "t", columns, "k", ("lake", "m", theirs)))).first()


def test_thresholds_become_a_map(frame):
    rules = frame("rule_id string, system string, sub_system string, domain string, rule_type string", ("r", "a", "b", "c", "t"),
                  ("q", "a", "b", "c", "t"))
    limits = frame(
        "rule_id string, system string, sub_system string, domain string, rule_type string, thresholdvalue string",
        ("r", "a", "b", "c", "t", '{"max": 5}'),
    )
    rows = {r["rule_id"]: r["thresholds"] for r in B.with_thresholds(rules, limits).collect()}
    assert rows == {"r": {"max": "5"}, "q": None}


def test_selection_by_lists_and_layer(frame):
    df = frame(BINDING, binding("DQ_001", "x_BNZ_a", "c", system="Services"), binding("DQ_002", "silver_b", "c", sub="Y"))
    assert B.select_bindings(df).count() == 2
    assert B.select_bindings(df, layer="bronze", systems="services").count() == 1
    assert B.select_bindings(df, layer="silver", excluded="SILVER_B").count() == 0
    assert B.select_bindings(df, "AUDIT").count() == 0
    assert B.target_tables(df).count() == 2


def test_own_rules_and_thresholds_in_a_run(spark, frame, rules, tables, settings):
    own = frame(RULE, ("BR_1", "Own", "text", "Business", "S", "X", "D", 1))
    limits = frame(config.THRESHOLDS, ("BR_1", "S", "X", "D", 1, 1, '{"least": "2"}', "Business"))
    bindings = frame(BINDING, ("BR_1", "Business", "S", "X", "D", "lake", "people", "id", "id", *[None] * 5, 1, 1))

    def at_least(columns, **about):
        return Rule("BR_1", columns, violation=Compare(columns[0], "<", Param("least")), **about)

    statuses = R.run_bindings(spark, own, bindings, settings, tables, limits, {"BR_1": at_least})
    assert [(s.rule_id, s.passed) for s in statuses] == [("BR_1", True)]
    detail = spark.read.parquet(settings.detail_target).collect()
    assert [r["rule_violation_details"] for r in detail] == ["Condition violated: id < 2"] * 2
    row = spark.read.parquet(settings.summary_target).first()
    assert (row["rule_type"], row["applied_rule"], row["no_of_failures"]) == ("Business", "Own", 2)


def test_bindings_of_one_scanning_task_are_dealt_before_they_are_sorted(spark):
    rows = [("DQ_001", "Data Quality", "S", "X", "D", "lake", name, "a, B", "", None, None, None, f"yes{i}", None, 1, 1)
            for i in range(300) for name in ("t", "T")]
    found = B.expanded(spark.createDataFrame(rows, config.BINDINGS).coalesce(1))
    aggregate, _, below = found._jdf.queryExecution().optimizedPlan().toString().partition("RepartitionByExpression")
    assert "Aggregate" in aggregate and "LogicalRDD" in below
    assert sorted((r["rule_id"], r["column"]) for r in found.collect()) == [("DQ_001", "B"), ("DQ_001", "a")]
