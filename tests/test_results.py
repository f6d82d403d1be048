import json

import pytest
from pyspark.sql import functions as F

from assaywright import Compare, Matches, OneOf, Reference, Rule
from assaywright.catalog.builtin import build
from assaywright.plans import table_check
from assaywright.plans.empty_table import empty_detail, empty_summary
from assaywright.plans.table_check import DETAIL_COLUMNS, SUMMARY_COLUMNS, TableCheck
from assaywright.sinks import writers

RUN = "2026-01-15 08:30:00"
ABOUT = {"object": "t", "system": "s", "sub_system": "ss", "domain": "d"}


@pytest.fixture
def table(frame):
    return frame(
        "id int, name string, mail string, load_date int, year_id int",
        (1, "Ann", "a@b.co", 20240101, 2020), (2, " ", "bad", 20240101, 2020), (3, None, None, 20240101, None),
        (4, "B0b", "x@y.org", 20240102, 2021), (5, "Ann", "x@y.org", 20240102, 2021),
    )


def rules():
    keys = ("id", "name")
    return [
        build("DQ_001", "name", composite_columns=keys, **ABOUT),
        build("DQ_012", "mail", composite_columns=keys, critical_attribute="c", model_integrity="m", **ABOUT),
        build("DQ_015", "name", **ABOUT),
        build("DQ_005", "mail", composite_columns=(), **ABOUT),
        build("DQ_003", "name", reference=Reference("known", ("n",)), **ABOUT),
    ]


@pytest.fixture
def check(table, frame):
    return TableCheck(table, rules(), RUN, tables={"known": frame("n string", ("ANN ",))})


def test_schemas(check):
    summary, detail = check.summary("bronze"), check.detail("bronze")
    assert summary.columns == [*SUMMARY_COLUMNS, "lakehouse_layer"]
    assert detail.columns == [*DETAIL_COLUMNS, "lakehouse_layer"]
    kinds = dict(summary.dtypes)
    assert kinds["total_record_count"] == "bigint" and kinds["value"] == "double" and kinds["year_id"] == "int"
    assert kinds["rule_run_date"] == "timestamp" and dict(detail.dtypes)["result"] == "int"


def test_invariants(check):
    summary, detail = check.summary().collect(), check.detail().collect()
    for row in summary:
        assert row["total_record_count"] == row["total_passed_count"] + row["no_of_failures"]
        mine = [d for d in detail if d["unique_key"] == row["unique_key"]]
        assert len(mine) == row["no_of_failures"]
        assert sum(d["result"] == -1 for d in mine) == row["total_record_count"] - row["no_of_complete_records"]
        assert row["value"] == row["total_passed_count"] / row["total_record_count"]
    assert {d["unique_key"] for d in detail} <= {s["unique_key"] for s in summary}


def test_detail_row(check):
    row = check.detail().where("rule_id = 'DQ_012' and value1 = '2'").first()
    assert row["result"] == 1 and row["value"] == "bad" and row["critical_attribute"] == "c"
    assert row["key_columns"] == "id-name" and row["values_of_key_columns"] == "2||"
    assert (row["key1"], row["key2"], row["value2"], row["key3"], row["value3"]) == ("id", "name", " ", None, None)
    image = json.loads(row["source_table_attributes"])
    assert image == {"id": "2", "name": " ", "mail": "bad", "load_date": "20240101", "year_id": "2020"}
    assert json.loads(row["rule_json"])["columns"] == ["mail"]
    missing = check.detail().where("rule_id = 'DQ_012' and value1 = '3'").first()
    assert missing["result"] == -1 and json.loads(missing["source_table_attributes"])["mail"] is None


def test_keys_absent_blank_and_lower_case(table, check):
    rows = {r["rule_id"]: r for r in check.detail().collect()}
    assert rows["DQ_015"]["key_columns"] is None and rows["DQ_015"]["values_of_key_columns"] is None
    assert rows["DQ_005"]["key_columns"] == "" and rows["DQ_005"]["values_of_key_columns"] == ""
    lower = TableCheck(table, [build("DQ_015", "name", composite_columns=("name",))], RUN, lower_key_values=True)
    assert "b0b" in {r["value1"] for r in lower.detail().collect()}


def test_one_pass_equals_one_rule_at_a_time(table, frame, check):
    known = {"known": frame("n string", ("ANN ",))}
    alone = None
    for rule in rules():
        part = TableCheck(table, [rule], RUN, tables=known).summary()
        alone = part if alone is None else alone.unionByName(part)
    assert sorted(map(tuple, alone.collect()), key=repr) == sorted(map(tuple, check.summary().collect()), key=repr)


def test_many_rules_in_several_passes(table):
    many = [build("DQ_015", "name", object=f"t{i}") for i in range(9)]
    one, several = TableCheck(table, many, RUN), TableCheck(table, many, RUN, rules_per_pass=4)
    for result in ("summary", "detail"):
        a, b = getattr(one, result)(), getattr(several, result)()
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_flags_agree_with_detail(check):
    for rule in check.rules:
        flagged = check.flags(rule).groupBy("rule_violation_flag").count().collect()
        counts = {r["rule_violation_flag"]: r["count"] for r in flagged}
        listed = check.detail().where(F.col("rule_id") == rule.rule_id).groupBy("result").count().collect()
        assert {r["result"]: r["count"] for r in listed} == {k: v for k, v in counts.items() if k}


def test_given_batch_and_year_hold_for_all_rows(table):
    row = TableCheck(table, [build("DQ_001", "name")], RUN, batch_id=7, year_id=1999).summary().collect()
    assert [(r["batch_id"], r["year_id"], r["total_record_count"]) for r in row] == [(7, 1999, 5)]


def test_star_means_all_columns(table):
    got = TableCheck(table, [build("DQ_001", "*")], RUN).summary().collect()
    assert {r["attribute_name"] for r in got} == {"id,name,mail,load_date,year_id"}


def test_summary_reads_only_the_rule_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = TableCheck(df, [build("DQ_011", "l_returnflag")], RUN, 1).summary()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_returnflag:string>" in text


def test_image_is_built_for_failing_rows_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = TableCheck(df, [build("DQ_011", "l_returnflag")], RUN, 1).detail()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("StructsToJson") == 1 and text.index("StructsToJson") < text.rindex("Filter")


def test_empty_table_rows(frame):
    empty, full = frame("a int"), frame("a int", (1,))
    place = {"object": "t", "system": "s", "sub_system": "ss", "domain": "d"}
    assert empty_summary(full, place, 20240101, RUN).count() == 0
    summary = empty_summary(empty, place, 20240101, RUN, "silver").first()
    detail = empty_detail(empty, place, ["a", " b"], 20240101, RUN).first()
    assert (summary["rule_id"], summary["no_of_failures"], summary["value"]) == ("DQ_000", 1, 0.0)
    assert summary["unique_key"] == detail["unique_key"] and summary["lakehouse_layer"] == "silver"
    assert detail["rule_violation_details"] == "Table is empty" and detail["key_columns"] == "a-b"
    assert (detail["key2"], detail["value2"], detail["key3"]) == ("b", "", "")
    assert TableCheck(empty, [build("DQ_001", "a")], RUN, 1).summary().count() == 0


def test_rule_text_is_json():
    rule = Rule("R", ("a",), violation=OneOf("a", ("x",)), having=Compare("c", ">", 1), references=())
    shown = json.loads(rule.bind(violation=Matches("a", "é")).to_json())
    assert shown["violation"]["pattern"] == "é" and shown["having"]["kind"] == "Compare"
    assert table_check.reference_message(rule) == "Consistency check failed for columns: a"


def test_rows_of_one_scanning_task_are_dealt_to_several_writers(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    rows = spark.range(2000).selectExpr("'s' as system", "'u' as sub_system", "1 as batch_id", "2024 as year_id", "id").coalesce(1)
    spark.conf.set(key, "false")
    try:
        sized = writers.sized_files(rows)
        assert sized.columns == rows.columns
        counts = [len(part) for part in sized.rdd.glom().collect()]
    finally:
        spark.conf.unset(key)
    assert sum(counts) == 2000 and max(counts) < 1000
