"""Small builders for the checking SQL (DuckDB dialect)."""

from __future__ import annotations

import re

RUN_DATE = "2026-01-15 08:30:00"
BATCH = 20241225


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def missing(*columns: str) -> str:
    tests = [
        f"(trim(cast({c} as varchar)) is null or trim(cast({c} as varchar)) = ''"
        f" or upper(trim(cast({c} as varchar))) = 'NULL')"
        for c in columns
    ]
    return "(" + " or ".join(tests) + ")"


def missing_text(*columns: str) -> str:
    parts = ", ".join(f"case when {missing(c)} then {quoted(c)} end" for c in columns)
    return f"'missing value for fields: ' || concat_ws(',', {parts})"


def regex(pattern: str) -> str:
    """Java's \\uXXXX in RE2 spelling."""
    return quoted(re.sub(r"\\u([0-9A-Fa-f]{4})", r"\\x{\1}", pattern))


def no_match(column: str, pattern: str) -> str:
    return f"not regexp_matches(trim(cast({column} as varchar)), {regex(pattern)})"


def regex_text(column: str, pattern: str) -> str:
    return quoted(f"Regex pattern violated in {column}: {pattern}")


def in_list(values) -> str:
    return "(" + ", ".join(quoted(str(v).strip().lower()) for v in values) + ")"


def not_in(column: str, values) -> str:
    return f"lower(trim(cast({column} as varchar))) not in {in_list(values)}"


def in_text(column: str, values) -> str:
    return quoted(f"Condition violated: {column} IN (" + ", ".join(f"'{v}'" for v in values) + ")")


def flag_case(checked, violated: str) -> str:
    return f"case when {missing(*checked)} then -1 when coalesce({violated}, false) then 1 else 0 end"


def details_case(checked, violated: str, text: str) -> str:
    return (
        f"case when {missing(*checked)} then {missing_text(*checked)}"
        f" when coalesce({violated}, false) then {text} else '' end"
    )


def row_check(base: str, key: str, shown: str, checked, violated: str, text: str) -> str:
    """Flag and details per row: the columns every row-check query returns."""
    checked = (checked,) if isinstance(checked, str) else checked
    return f"""
select cast({key} as varchar) as row_key, cast({shown} as varchar) as checked_value,
 {flag_case(checked, violated)} as rule_violation_flag,
 {details_case(checked, violated, text)} as rule_violation_details
from ({base}) base"""


def unique_key(rule_id: str, dimension: str, obj: str, attribute: str, place=("", "", "")) -> str:
    head = ", ".join(quoted(v) for v in (rule_id, dimension, obj, attribute))
    tail = ", ".join(quoted(v) for v in (RUN_DATE, *place))
    return f"sha256(concat_ws('-', {head}, cast(year_id as varchar), cast(batch_id as varchar), {tail}))"


def summary_row(base: str, rule, flag: str) -> str:
    """One rule's summary over ``base``, which offers year_id and batch_id."""
    attribute = ",".join(rule.columns)
    place = (rule.system, rule.sub_system, rule.domain)
    return f"""
select {unique_key(rule.rule_id, rule.dimension, rule.object, attribute, place)} as unique_key,
 {quoted(rule.object)} as object, {quoted(attribute)} as attribute_name, {quoted(rule.dimension)} as dimension,
 {quoted(rule.rule_id)} as rule_id, {quoted(rule.rule_type)} as rule_type, {quoted(rule.system)} as system,
 {quoted(rule.sub_system)} as sub_system, {quoted(rule.domain)} as domain, {quoted(rule.name)} as applied_rule,
 {quoted(rule.description)} as rule_description, count(*) as total_record_count,
 count(*) filter (where flag <> -1) as no_of_complete_records, count(*) filter (where flag = 0) as total_passed_count,
 count(*) filter (where flag <> 0) as no_of_failures,
 count(*) filter (where flag = 0) / count(*) as value, year_id, batch_id,
 cast({quoted(RUN_DATE)} as timestamp) as rule_run_date
from (select *, {flag} as flag from ({base}) inner_base) flagged group by year_id, batch_id"""


def image(columns, extra: str = "") -> str:
    fields = ", ".join(f"{c} := cast({c} as varchar)" for c in columns)
    return f"cast(to_json(struct_pack({fields}{extra})) as varchar)"


def detail_rows(base: str, rule, columns, flag: str, details: str, extra: str = "", missing_extra: str = "") -> str:
    """One rule's detail rows over ``base``, which offers year_id, batch_id and the table's columns."""
    attribute = ",".join(rule.columns)
    place = (rule.system, rule.sub_system, rule.domain)
    keys = list(rule.composite_columns or ())
    names = "null" if rule.composite_columns is None else quoted("-".join(keys))
    joined = (
        "null" if rule.composite_columns is None
        else "concat_ws('||', " + ", ".join(f"trim(cast({k} as varchar))" for k in keys) + ")" if keys
        else "''"
    )
    pairs = []
    for i in range(4):
        name = quoted(keys[i]) if i < len(keys) else "cast(null as varchar)"
        value = f"cast({keys[i]} as varchar)" if i < len(keys) else "cast(null as varchar)"
        pairs.append(f"{name} as key{i + 1}, {value} as value{i + 1}")
    shown = image(columns)
    if extra:
        shown = f"case when flag = -1 then {image(columns, missing_extra)} else {image(columns, extra)} end"
    values = ", ".join(f"cast({c} as varchar)" for c in rule.columns)
    return f"""
select {unique_key(rule.rule_id, rule.dimension, rule.object, attribute, place)} as unique_key,
 {quoted(rule.rule_id)} as rule_id, {quoted(rule.dimension)} as dimension, {quoted(rule.object)} as object,
 {quoted(attribute)} as attribute_name, year_id, batch_id, cast({quoted(RUN_DATE)} as timestamp) as rule_run_date,
 {quoted(rule.system)} as system, {quoted(rule.sub_system)} as sub_system, {quoted(rule.domain)} as domain,
 {quoted(rule.rule_type)} as rule_type, {quoted(rule.name)} as applied_rule,
 {quoted(rule.description)} as rule_description, {quoted(rule.to_json())} as rule_json,
 {quoted(rule.category)} as category, {quoted(rule.critical_attribute)} as critical_attribute,
 {quoted(rule.model_integrity)} as model_integrity, {shown} as source_table_attributes, flag as result,
 {details} as rule_violation_details, concat_ws(',', {values}) as value, {names} as key_columns,
 {joined} as values_of_key_columns, {", ".join(pairs)}
from (select *, {flag} as flag from ({base}) inner_base) flagged where flag <> 0"""
