"""Checks that look at one row: shipped patterns and lists, conditions, national id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaywright import (
    Between, CastsTo, Chain, Compare, IsNull, Like, Matches, OneOf, Param, Rule, Sql, all_of, any_of, if_then,
)
from assaywright.catalog import values as V
from assaywright.catalog.builtin import build
from assaywright.operators.profile import timeliness
from assaywright.plans.table_check import TableCheck

from . import sql as S
from .fixtures import CUSTOMER_DIRTY, ORDERS_DIRTY, PART_DIRTY, duck, from_sql, table
from .registry import add, query

YEAR = 2026


def flagged(df: DataFrame, rule: Rule, key: str, shown: str, tables=None) -> DataFrame:
    flags = TableCheck(df, [rule], S.RUN_DATE, S.BATCH, tables=tables).flags(rule)
    return flags.select(
        F.col(key).alias("row_key"),
        F.col(shown).alias("checked_value"),
        "rule_violation_flag",
        "rule_violation_details",
    )


def add_check(name, base, key, column, rule, violated, text, checked=None):
    def run(spark, sf_dir):
        return flagged(from_sql(spark, sf_dir, base), rule, key, column)

    add(name, run, S.row_check(duck(base), key, column, checked or rule.columns, violated, text))


CUSTOMER, ORDERS, PART = (CUSTOMER_DIRTY, "c_custkey"), (ORDERS_DIRTY, "o_orderkey"), (PART_DIRTY, "p_partkey")

PATTERN_CHECKS = {
    "numeric_check": (ORDERS, "number_raw", "DQ_002", V.DECIMAL_NUMBER),
    "decimal_check": (ORDERS, "number_raw", "DQ_006", V.DECIMAL_NUMBER),
    "strict_integer_check": (ORDERS, "number_raw", "whole_number", V.WHOLE_NUMBER),
    "date_time_full": (ORDERS, "date_raw", "DQ_008", V.DATE_TIME_FULL),
    "date_simple": (ORDERS, "date_raw", "DQ_009", V.DATE_SIMPLE),
    "date_time_iso": (ORDERS, "date_raw", "DQ_010", V.DATE_TIME_ISO),
    "date_multi": (ORDERS, "date_raw", "DQ_017", V.DATE_MULTI),
    "alphanumeric": (PART, "code_raw", "DQ_011", V.ALPHANUMERIC),
    "email": (CUSTOMER, "email_raw", "DQ_012", V.EMAIL),
    "phone": (CUSTOMER, "phone_raw", "DQ_013", V.PHONE),
    "english_text": (CUSTOMER, "name_raw", "DQ_015", V.ENGLISH_TEXT),
    "arabic_text": (CUSTOMER, "name_raw", "DQ_016", V.ARABIC_TEXT),
}
for _name, ((_base, _key), _column, _rule, _pattern) in PATTERN_CHECKS.items():
    add_check(_name, _base, _key, _column, build(_rule, _column), S.no_match(_column, _pattern),
              S.regex_text(_column, _pattern))

LIST_CHECKS = {
    "gender_in": (CUSTOMER, "gender_raw", "DQ_014", V.GENDERS),
    "curriculum_in": (PART, "curriculum_raw", "DQ_018", V.CURRICULA),
    "nationality_in": (PART, "nationality_raw", "DQ_019", V.NATIONALITIES),
    "marital_in": (PART, "marital_raw", "DQ_020", V.MARITAL_STATUSES),
    "grade_in": (PART, "grade_raw", "DQ_021", V.GRADES),
    "emirate_in": (PART, "emirate_raw", "emirate", V.EMIRATES),
}
for _name, ((_base, _key), _column, _rule, _values) in LIST_CHECKS.items():
    add_check(_name, _base, _key, _column, build(_rule, _column), S.not_in(_column, _values),
              S.in_text(_column, _values))


@query(
    "english_text_documents",
    f"""select cast(doc_id as varchar) as row_key, cast(n_chars as varchar) as checked_value,
 {S.flag_case(("text",), S.no_match("text", V.ENGLISH_TEXT))} as rule_violation_flag,
 {S.details_case(("text",), S.no_match("text", V.ENGLISH_TEXT), S.regex_text("text", V.ENGLISH_TEXT))}
   as rule_violation_details from documents""",
)
def english_documents(spark, sf_dir):
    return flagged(table(spark, sf_dir, "documents"), build("DQ_015", "text"), "doc_id", "n_chars")


# -- conditions ------------------------------------------------------------------------


def joined_text(*parts) -> str:
    """Messages of the conditions that hold, joined; parts are (condition SQL, message)."""
    return "concat_ws(', ', " + ", ".join(f"case when {c} then {S.quoted(m)} end" for c, m in parts) + ")"


NUMBER = "try_cast(trim({}) as double)"
NOT_DECIMAL = S.no_match("number_raw", V.DECIMAL_NUMBER)
IS_F = "lower(trim(status_raw)) = 'f'"

add_check(
    "condition_group", *ORDERS, "status_raw",
    Rule("R_group", ("status_raw",), violation=Chain((
        Compare("status_raw", "=", "F"), "and", Compare("o_totalprice", ">", 300000), "or",
        Chain((Matches("number_raw", V.DECIMAL_NUMBER, negate=True), "and", IsNull("date_raw", negate=True))),
    ))),
    f"({IS_F} and o_totalprice > 300000) or ({NOT_DECIMAL} and date_raw is not null)",
    joined_text(
        (IS_F, "Condition violated: status_raw = 'F'"),
        ("o_totalprice > 300000", "Condition violated: o_totalprice > 300000"),
        (NOT_DECIMAL, f"Regex pattern violated in number_raw: {V.DECIMAL_NUMBER}"),
        ("date_raw is not null", "Condition violated: date_raw IS NULL"),
    ),
)

add_check(
    "boolean_precedence", *ORDERS, "status_raw",
    Rule("R_any", ("status_raw",), violation=any_of(
        all_of(Compare("status_raw", "=", "O"), Compare("o_totalprice", "<", 50000.5)), IsNull("custkey_raw"),
    )),
    "(lower(trim(status_raw)) = 'o' and o_totalprice < 50000.5) or custkey_raw is null",
    joined_text(
        ("lower(trim(status_raw)) = 'o'", "Condition violated: status_raw = 'O'"),
        ("o_totalprice < 50000.5", "Condition violated: o_totalprice < 50000.5"),
        ("custkey_raw is null", "Condition violated: custkey_raw IS NULL"),
    ),
)

add_check(
    "threshold_condition", *ORDERS, "o_totalprice",
    Rule("R_threshold", ("o_totalprice",), violation=Compare("o_totalprice", ">", Param("max_total")),
         thresholds=(("max_total", 250000),)),
    "o_totalprice > 250000", S.quoted("Condition violated: o_totalprice > 250000"),
)

add_check(
    "threshold_expression", *ORDERS, "o_totalprice",
    Rule("R_threshold_sum", ("o_totalprice",),
         violation=Compare(Sql("cast(o_totalprice as double)"), ">", Param("base_total + extra_total")),
         thresholds=(("base_total", 250000), ("extra_total", 12345))),
    "o_totalprice > 262345", S.quoted("Condition violated: cast(o_totalprice as double) > 250000 + 12345"),
)

add_check(
    "range_check", *ORDERS, "number_raw",
    Rule("R_range", ("number_raw",), violation=Between("number_raw", 0, 20, negate=True)),
    f"not ({NUMBER.format('number_raw')} between 0 and 20)",
    S.quoted("Condition violated: number_raw BETWEEN 0 AND 20"),
)

add_check(
    "numeric_comparison", *ORDERS, "number_raw",
    Rule("R_number", ("number_raw",), violation=Compare("number_raw", ">=", 42)),
    f"{NUMBER.format('number_raw')} >= 42", S.quoted("Condition violated: number_raw >= 42"),
)

add_check(
    "text_comparison", *ORDERS, "number_raw",
    Rule("R_text", ("number_raw",), violation=Compare("number_raw", ">", "3", text=True)),
    "lower(trim(number_raw)) > '3'", S.quoted("Condition violated: number_raw > '3'"),
)

add_check(
    "like_condition", *CUSTOMER, "email_raw",
    Rule("R_like", ("email_raw",), violation=Like("email_raw", "%@MAIL.%", negate=True)),
    "lower(trim(email_raw)) not like '%@mail.%'", S.quoted("Condition violated: email_raw LIKE '%@MAIL.%'"),
)

add_check(
    "negated_list", *CUSTOMER, "gender_raw",
    Rule("R_not_in", ("gender_raw",), violation=OneOf("gender_raw", ("Mixed", " UNKNOWN "))),
    "lower(trim(gender_raw)) in ('mixed', 'unknown')",
    S.quoted("Condition violated: gender_raw IN ('Mixed', ' UNKNOWN ')"),
)

add_check(
    "null_predicate", *CUSTOMER, "phone_raw",
    Rule("R_null", ("email_raw",), violation=IsNull("phone_raw")),
    "phone_raw is null", S.quoted("Condition violated: phone_raw IS NULL"),
)

add_check(
    "conditional_rule", *CUSTOMER, "email_raw",
    Rule("R_if", ("gender_raw", "email_raw"), violation=if_then(
        Compare("gender_raw", "=", "Male"), Matches("email_raw", V.EMAIL))),
    f"lower(trim(gender_raw)) = 'male' and {S.no_match('email_raw', V.EMAIL)}",
    joined_text(
        ("lower(trim(gender_raw)) = 'male'", "Condition violated: gender_raw = 'Male'"),
        (S.no_match("email_raw", V.EMAIL), f"Regex pattern violated in email_raw: {V.EMAIL}"),
    ),
)

add_check(
    "data_type_check", *ORDERS, "number_raw",
    Rule("R_type", ("number_raw",), violation=CastsTo("number_raw", "double", negate=True)),
    f"{NUMBER.format('number_raw')} is null", S.quoted("Condition violated: number_raw IS double"),
)

PRICE_GAP = "cast(l_extendedprice as double) - 3000 * cast(l_quantity as double)"
add_check(
    "cross_column", "select * from {lineitem}", "l_orderkey", "l_extendedprice",
    Rule("R_cross", ("l_extendedprice", "l_quantity"), violation=Compare(Sql(PRICE_GAP), "<", 0)),
    f"{PRICE_GAP} < 0", S.quoted(f"Condition violated: {PRICE_GAP} < 0"),
)

add_check(
    "expression_field", *PART, "p_size",
    Rule("R_expr", ("p_size",), violation=Compare(Sql("p_size * 2 + 1"), ">", 51)),
    "p_size * 2 + 1 > 51", S.quoted("Condition violated: p_size * 2 + 1 > 51"),
)

add_check(
    "missing_any_of_two", *CUSTOMER, "segment_raw",
    build("DQ_001", ("segment_raw", "email_raw")), "false", "''",
)

# -- national id -------------------------------------------------------------------------

ID = r"regexp_replace(national_id_raw, '[\s-]+', '', 'g')"
DIGIT = f"try_cast(substr({ID}, cast(i as int), 1) as int) * (1 + (i + 1) % 2)"
LUHN_SUM = f"list_sum(list_transform(range(1, 16), lambda i: ({DIGIT}) // 10 + ({DIGIT}) % 10))"
ID_YEAR = f"try_cast(substr({ID}, 4, 4) as int)"
LEAD = "Invalid Emirates ID - "
BIRTH_YEAR = r"""case when regexp_matches(dob_raw, '^\d{2}-\d{2}-\d{4}( \d{2}:\d{2}:\d{2})?$') then
 try_cast(substr(dob_raw, 7, 4) as int) when regexp_matches(dob_raw, '^\d{4}-\d{2}-\d{2}$')
 then try_cast(substr(dob_raw, 1, 4) as int) end"""
ID_PARTS = [
    (f"not starts_with({ID}, '784')", LEAD + "Must start with 784"),
    (f"length({ID}) <> 15", LEAD + "Emirates ID must be 15 digits long"),
    (f"{ID_YEAR} <= 1800 or {ID_YEAR} >= {YEAR}",
     LEAD + f"Year in Emirates ID must be greater than 1800 and less than {YEAR}"),
    (f"not regexp_matches({ID}, '^[0-9]*$')", LEAD + "Non-numeric characters"),
    (f"regexp_matches({ID}, '^[0-9]*$') and (length({ID}) <> 15 or {LUHN_SUM} % 10 <> 0)", LEAD + "Invalid checksum"),
]
DOB_PART = (f"{ID_YEAR} <> {BIRTH_YEAR}", LEAD + "Emirates ID year does not match DOB year")

for _name, _dob, _parts in (("national_id", None, ID_PARTS), ("national_id_dob", "dob_raw", [*ID_PARTS, DOB_PART])):
    _text = joined_text(*_parts)
    add_check(_name, *CUSTOMER, "national_id_raw",
              build("DQ_007", "national_id_raw", current_year=YEAR, dob_column=_dob), f"{_text} <> ''", _text)

# -- timeliness --------------------------------------------------------------------------


@query(
    "timeliness",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
 case when l_shipdate > o_orderdate + interval 2 year or l_shipdate < o_orderdate then 1 else 0 end
   as rule_violation_flag
from lineitem join orders on l_orderkey = o_orderkey""",
)
def late_shipments(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    both = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return timeliness(both, "o_orderdate", "l_shipdate", "2 years").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rule_violation_flag"
    )
