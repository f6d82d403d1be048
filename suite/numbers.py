"""Exact numbers: whole numbers and decimals beyond what a double tells apart."""

from __future__ import annotations

from decimal import Decimal

from assaywright import Between, Calculation, Compare, GroupAggregate, Param, Rule

from . import sql as S
from .fixtures import duck, from_sql
from .registry import add
from .row_checks import flagged

EDGE = 2**53
#: Whole numbers around 2^53, one apart, as numbers and as text; decimals with as many digits.
LARGE = f"""select o_orderkey, o_custkey, {EDGE} + o_orderkey % 7 as big, cast({EDGE} + o_orderkey % 7 as string) as big_text,
 cast(concat('90071992547409.9', cast(o_orderkey % 7 as string)) as decimal(20,2)) as exact from {{orders}}"""


def add_number_check(name, rule, column, violated, text, source=LARGE):
    def run(spark, sf_dir):
        return flagged(from_sql(spark, sf_dir, LARGE), rule, "o_orderkey", column)

    add(name, run, S.row_check(duck(source), "o_orderkey", column, rule.columns, violated, text))


add_number_check(
    "big_integer_comparison", Rule("R_big", ("big",), violation=Compare("big", "=", EDGE + 1)), "big", f"big = {EDGE + 1}",
    S.quoted(f"Condition violated: big = {EDGE + 1}"),
)
add_number_check(
    "big_integer_text", Rule("R_text", ("big_text",), violation=Compare("big_text", ">", EDGE + 2)), "big_text",
    f"cast(big_text as bigint) > {EDGE + 2}", S.quoted(f"Condition violated: big_text > {EDGE + 2}"),
)
add_number_check(
    "big_integer_range", Rule("R_range", ("big",), violation=Between("big", EDGE + 1, EDGE + 3)), "big",
    f"big between {EDGE + 1} and {EDGE + 3}", S.quoted(f"Condition violated: big BETWEEN {EDGE + 1} AND {EDGE + 3}"),
)
LIMIT = "90071992547409.93"
add_number_check(
    "decimal_threshold",
    Rule("R_limit", ("exact",), violation=Compare("exact", ">", Param("max_total")), thresholds=(("max_total", LIMIT),)),
    "exact", f"exact > cast('{LIMIT}' as decimal(20,2))", S.quoted(f"Condition violated: exact > {LIMIT}"),
)
TOTAL = Decimal("900719925474099.35")
SUM = GroupAggregate(("o_custkey",), (Calculation("sum", "exact", "total"),))
add_number_check(
    "decimal_sum",
    Rule("R_total", ("o_custkey",), aggregations=(SUM,), having=Compare("total", ">", TOTAL)),
    "exact", f"total > cast('{TOTAL}' as decimal(38,2))", S.quoted(f"Condition violated: total > {TOTAL}"),
    f"select *, sum(exact) over (partition by o_custkey) as total from ({LARGE}) x",
)
