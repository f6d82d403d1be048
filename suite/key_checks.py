"""Duplicates, group conditions and reference lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaywright import Calculation, Compare, Enrich, GroupAggregate, OneOf, Reference, Rule, Sql
from assaywright.catalog import bindings as B
from assaywright.catalog.builtin import build
from assaywright.operators.groups import group_facts, group_members
from assaywright.operators.joins import SizeLimit, join_by_name, spread_join
from assaywright.operators.reshape import distinct_rows
from assaywright.plans.table_check import TableCheck
from assaywright.sources import config
from assaywright.functions.text import as_text, named

from . import sql as S
from .fixtures import ORDERS_DIRTY, duck, from_sql, table
from .registry import ORACLES, add, query
from .row_checks import flagged


def add_key_check(name, base, key, shown, rule, violated, text, tables=None, source=None):
    """``source`` is the SQL the flags are computed over; it must offer what ``violated`` needs."""

    def run(spark, sf_dir):
        known = {n: make(spark, sf_dir) for n, make in (tables or {}).items()}
        return flagged(from_sql(spark, sf_dir, base), rule, key, shown, known)

    add(name, run, S.row_check(duck(source or base), key, shown, rule.columns, violated, text))


LINES = "select * from {lineitem}"
COUNT_TEXT = S.quoted("Condition violated: duplicate_count > 1")

add_key_check(
    "duplicate_composite_key", LINES, "l_orderkey", "l_linenumber",
    build("DQ_005", ("l_orderkey", "l_linenumber")), "copies > 1", COUNT_TEXT,
    source="select *, count(*) over (partition by l_orderkey, l_linenumber) as copies from {lineitem}",
)

add_key_check(
    "duplicate_single_key", "select doc_id, text, n_chars from {documents}", "doc_id", "n_chars",
    build("DQ_005", "text", digest=True), "copies > 1", COUNT_TEXT,
    source="select *, count(*) over (partition by text) as copies from {documents}",
)

add_key_check(
    "duplicate_with_missing", ORDERS_DIRTY, "o_orderkey", "custkey_raw",
    build("DQ_005", ("custkey_raw", "number_raw")), "copies > 1", COUNT_TEXT,
    source=f"""select *, count(*) filter (where not {S.missing('custkey_raw', 'number_raw')})
 over (partition by custkey_raw, number_raw) as copies from ({ORDERS_DIRTY}) d""",
)

add_key_check(
    "agg_having", "select * from {orders}", "o_orderkey", "o_custkey",
    Rule("R_having", ("o_custkey",), aggregations=(GroupAggregate(("o_custkey",), (
        Calculation("max", "o_orderpriority", "top_priority"), Calculation("count", "*", "orders"))),),
        having=Compare("orders", ">=", 12)),
    "orders_here >= 12", S.quoted("Condition violated: orders >= 12"),
    source="select *, count(*) over (partition by o_custkey) as orders_here from {orders}",
)

add_key_check(
    "numeric_agg_having", LINES, "l_orderkey", "l_suppkey",
    Rule("R_sum", ("l_suppkey",), aggregations=(GroupAggregate(("l_suppkey",), (
        Calculation("sum", "l_quantity", "total_quantity"),)),), having=Compare("total_quantity", ">", 15000)),
    "total_quantity > 15000", S.quoted("Condition violated: total_quantity > 15000"),
    source="select *, sum(l_quantity) over (partition by l_suppkey) as total_quantity from {lineitem}",
)

add_key_check(
    "conditional_agg", "select * from {orders}", "o_orderkey", "o_custkey",
    Rule("R_conditional", ("o_custkey",), aggregations=(GroupAggregate(("o_custkey",), (
        Calculation("count", "*", "open_orders", where=Compare("o_orderstatus", "=", "O")),)),),
        having=Compare("open_orders", "<", 3)),
    "open_orders < 3", S.quoted("Condition violated: open_orders < 3"),
    source="""select *, nullif(count(*) filter (where lower(trim(o_orderstatus)) = 'o')
 over (partition by o_custkey), 0) as open_orders from {orders}""",
)

add_key_check(
    "selected_agg_having", "select * from {orders}", "o_orderkey", "o_custkey",
    Rule("R_selected", ("o_custkey",), violation=Compare("o_totalprice", ">", 300000),
         aggregations=(GroupAggregate(("o_custkey",), (Calculation("count", "*", "large_orders"),)),),
         having=Compare("large_orders", ">", 3)),
    "o_totalprice > 300000 and large_orders > 3",
    S.quoted("Condition violated: o_totalprice > 300000, Condition violated: large_orders > 3"),
    source="""select *, count(*) filter (where o_totalprice > 300000) over (partition by o_custkey) as large_orders
 from {orders}""",
)

ABOVE = "cast(o_totalprice as double)"
add_key_check(
    "row_against_group", "select * from {orders}", "o_orderkey", "o_custkey",
    Rule("R_max", ("o_custkey",), aggregations=(GroupAggregate(("o_custkey",), (
        Calculation("max", "o_orderdate", "last_date"),)),), having=Compare(Sql("o_orderdate"), "=", Sql("last_date"))),
    "o_orderdate = last_date", S.quoted("Condition violated: o_orderdate = last_date"),
    source="select *, max(o_orderdate) over (partition by o_custkey) as last_date from {orders}",
)

add_key_check(
    "row_against_table", "select * from {orders}", "o_orderkey", "o_orderdate",
    Rule("R_all", ("o_orderdate",), aggregations=(GroupAggregate((), (
        Calculation("max", "o_orderdate", "last_date"),)),), having=Compare(Sql("o_orderdate"), "=", Sql("last_date"))),
    "o_orderdate = last_date", S.quoted("Condition violated: o_orderdate = last_date"),
    source="select *, max(o_orderdate) over () as last_date from {orders}",
)


@query(
    "distinct_agg",
    """select cast(l_suppkey as varchar) as l_suppkey, count(*) as lines, count(distinct l_partkey) as parts,
 count(distinct case when lower(trim(l_returnflag)) = 'r' then l_partkey end) as returned_parts,
 (min_by(l_shipmode, (l_shipdate, l_shipmode))) as first_flag,
 (max_by(l_shipmode, (l_shipdate, l_shipmode))) as last_flag
from (select *, l_returnflag || l_linestatus as l_shipmode from lineitem) l group by all""",
)
def distinct_aggregates(spark, sf_dir):
    lines = as_text(table(spark, sf_dir, "lineitem")).withColumn(
        "flags", F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    )
    calculations = (
        Calculation("count_distinct", "l_partkey", "parts"),
        Calculation("count_distinct", "l_partkey", "returned_parts", where=Compare("l_returnflag", "=", "R")),
        Calculation("first", "flags", "first_flag", order_by="l_shipdate"),
        Calculation("last", "flags", "last_flag", order_by="l_shipdate"),
    )
    facts = group_facts(lines, {"l_suppkey": named("l_suppkey")}, calculations)
    return facts.withColumnRenamed("__n", "lines")


@query(
    "approx_distinct_agg",
    """select cast(l_suppkey as varchar) as l_suppkey, count(distinct l_partkey) as parts, true as within_bound
 from lineitem group by l_suppkey""",
)
def approximate_distinct(spark, sf_dir):
    """Approximate counts next to exact ones: within five times the standard error of 5 %, as there are many groups."""
    lines = as_text(table(spark, sf_dir, "lineitem"))
    calculations = (
        Calculation("approx_count_distinct", "l_partkey", "approx_parts"),
        Calculation("count_distinct", "l_partkey", "parts"),
    )
    facts = group_facts(lines, {"l_suppkey": named("l_suppkey")}, calculations)
    within = F.abs(F.col("approx_parts") - F.col("parts")) <= F.greatest(F.lit(1.0), F.col("parts") * 0.25)
    return facts.select("l_suppkey", "parts", within.alias("within_bound"))


@query(
    "group_members",
    "select l_suppkey, l_returnflag, count(*) as copies from lineitem group by all",
)
def members(spark, sf_dir):
    return group_members(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag")


@query(
    "distinct_on",
    """select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (
 select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) o where rn = 1""",
)
def distinct_on(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return distinct_rows(orders, ["o_custkey"])


@query("distinct_all", "select distinct l_partkey, l_suppkey, l_returnflag from lineitem")
def distinct_all(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


# -- references --------------------------------------------------------------------------


def absent(*columns):
    return S.quoted("Consistency check failed for columns: " + ", ".join(columns))


def plain_table(name):
    return lambda spark, sf_dir: table(spark, sf_dir, name)


add_key_check(
    "fk_integrity_orders_customer", ORDERS_DIRTY, "o_orderkey", "custkey_raw",
    build("DQ_004", "custkey_raw", reference=Reference("customer", ("c_custkey",))),
    "not exists (select 1 from customer where c_custkey = custkey_raw)", absent("custkey_raw"),
    {"customer": plain_table("customer")},
)

MASTER = "select distinct case when o_orderstatus = 'P' then ' pending' else lower(o_orderstatus) end as code from {orders}"
add_key_check(
    "consistency_master", ORDERS_DIRTY, "o_orderkey", "status_raw",
    build("DQ_003", "status_raw", reference=Reference("status_master", ("code",))),
    f"not exists (select 1 from ({duck(MASTER)}) m where upper(trim(code)) = upper(trim(status_raw)))",
    absent("status_raw"), {"status_master": lambda spark, sf_dir: from_sql(spark, sf_dir, MASTER)},
)

PAIRS = "select l_orderkey as k1, case when l_returnflag = 'A' then l_linenumber else -l_linenumber end as k2 from {lineitem}"
add_key_check(
    "composite_fk", LINES, "l_orderkey", "l_linenumber",
    build("DQ_004", ("l_orderkey", "l_linenumber"), reference=Reference("pairs", ("k1", "k2"))),
    f"not exists (select 1 from ({duck(PAIRS)}) p where k1 = l_orderkey and k2 = l_linenumber)",
    absent("l_orderkey", "l_linenumber"), {"pairs": lambda spark, sf_dir: from_sql(spark, sf_dir, PAIRS)},
)

PAIRS_BINDING = ("DQ_004", "Data Quality", "S", "X", "D", "lake", "lineitem", "l_orderkey+l_linenumber", "", "lake", "pairs",
                 "k1+k2", None, None, 1, 1)


@query("composite_fk_binding", ORACLES["composite_fk"])
def composite_fk_binding(spark, sf_dir):
    """The rule of composite_fk, made from a binding instead of code."""
    rows = B.expanded(spark.createDataFrame([PAIRS_BINDING], config.BINDINGS)).collect()
    rule = B.to_rules(rows, 2026)[0]
    return flagged(from_sql(spark, sf_dir, LINES), rule, "l_orderkey", "l_linenumber", {"lake.pairs": from_sql(spark, sf_dir, PAIRS)})


CODES = """select distinct 'orders' as ds_table_name, 'status_raw' as ds_column_name,
 case when o_orderstatus = 'P' then 'pending' else o_orderstatus end as code from {orders} union all
 select distinct 'customer', 'segment_raw', 'P' from {customer}"""
add_key_check(
    "scoped_code_list", ORDERS_DIRTY, "o_orderkey", "status_raw",
    Rule("R_codes", ("status_raw",), category="invalid reference values", references=(Reference(
        "codes", ("code",), (("ds_table_name", "orders"), ("ds_column_name", "status_raw"))),)),
    f"""not exists (select 1 from ({duck(CODES)}) m where ds_table_name = 'orders' and ds_column_name = 'status_raw'
 and upper(trim(code)) = upper(trim(status_raw)))""",
    absent("status_raw"), {"codes": lambda spark, sf_dir: from_sql(spark, sf_dir, CODES)},
)

add_key_check(
    "two_references", ORDERS_DIRTY, "o_orderkey", "custkey_raw",
    Rule("R_two", ("custkey_raw",), references=(
        Reference("customer", ("c_custkey",)), Reference("supplier", ("s_suppkey",)))),
    """not exists (select 1 from customer where c_custkey = custkey_raw)
 or not exists (select 1 from supplier where s_suppkey = custkey_raw)""",
    absent("custkey_raw"), {"customer": plain_table("customer"), "supplier": plain_table("supplier")},
)

add_key_check(
    "selected_reference", ORDERS_DIRTY, "o_orderkey", "custkey_raw",
    Rule("R_selected_fk", ("custkey_raw",), violation=OneOf("status_raw", ("O",)),
         references=(Reference("customer", ("c_custkey",)),)),
    """lower(trim(status_raw)) = 'o' and not exists (select 1 from customer where c_custkey = custkey_raw)""",
    S.quoted("Condition violated: status_raw IN ('O'), Consistency check failed for columns: custkey_raw"),
    {"customer": plain_table("customer")},
)

add_key_check(
    "having_and_reference", ORDERS_DIRTY, "o_orderkey", "custkey_raw",
    Rule("R_mixed", ("custkey_raw",), aggregations=(GroupAggregate(("custkey_raw",), (
        Calculation("count", "*", "orders"),)),), having=Compare("orders", ">", 14),
        references=(Reference("customer", ("c_custkey",)),)),
    "orders_here > 14 or not exists (select 1 from customer where c_custkey = custkey_raw)",
    """concat_ws(', ', case when orders_here > 14 then 'Condition violated: orders > 14' end,
 case when not exists (select 1 from customer where c_custkey = custkey_raw)
 then 'Consistency check failed for columns: custkey_raw' end)""",
    {"customer": plain_table("customer")},
    source=f"select *, count(*) over (partition by custkey_raw) as orders_here from ({ORDERS_DIRTY}) d",
)

# An order is suspect when its customer's lines average below a price: join, then group, then condition.
ENRICHED = """select o_orderkey, o_custkey, l_linenumber, l_quantity from {orders} join {lineitem} on l_orderkey = o_orderkey"""
add_key_check(
    "enriched_rule", "select o_orderkey, o_custkey, o_orderkey as l_orderkey from {orders}", "o_orderkey", "o_custkey",
    Rule("R_enriched", ("o_custkey",), enrich=Enrich("lines", ("l_orderkey",)),
         aggregations=(GroupAggregate(("o_custkey",), (Calculation("sum", "l_quantity", "quantity"),)),),
         having=Compare("quantity", "<", 800)),
    "quantity < 800", S.quoted("Condition violated: quantity < 800"),
    {"lines": lambda spark, sf_dir: table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")},
    source=f"select *, sum(l_quantity) over (partition by o_custkey) as quantity from ({ENRICHED}) e",
)

FINISHED = """select case when o_orderstatus = 'F' then o_orderkey else -o_orderkey end as o_orderkey from {orders}"""
add_key_check(
    "distinct_rule", LINES, "l_orderkey", "l_orderkey",
    Rule("R_distinct", ("l_orderkey",), distinct=True, distinct_columns=("l_orderkey",),
         references=(Reference("orders", ("o_orderkey",)),)),
    f"not exists (select 1 from ({duck(FINISHED)}) o where o_orderkey = l_orderkey)", absent("l_orderkey"),
    {"orders": lambda spark, sf_dir: from_sql(spark, sf_dir, FINISHED)},
    source="select distinct l_orderkey from {lineitem}",
)


@query(
    "join_by_name",
    """select c_custkey, c_name, c_nationkey, n_name from customer join nation on c_nationkey = n_nationkey""",
)
def joined_by_name(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("C_NATIONKEY"), "n_name")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return join_by_name(customers, nations)


SKEWED = """select c_custkey, case when c_custkey % 4 < 3 then 1 when c_custkey % 40 = 3 then null else 100 + c_nationkey end
 as area from customer"""


@query(
    "enriched_skewed",
    f"""select s_suppkey, s.area as area, c.area as home, c_custkey from (select s_suppkey,
 s_nationkey + case when s_suppkey % 2 = 0 then 100 else 0 end as area from supplier) s full join ({SKEWED}) c on s.area = c.area""",
)
def enriched_skewed(spark, sf_dir):
    """Suppliers by area with the customers there, three quarters of whom have one area; both sides keep their unmatched rows."""
    moved = F.when(F.col("s_suppkey") % 2 == 0, 100).otherwise(0)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") + moved).alias("area"))
    number = F.col("c_custkey")
    area = F.when(number % 4 < 3, 1).when(number % 40 == 3, None).otherwise(100 + F.col("c_nationkey"))
    area = area.cast(suppliers.schema["area"].dataType)
    customers = table(spark, sf_dir, "customer").select(number, area.alias("area"), area.alias("home"))
    met = spread_join(suppliers, customers, ["area"], "full", SizeLimit(rows=20, bytes=1 << 20, hot_rows=40))
    return met.select("s_suppkey", "area", "home", "c_custkey")


# -- many key rules of one table in one scan ---------------------------------------------------

LINE_KEYS = ("l_orderkey", "l_linenumber")
KEY_RULES = [
    build("DQ_005", LINE_KEYS, object="lineitem", composite_columns=LINE_KEYS),
    build("DQ_005", ("l_partkey", "l_suppkey", "l_shipdate"), object="lineitem", composite_columns=LINE_KEYS),
    Rule("K_sum", ("l_suppkey",), object="lineitem", composite_columns=LINE_KEYS, aggregations=(GroupAggregate(
        ("l_suppkey",), (Calculation("sum", "l_linenumber", "numbers"), Calculation("count", "*", "lines"))),),
        having=Compare("numbers", ">", 2500)),
    Rule("K_returned", ("l_partkey",), object="lineitem", composite_columns=LINE_KEYS, aggregations=(GroupAggregate(
        ("l_partkey",), (Calculation("count", "*", "returned", where=Compare("l_returnflag", "=", "R")),)),),
        having=Compare("returned", ">=", 12)),
    build("DQ_004", "l_orderkey", object="lineitem", composite_columns=LINE_KEYS, reference=Reference("some_orders", ("o_orderkey",))),
    build("DQ_004", ("l_partkey", "l_suppkey"), object="lineitem", composite_columns=LINE_KEYS, reference=Reference("offers", ("k1", "k2"))),
]
# Orders and offers with some keys moved away, so that lines lose their partner.
SOME_ORDERS = "select case when o_orderkey % 11 = 0 then -o_orderkey else o_orderkey end as o_orderkey from {orders}"
OFFERS = "select l_partkey + case when l_linenumber = 1 then 1000000 else 0 end as k1, l_suppkey as k2 from {lineitem}"
KEY_SOURCE = f"""select l.*, cast(null as int) as year_id, {S.BATCH} as batch_id,
 count(*) over (partition by l_orderkey, l_linenumber) as c0, count(*) over (partition by l_partkey, l_suppkey, l_shipdate) as c1,
 sum(l_linenumber) over (partition by l_suppkey) as c2, count(*) filter (where l_returnflag = 'R') over (partition by l_partkey) as c3,
 not exists (select 1 from ({duck(SOME_ORDERS)}) o where o_orderkey = l_orderkey) as c4,
 not exists (select 1 from ({duck(OFFERS)}) f where k1 = l_partkey and k2 = l_suppkey) as c5 from lineitem l"""
KEY_TESTS = ["c0 > 1", "c1 > 1", "c2 > 2500", "c3 >= 12", "c4", "c5"]


def key_check(spark, sf_dir):
    known = {"some_orders": from_sql(spark, sf_dir, SOME_ORDERS), "offers": from_sql(spark, sf_dir, OFFERS)}
    return TableCheck(table(spark, sf_dir, "lineitem"), KEY_RULES, S.RUN_DATE, S.BATCH, tables=known)


add(
    "key_rules_lineitem", lambda s, d: key_check(s, d).summary(),
    " union all ".join(
        f"({S.summary_row(KEY_SOURCE, r, S.flag_case(r.columns, t))})" for r, t in zip(KEY_RULES, KEY_TESTS)
    ),
)
KEY_TEXTS = [
    COUNT_TEXT, COUNT_TEXT, S.quoted("Condition violated: numbers > 2500"), S.quoted("Condition violated: returned >= 12"),
    absent("l_orderkey"), absent("l_partkey", "l_suppkey"),
]


def key_detail_sql(rule, violated, text) -> str:
    values = ", ".join(f"cast({c} as varchar)" for c in rule.columns)
    return f"""select {S.quoted(rule.rule_id)} as rule_id, {S.quoted(",".join(rule.columns))} as attribute_name,
 cast(l_orderkey as varchar) as value1, cast(l_linenumber as varchar) as value2, concat_ws(',', {values}) as value,
 {text} as rule_violation_details from ({KEY_SOURCE}) k where {violated}"""


add(
    "key_rules_detail",
    lambda s, d: key_check(s, d).detail().select("rule_id", "attribute_name", "value1", "value2", "value", "rule_violation_details"),
    " union all ".join(f"({key_detail_sql(*part)})" for part in zip(KEY_RULES, KEY_TESTS, KEY_TEXTS)),
)


# -- exact quantiles and modes; one group holds a third of all rows ------------------------------

MIXED = "select *, case when l_orderkey % 3 = 0 then 'third' else cast(l_suppkey as string) end as bunch from {lineitem}"


def add_selection(name, value, *calculations):
    """The fact per group, and a rule on it."""
    def run(spark, sf_dir):
        facts = group_facts(as_text(from_sql(spark, sf_dir, MIXED)), {"bunch": named("bunch")}, calculations).withColumnRenamed("__n", "lines")
        kinds = dict(facts.dtypes)  # engines differ in the last digit of a value between two others
        return facts.select(*[F.round(c, 6).alias(c) if kinds[c] == "double" else c for c in facts.columns])

    add(name, run, f"select bunch, count(*) as lines, {value} from ({duck(MIXED)}) m group by bunch")


add_selection(
    "group_median", "round(median(l_extendedprice), 6) as middle, round(median(l_discount) filter (where l_returnflag = 'R'), 6) as returned",
    Calculation("median", "l_extendedprice", "middle"), Calculation("median", "l_discount", "returned", where=Compare("l_returnflag", "=", "R")),
)
add_selection(
    "group_percentile", "round(quantile_cont(l_quantity, 0.875), 6) as high, round(quantile_cont(l_extendedprice, 0.25), 6) as low, max(l_shipdate)::varchar as latest",
    Calculation("percentile", "l_quantity", "high", at=0.875), Calculation("percentile", "l_extendedprice", "low", at=0.25),
    Calculation("max", "l_shipdate", "latest"),
)


@query(
    "group_mode",
    f"""select bunch, lines, v as usual from (select *, row_number() over (partition by bunch order by n desc, v) as rn,
 cast(sum(n) over (partition by bunch) as bigint) as lines from (select bunch, cast(l_partkey as varchar) as v, count(*) as n
 from ({duck(MIXED)}) m group by 1, 2) c) r where rn = 1""",
)
def group_mode(spark, sf_dir):
    rows = as_text(from_sql(spark, sf_dir, MIXED))
    return group_facts(rows, {"bunch": named("bunch")}, (Calculation("mode", "l_partkey", "usual"),)).withColumnRenamed("__n", "lines")


add_key_check(
    "median_having", LINES, "l_orderkey", "l_suppkey",
    Rule("R_median", ("l_suppkey",), aggregations=(GroupAggregate(("l_suppkey",), (Calculation("median", "l_quantity", "middle"),)),),
         having=Compare("middle", ">", 25.5)),
    "middle > 25.5", S.quoted("Condition violated: middle > 25.5"),
    source="select *, median(l_quantity) over (partition by l_suppkey) as middle from {lineitem}",
)
