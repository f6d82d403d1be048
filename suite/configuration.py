"""Rule configuration and merges, over tables derived from the test data."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaywright.catalog import bindings as B
from assaywright.operators.joins import delete_insert, insert_if_absent, null_safe_anti, upsert
from assaywright.operators.storage import new_path
from assaywright.sinks import writers
from assaywright.sources import config

from .fixtures import BINDINGS, RULES, THRESHOLDS, duck, from_sql
from .registry import query

BOUND = duck(BINDINGS)
SELECTED = f"""select * from ({BOUND}) b where is_active = 1 and rule_type = 'Data Quality'"""


@query(
    "rule_selection",
    f"""{SELECTED} and lower(system) in ('services') and lower(sub_system) in ('nqc', 'moe-public')
 and lower(table_name) like '%bnz%' and lower(table_name) not in ('x_bnz_brand#2', 'x_bnz_brand#17')
 and rule_id in ('DQ_001', 'DQ_004', 'DQ_005', 'DQ_009', 'DQ_012')""",
)
def rule_selection(spark, sf_dir):
    return B.select_bindings(
        from_sql(spark, sf_dir, BINDINGS), "Data Quality", rules="DQ_001,DQ_004,DQ_005, DQ_009,DQ_012",
        systems="SERVICES", sub_systems="nqc,MOE-public", layer="Bronze", excluded="X_BNZ_Brand#2,x_bnz_brand#17",
    )


@query("rule_selection_all", f"select * from ({BOUND}) b where is_active = 1")
def rule_selection_all(spark, sf_dir):
    return B.select_bindings(from_sql(spark, sf_dir, BINDINGS))


def blank(column: str) -> str:
    return f"(coalesce(trim({column}), '') = '')"


INCOMPLETE = f"({blank('database_name')} or {blank('table_name')} or {blank('columns')})"
UNREFERENCED = (
    "(rule_id in ('DQ_003', 'DQ_004') and"
    f" ({blank('reference_database')} or {blank('reference_table_name')} or {blank('reference_columns')}))"
)


@query(
    "rejected_bindings",
    f"""select *, case when {INCOMPLETE} then 'Mandatory fields database_name, table_name, columns are missing'
 else 'Reference fields are missing: reference_database, reference_table_name, reference_columns, for ' || table_name
 end as reject_reason from ({BOUND}) b where {INCOMPLETE} or {UNREFERENCED}""",
)
def rejected_bindings(spark, sf_dir):
    return B.rejected(from_sql(spark, sf_dir, BINDINGS))


@query("accepted_bindings", f"select * from ({BOUND}) b where not {INCOMPLETE} and not {UNREFERENCED}")
def accepted_bindings(spark, sf_dir):
    return B.accepted(from_sql(spark, sf_dir, BINDINGS))


PLACE = "lower(coalesce({}, ''))"
SAME = ", ".join(
    PLACE.format(c)
    for c in ("rule_id", "system", "sub_system", "domain", "database_name", "table_name", "reference_table_name",
              "col", "reference_col")
)
EXPANDED = f"""
select *, case when rule_id = 'DQ_005' then coalesce(reference_columns, '')
  else trim(coalesce(string_split(reference_columns, ',')[pos + 1], '')) end as reference_col,
 case when rule_id = 'DQ_005' then coalesce(critical_attribute, '')
  else trim(coalesce(string_split(critical_attribute, ',')[pos + 1], '')) end as critical
from (
 select b.*, 0 as pos, trim(columns) as col from ({BOUND}) b where rule_id = 'DQ_005'
 union all
 select b.*, p.pos, trim(string_split(columns, ',')[p.pos + 1]) as col
 from ({BOUND}) b, (select cast(unnest(range(0, 3)) as int) as pos) p
 where rule_id <> 'DQ_005' and p.pos < length(string_split(columns, ','))
) listed"""


@query(
    "rule_expansion",
    f"""select rule_id, lower(database_name) as database_name, lower(table_name) as table_name, lower(col) as "column",
 lower(reference_col) as reference_column from ({EXPANDED}) e group by {SAME}, all""".replace(
        f"group by {SAME}, all", f"group by rule_id, 2, 3, 4, 5, {SAME}"
    ),
)
def rule_expansion(spark, sf_dir):
    kept = B.expanded(from_sql(spark, sf_dir, BINDINGS))
    lowered = [F.lower(c).alias(c) for c in ("database_name", "table_name", "column", "reference_column")]
    return kept.select("rule_id", *lowered)


@query(
    "rules_with_thresholds",
    f"""select r.*, t.thresholdvalue->>'max_total' as max_total, t.thresholdvalue->>'min_total' as min_total
 from ({duck(RULES)}) r left join ({duck(THRESHOLDS)}) t on r.rule_id = t.rule_id and r.domain = t.domain
 and r.system = t.system and r.sub_system = t.sub_system and r.rule_type = t.rule_type""",
)
def rules_with_thresholds(spark, sf_dir):
    joined = B.with_thresholds(from_sql(spark, sf_dir, RULES), from_sql(spark, sf_dir, THRESHOLDS))
    return joined.withColumns(
        {"max_total": F.col("thresholds").getItem("max_total"), "min_total": F.col("thresholds").getItem("min_total")}
    ).drop("thresholds")


@query(
    "bound_rules",
    f"""select distinct r.rule_id, r.rule_name, r.rule_description, r.rule_type, b.system, b.sub_system, b.domain,
 b.database_name, b.table_name, b.columns, b.composite_columns
 from ({duck(RULES)}) r join ({BOUND}) b on r.rule_id = b.rule_id""",
)
def bound_rules(spark, sf_dir):
    bound = B.bound_rules(from_sql(spark, sf_dir, RULES), from_sql(spark, sf_dir, BINDINGS))
    return bound.select(
        "rule_id", "rule_name", "rule_description", "rule_type", "system", "sub_system", "domain", "database_name",
        "table_name", "columns", "composite_columns",
    ).distinct()


@query(
    "distinct_targets",
    f"""select database_name, table_name, min(system) as system, min(sub_system) as sub_system, min(domain) as domain,
 min(composite_columns) as composite_columns from ({BOUND}) b group by database_name, table_name""",
)
def distinct_targets(spark, sf_dir):
    return B.target_tables(from_sql(spark, sf_dir, BINDINGS))


BINDING_COLUMNS = [part.split()[0] for part in config.BINDINGS.split(",")]


@query(
    "config_csv",
    "select " + ", ".join(f"nullif({c}, '') as {c}" for c in BINDING_COLUMNS[:-2]) + ", version, is_active, cast('2026-01-15' as date) as created_date,"
    " 'SYSTEM' as created_by, cast('2026-01-15' as date) as updated_date, 'SYSTEM' as updated_by, 'lake' as source"
    f" from ({BOUND}) b",
)
def config_csv(spark, sf_dir):
    path = new_path(spark, "bindings-csv")
    ready = from_sql(spark, sf_dir, BINDINGS).select(*BINDING_COLUMNS)
    writer = ready.write.option("header", True).option("escape", '"').option("emptyValue", '""')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    loaded = config.read_config_csv(spark, path, config.BINDINGS)
    return config.with_audit(loaded, "lake", day="2026-01-15")


# -- merges -----------------------------------------------------------------------------------

OLD = """select c_nationkey as nation, nullif(c_mktsegment, 'BUILDING') as segment, max(c_name) as holder,
 count(*) as customers from {customer} group by 1, 2"""
NEW = """select s_nationkey as nation, case when s_acctbal > 4000 then 'MACHINERY' when s_acctbal > 0 then 'NEW' end
 as segment, s_name as holder, s_suppkey as customers from {supplier}"""
NEW_ONE = f"""select nation, segment, holder, customers from (select *, row_number() over
 (partition by nation, segment order by holder nulls first, customers nulls first) as rn from ({duck(NEW)}) n) o
 where rn = 1"""
NULL_SAFE = "s.nation is not distinct from t.nation and s.segment is not distinct from t.segment"
KEYS = ("nation", "segment")


def old_new(spark, sf_dir):
    return from_sql(spark, sf_dir, OLD), from_sql(spark, sf_dir, NEW)


@query(
    "insert_if_absent",
    f"select * from ({NEW_ONE}) s where not exists (select 1 from ({duck(OLD)}) t where {NULL_SAFE})",
)
def insert_absent(spark, sf_dir):
    return insert_if_absent(*old_new(spark, sf_dir), KEYS)


@query(
    "upsert_log",
    f"""select * from ({duck(OLD)}) t where not exists (select 1 from ({NEW_ONE}) s
 where s.nation = t.nation and s.segment = t.segment) union all select * from ({NEW_ONE}) s""",
)
def upsert_log(spark, sf_dir):
    return upsert(*old_new(spark, sf_dir), KEYS)


@query(
    "delete_insert",
    f"""select * from ({duck(OLD)}) t where not exists (select 1 from ({duck(NEW)}) s where {NULL_SAFE})
 union all select * from ({duck(NEW)}) s""",
)
def delete_then_insert(spark, sf_dir):
    return delete_insert(*old_new(spark, sf_dir), KEYS)


@query(
    "null_safe_anti_join",
    f"select * from ({duck(OLD)}) t where not exists (select 1 from ({duck(NEW)}) s where {NULL_SAFE})",
)
def null_safe(spark, sf_dir):
    return null_safe_anti(*old_new(spark, sf_dir), KEYS)


@query(
    "stored_merges",
    f"""select *, 'inserted' as kind from ({duck(OLD)}) t union all
 select *, 'inserted' from ({NEW_ONE}) s where not exists (select 1 from ({duck(OLD)}) t where {NULL_SAFE})
 union all select *, 'upserted' from (select * from ({duck(OLD)}) t where not exists (select 1 from ({NEW_ONE}) s
 where s.nation = t.nation and s.segment = t.segment) union all select * from ({NEW_ONE}) s) u
 union all select *, 'replaced' from (select * from ({duck(OLD)}) t where not exists (select 1 from ({duck(NEW)}) s
 where {NULL_SAFE}) union all select * from ({duck(NEW)}) s) d""",
)
def stored_merges(spark, sf_dir):
    """The same merges through stored tables: create if absent, append, staged rewrites."""
    old, new = old_new(spark, sf_dir)
    merges = {
        "inserted": writers.append_absent,
        "upserted": writers.merge_upsert,
        "replaced": writers.merge_delete_insert,
    }
    results = []
    for kind, merge in merges.items():
        target = new_path(spark, kind)
        writers.create_if_absent(old, target)
        writers.overwrite(old, target)
        merge(new, target, KEYS)
        results.append(spark.read.parquet(target).withColumn("kind", F.lit(kind)))
    return results[0].unionByName(results[1]).unionByName(results[2])
