"""Deterministic dirty projections of the (clean) test tables; the same SQL runs in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

CUSTOMER_DIRTY = """
select c_custkey, c_nationkey, cast(20241225 as int) as load_date, cast(2020 + c_custkey % 3 as int) as year_id,
 case when c_custkey % 7 < 4 then 'north' when c_custkey % 7 < 6 then 'NORTH' else 'south' end as sub_source,
 case c_custkey % 13 when 0 then null when 1 then '' when 2 then '   ' when 3 then ' null ' when 4 then chr(9)
   else c_mktsegment end as segment_raw,
 case c_custkey % 6 when 0 then concat('user', cast(c_custkey as string), '@mail.com')
   when 1 then concat('user', cast(c_custkey as string), '@mail.info') when 2 then 'no-at-sign.com' when 3 then null
   when 4 then ' a.b@x.org ' else concat('u@', cast(c_custkey as string)) end as email_raw,
 case c_custkey % 6 when 0 then '+971 50 123 4567' when 1 then '00971-4-123-4567' when 2 then '0501234567'
   when 3 then '12345' when 4 then null else '+1 202 555 0100' end as phone_raw,
 case c_custkey % 6 when 0 then 'Male' when 1 then ' female ' when 2 then 'MIXED' when 3 then 'M'
   when 4 then 'Unknown' else null end as gender_raw,
 case c_custkey % 9 when 0 then null when 1 then '784-19A0-1234567-1' when 2 then '78419901234'
   when 3 then concat('123', lpad(cast(c_custkey as string), 12, '0'))
   else concat('784-', cast(1950 + c_custkey % 90 as string), '-', lpad(cast(c_custkey as string), 7, '0'), '-',
     cast(c_custkey % 10 as string)) end as national_id_raw,
 case c_custkey % 5 when 0 then cast(1950 + c_custkey % 90 as string) || '-02-03'
   when 1 then '03-02-' || cast(1950 + c_custkey % 90 as string)
   when 2 then '03-02-' || cast(1951 + c_custkey % 90 as string) || ' 10:11:12' when 3 then 'unknown'
   else null end as dob_raw,
 case c_custkey % 5 when 0 then c_name when 1 then 'Mary-Ann Smith' when 2 then 'مدرسة دبي' when 3 then 'Ann3'
   else 'OConnor ' end as name_raw
from {customer}
"""

ORDERS_DIRTY = """
select o_orderkey,
 case when o_orderkey % 17 = 0 then o_custkey + 1000000 when o_orderkey % 19 = 0 then null
   else o_custkey end as custkey_raw,
 case o_orderkey % 8 when 0 then concat('2020-', lpad(cast(1 + o_orderkey % 12 as string), 2, '0'), '-',
     lpad(cast(1 + o_orderkey % 31 as string), 2, '0'))
   when 1 then '20200131' when 2 then '2020-02-31' when 3 then '31-01-2020' when 4 then '2020-01-31 10:11:12.123'
   when 5 then '2020-01-31T10:11:12Z' when 6 then '2020/01/31' else null end as date_raw,
 case o_orderkey % 6 when 0 then '12' when 1 then '-3.5' when 2 then '1e5' when 3 then ' 42 ' when 4 then 'abc'
   else null end as number_raw,
 case when o_orderkey % 2 = 0 then o_orderstatus else lower(concat(' ', o_orderstatus, ' ')) end as status_raw,
 o_totalprice
from {orders}
"""

PART_DIRTY = """
select p_partkey, p_size,
 case p_partkey % 7 when 0 then 'British' when 1 then ' moe ' when 2 then 'Klingon' when 3 then null
   when 4 then 'AL HOSN' when 5 then 'uae after school' else p_brand end as curriculum_raw,
 case p_partkey % 9 when 0 then 'AE' when 1 then ' in ' when 2 then 'ZZ' when 3 then 'Unknown' when 4 then 'GL'
   when 5 then 'C' when 6 then 'YU' when 7 then '' else upper(substr(p_type, 1, 2)) end as nationality_raw,
 case p_partkey % 6 when 0 then 'Single' when 1 then ' widow ' when 2 then 'DIVORCED' when 3 then 'Engaged'
   when 4 then 'null' else 'Married' end as marital_raw,
 case p_partkey % 5 when 0 then 'kg1' when 1 then 'Pre Primary -G5' when 2 then 'Others' when 3 then null
   else concat('Grade ', cast(1 + p_size % 15 as string)) end as grade_raw,
 case p_partkey % 5 when 0 then 'Dubai' when 1 then ' ajman' when 2 then 'Fujairah' when 3 then 'UMM AL QUWAIN'
   else null end as emirate_raw,
 case p_partkey % 5 when 0 then p_brand when 1 then concat('A_', cast(p_partkey as string), '/x-1') when 2 then 'a b'
   when 3 then ' abc ' else null end as code_raw
from {part}
"""

# Configuration tables derived from the test tables, so that they grow with them.
BINDINGS = """
select concat('DQ_', lpad(cast(1 + p_partkey % 22 as string), 3, '0')) as rule_id,
 case when p_size = 1 then 'AUDIT' else 'Data Quality' end as rule_type,
 case p_partkey % 3 when 0 then 'services' when 1 then 'Services' else 'GE' end as system,
 case p_partkey % 2 when 0 then 'NQC' else 'moe-public' end as sub_system,
 case p_partkey % 5 when 0 then null else p_type end as domain,
 case when p_size = 2 then '  ' when p_size = 3 then null else 'lake' end as database_name,
 case p_partkey % 4 when 0 then concat('silver_', p_brand) when 1 then concat('x_BNZ_', p_brand)
   else concat('gold_', p_brand) end as table_name,
 case p_partkey % 6 when 0 then concat('A_', p_brand, ', b') when 1 then concat('a_', p_brand)
   when 2 then concat('A_', p_brand) when 3 then ' x , y,z ' when 4 then 'k1,k2' else '' end as columns,
 case p_partkey % 3 when 0 then 'k1,k2' when 1 then 'k1' else null end as composite_columns,
 case when p_size % 4 = 0 then null else 'lake' end as reference_database,
 case when p_size % 4 = 1 then ' ' else 'master' end as reference_table_name,
 case p_partkey % 3 when 0 then 'r1,r2' when 1 then 'r1' else 'r1 , r2 , r3' end as reference_columns,
 case p_partkey % 4 when 0 then 'yes,no' when 1 then 'yes' else null end as critical_attribute,
 case p_partkey % 5 when 0 then 'high' else null end as model_integrity,
 1 as version, case when p_size > 48 then 0 else 1 end as is_active
from {part}
"""

RULES = """
select concat('DQ_', lpad(cast(1 + p_partkey % 22 as string), 3, '0')) as rule_id, min('Data Quality') as rule_type,
 min('services') as system, min('NQC') as sub_system, min(p_type) as domain, min(p_brand) as rule_name,
 max(p_brand) as rule_description, 1 as is_active, 1 as is_template
from {part} group by 1
"""

THRESHOLDS = """
select distinct concat('DQ_', lpad(cast(1 + s_suppkey % 22 as string), 3, '0')) as rule_id,
 'Data Quality' as rule_type, 'services' as system, case when s_nationkey % 2 = 0 then 'NQC' end as sub_system,
 d.domain, 1 as is_active,
 concat('{{"max_total": "', cast(s_nationkey as string), '", "min_total": "1"}}') as thresholdvalue
from {supplier} s join (select min(p_type) as domain from {part}) d on s_suppkey is not null
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A projection above as a Spark frame, reading only the tables it names."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


def duck(text: str) -> str:
    """The same projection for DuckDB, where the tables are views."""
    return text.format(**{name: name for name in TABLES})
