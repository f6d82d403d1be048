"""Column profiles and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaywright.operators import profile as P
from assaywright.operators import sketches
from assaywright.operators.storage import new_path

from . import sql as S
from .fixtures import CUSTOMER_DIRTY, ORDERS_DIRTY, duck, from_sql, table
from .registry import query

PROFILED = ("number_raw", "status_raw", "o_totalprice", "custkey_raw")
ORDERS = duck(ORDERS_DIRTY)


def profile_sql(column: str) -> str:
    text = f"cast({column} as varchar)"
    present = f"case when not {S.missing(column)} then trim({text}) end"
    return f"""select rows, '{column}' as "column", missing, min_text, max_text, min_length, max_length, numbers,
 min_number, max_number, round(mean, 4) as mean, round(stddev, 4) as stddev from (
 select count(*) as rows, count(*) filter (where p is null) as missing, min(p) as min_text, max(p) as max_text,
  cast(min(length(p)) as int) as min_length, cast(max(length(p)) as int) as max_length,
  count(try_cast(p as double)) as numbers, min(try_cast(p as double)) as min_number,
  max(try_cast(p as double)) as max_number, avg(try_cast(p as double)) as mean,
  stddev_samp(try_cast(p as double)) as stddev from (select {present} as p from ({ORDERS}) o) x) y"""


@query("profile_columns", " union all ".join(f"({profile_sql(c)})" for c in PROFILED))
def profile_columns(spark, sf_dir):
    profile = P.column_profile(from_sql(spark, sf_dir, ORDERS_DIRTY), PROFILED)
    rounded = {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    return profile.withColumns(rounded).drop("approx_distinct", "quartiles")


EXACT_DISTINCT = " union all ".join(
    f"""select '{c}' as "column", count(distinct case when not {S.missing(c)} then trim(cast({c} as varchar)) end)
 as distinct_values from ({ORDERS}) o"""
    for c in PROFILED
)
WITHIN = f"""select "column", distinct_values, true as distinct_within_bound, true as quartiles_within_bound
 from ({EXACT_DISTINCT}) d"""


def within(orders, profile, distinct_error, rank_error):
    """Sketched measures next to exact ones: whether each is within its bound."""
    estimates = profile.select("column", "approx_distinct", "quartiles")
    exact = P.distinct_counts(orders, PROFILED)
    found = estimates.join(exact, "column").join(sketches.rank_errors(orders, estimates), "column")
    off = F.abs(F.col("approx_distinct") - F.col("distinct_values"))
    return found.select(
        "column",
        "distinct_values",
        (off <= F.col("distinct_values") * distinct_error).alias("distinct_within_bound"),
        (F.col("rank_error") <= rank_error).alias("quartiles_within_bound"),
    )


@query("profile_sketches", WITHIN)
def profile_sketches(spark, sf_dir):
    """Approximate distinct counts within three times their standard error of 5 %, quartiles within 1 / accuracy."""
    orders = from_sql(spark, sf_dir, ORDERS_DIRTY)
    return within(orders, P.column_profile(orders, PROFILED), 0.15, 1e-4)


@query(
    "profile_merged",
    f"""select p."column", rows, missing, min_text, max_text, min_length, max_length, numbers, min_number, max_number,
 mean, stddev, distinct_values, distinct_within_bound, quartiles_within_bound
 from ({" union all ".join(f"({profile_sql(c)})" for c in PROFILED)}) p join ({WITHIN}) w on p."column" = w."column\"""",
)
def profile_merged(spark, sf_dir):
    """Profiles of seven batches, stored in two runs, one of them twice, and merged without the rows."""
    orders, target = from_sql(spark, sf_dir, ORDERS_DIRTY), new_path(spark, "profile")
    dealt = orders.withColumn("batch", F.col("o_orderkey") % 7)
    for run, share in (("early", "batch < 3"), ("late", "batch >= 3"), ("late", "batch >= 3")):
        sketches.store_parts(dealt.where(share), PROFILED, target, run, ["batch"])
    profile = sketches.stored_profile(spark, target)
    checked = within(orders, profile, sketches.DISTINCT_ERROR, sketches.RANK_ERROR)
    rounded = {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    return profile.withColumns(rounded).drop("approx_distinct", "quartiles").join(checked, "column")


def counted(columns, base, expression="trim(cast({c} as varchar))") -> str:
    return " union all ".join(
        f"""select '{c}' as "column", {expression.format(c=c)} as value, count(*) as copies from ({base}) b
 where not {S.missing(c)} group by 2"""
        for c in columns
    )


CUSTOMERS = duck(CUSTOMER_DIRTY)
COUNTED = ("segment_raw", "email_raw", "gender_raw", "year_id")
TOP = """select "column", value, copies, cast(rank as int) as rank from (select *, row_number() over
 (partition by "column" order by copies desc, value) as rank from ({})) t where rank <= {}"""
SHAPE = r"regexp_replace(regexp_replace(regexp_replace(trim(cast({c} as varchar)), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '9', 'g')"


@query("profile_value_counts", counted(COUNTED, CUSTOMERS))
def value_counts(spark, sf_dir):
    return P.value_counts(from_sql(spark, sf_dir, CUSTOMER_DIRTY), COUNTED)


@query(
    "profile_distinct",
    f"""select "column", count(*) as distinct_values from ({counted(COUNTED, CUSTOMERS)}) group by 1""",
)
def distinct_counts(spark, sf_dir):
    return P.distinct_counts(from_sql(spark, sf_dir, CUSTOMER_DIRTY), COUNTED)


@query("profile_top_values", TOP.format(counted(("l_quantity", "l_shipdate", "l_suppkey"), "from lineitem".replace(
    "from ", "select * from ")), 5))
def top_values(spark, sf_dir):
    return P.top_values(table(spark, sf_dir, "lineitem"), ("l_quantity", "l_shipdate", "l_suppkey"), 5)


@query("profile_shapes", TOP.format(counted(("phone_raw", "email_raw", "c_custkey"), CUSTOMERS, SHAPE), 2))
def top_shapes(spark, sf_dir):
    return P.top_shapes(from_sql(spark, sf_dir, CUSTOMER_DIRTY), ("phone_raw", "email_raw", "c_custkey"), 2)


@query(
    "outliers_zscore",
    """select o_orderkey, o_custkey, o_totalprice, round((o_totalprice - m) / s, 6) as deviation from orders,
 (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from orders) f
 where abs((o_totalprice - m) / s) > 1.7""",
)
def outliers_zscore(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.zscore_outliers(orders, "o_totalprice", 1.7).withColumn("deviation", F.round("deviation", 6))


@query(
    "outliers_iqr",
    """select event_id, value from events, (select quantile_disc(value, 0.25) as low, quantile_disc(value, 0.75)
 as high from events) q where value < low - (high - low) * 1.5 or value > high + (high - low) * 1.5""",
)
def outliers_iqr(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return P.iqr_outliers(events, "value", accuracy=1_000_000)
