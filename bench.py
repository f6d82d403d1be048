"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to the no-op sink in full; the better of two runs counts.
``branch_per_rule_lineitem`` is the comparison plan: the same rules as
``single_pass_lineitem``, one branch over the cached text table per rule, united
and summarised.  It is reported beside the queries and not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from assaywright.functions.text import as_text  # noqa: E402
from assaywright.plans.table_check import TableCheck  # noqa: E402
from suite import sql as S  # noqa: E402
from suite.all import QUERIES  # noqa: E402
from suite.fixtures import table  # noqa: E402
from suite.results import LINE_RULES  # noqa: E402

HEADLINES = (
    "completeness_customer", "single_pass_lineitem", "summary_log", "detail_log", "email", "date_multi", "national_id",
    "condition_group", "duplicate_composite_key", "duplicate_single_key", "agg_having", "conditional_agg",
    "fk_integrity_orders_customer", "composite_fk", "enriched_rule", "batch_run", "rule_expansion", "delete_insert",
    "profile_columns", "profile_top_values", "outliers_zscore", "stream_daily_summary",
)


def branch_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = as_text(table(spark, sf_dir, "lineitem")).persist()
    branches = [
        TableCheck(rows, [], S.RUN_DATE, S.BATCH)
        .flags(rule)
        .select(F.lit(i).alias("rule"), "rule_violation_flag", F.struct(*rows.columns).alias("image"))
        for i, rule in enumerate(LINE_RULES)
    ]
    united = reduce(DataFrame.unionByName, branches).withColumn("image", F.to_json("image"))
    united = united.persist()
    return united.groupBy("rule").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("rule_violation_flag") == 0).alias("passed")
    )


def timed(spark: SparkSession, run, sf_dir: str) -> float:
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - started
    spark.catalog.clearCache()
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, QUERIES["email"], sf_dir)
    seconds = {name: round(min(timed(spark, QUERIES[name], sf_dir) for _ in range(2)), 3) for name in HEADLINES}
    compared = round(min(timed(spark, branch_per_rule, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "comparison": {"branch_per_rule_lineitem": compared},
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
