import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame from a schema text and rows."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def flag_of(frame):
    """Flags of one rule over single-column text values, in order."""
    from assaywright.plans.table_check import TableCheck

    def run(rule, values):
        df = frame("n int, v string", *enumerate(values))
        rows = TableCheck(df, [], "2026-01-01 00:00:00").flags(rule).collect()
        by_n = {int(r["n"]): (r["rule_violation_flag"], r["rule_violation_details"]) for r in rows}
        return [by_n[i] for i in range(len(values))]

    return run
