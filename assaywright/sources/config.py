"""Rule configuration files: CSV tables with fixed schemas and the framework's JSON settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = (
    "rule_id string, system string, rule_name string, dimension string, sub_system string, domain string,"
    " rule_description string, version int, rule_json_path string, is_active int, is_template int, rule_type string"
)
BINDINGS = (
    "rule_id string, rule_type string, system string, sub_system string, domain string, database_name string,"
    " table_name string, columns string, composite_columns string, reference_database string,"
    " reference_table_name string, reference_columns string, critical_attribute string, model_integrity string,"
    " version int, is_active int"
)
THRESHOLDS = (
    "rule_id string, system string, sub_system string, domain string, version int, is_active int,"
    " thresholdvalue string, rule_type string"
)
SETTINGS = "domain_specific_columns array<string>"


def read_config_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headed CSV read with its schema given, so the file is read once and types never drift."""
    reader = spark.read.option("header", True).option("enforceSchema", True).option("escape", '"')
    return reader.option("multiLine", True).schema(schema).csv(path)


def with_audit(df: DataFrame, source: str, user: str = "SYSTEM", day=None) -> DataFrame:
    """Columns that tell when, by whom and from where a configuration row was loaded."""
    today = F.current_date() if day is None else F.lit(day).cast("date")
    return df.withColumns(
        {
            "created_date": today,
            "created_by": F.lit(user),
            "updated_date": today,
            "updated_by": F.lit(user),
            "source": F.lit(source),
        }
    )


def read_settings(spark: SparkSession, path: str) -> dict:
    """The first settings object of a JSON file or folder; an empty one is an error."""
    row = spark.read.schema(SETTINGS).option("multiLine", True).json(path).first()
    if row is None or row["domain_specific_columns"] is None:
        raise ValueError(f"no settings found in {path}")
    return row.asDict()
