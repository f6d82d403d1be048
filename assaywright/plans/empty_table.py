"""The table-empty rule: one summary row and one detail row when a table holds no record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from .table_check import DETAIL_COLUMNS, SUMMARY_COLUMNS

# Fixed values of the table-empty rule.
ABOUT = {
    "attribute_name": "All Columns",
    "dimension": "completeness",
    "rule_id": "DQ_000",
    "rule_type": "Data Quality",
    "applied_rule": "Table Empty Check",
    "rule_description": "Table has no data",
}
DETAIL_TEXT = "Table is empty"
DETAIL_JSON = '{"message": "Table is empty"}'


def when_empty(df: DataFrame) -> DataFrame:
    """One row with no meaning beyond its presence, if and only if the frame is empty."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") == 0)


def empty_summary(df: DataFrame, place: dict, batch_id: int, run_date: str, layer: str | None = None) -> DataFrame:
    """``place`` gives object, system, sub_system and domain."""
    shaped = _described(when_empty(df), place, batch_id, run_date).withColumns(
        {
            "total_record_count": F.lit(0).cast("long"),
            "no_of_complete_records": F.lit(0).cast("long"),
            "total_passed_count": F.lit(0).cast("long"),
            "no_of_failures": F.lit(1).cast("long"),
            "value": F.lit(0.0),
        }
    )
    return _finished(shaped, SUMMARY_COLUMNS, layer)


def empty_detail(
    df: DataFrame, place: dict, composite_columns: Sequence[str], batch_id: int, run_date: str, layer: str | None = None
) -> DataFrame:
    keys = [c.strip() for c in composite_columns]
    unpacked = {}
    for i in range(K.UNPACKED_KEYS):
        unpacked[f"key{i + 1}"] = F.lit(keys[i] if i < len(keys) else "")
        unpacked[f"value{i + 1}"] = F.lit("")
    shaped = _described(when_empty(df), place, batch_id, run_date).withColumns(
        {
            "rule_json": F.lit(DETAIL_JSON),
            "category": F.lit("completeness"),
            "critical_attribute": F.lit(""),
            "model_integrity": F.lit(""),
            "source_table_attributes": F.lit("{}"),
            "result": F.lit(1),
            "rule_violation_details": F.lit(DETAIL_TEXT),
            "value": F.lit(""),
            "key_columns": F.lit("-".join(keys)),
            "values_of_key_columns": F.lit(""),
            **unpacked,
        }
    )
    return _finished(shaped, DETAIL_COLUMNS, layer)


def _described(one: DataFrame, place: dict, batch_id: int, run_date: str) -> DataFrame:
    texts = {name: F.lit(value) for name, value in {**ABOUT, **place}.items()}
    return one.withColumns(
        {
            **texts,
            "year_id": F.lit(None).cast("int"),
            "batch_id": F.lit(batch_id).cast("int"),
            "rule_run_date": F.lit(run_date),
        }
    )


def _finished(shaped: DataFrame, columns: Sequence[str], layer: str | None) -> DataFrame:
    keyed = shaped.withColumn("unique_key", K.row_group_key())
    keyed = keyed.withColumn("rule_run_date", F.col("rule_run_date").cast("timestamp"))
    result = keyed.select(*columns)
    return result if layer is None else result.withColumn("lakehouse_layer", F.lit(layer))
