"""Steps that change how many rows a rule sees: enrichment joins and distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.text import as_text
from ..rules import Enrich
from .joins import SizeLimit, one_per_key, spread_join


def enrich(rows: DataFrame, table: DataFrame, spec: Enrich, limit: SizeLimit, paths: list[str]) -> DataFrame:
    """Join a side table, compared as text like the rows themselves."""
    return spread_join(rows, as_text(table), spec.columns, spec.how, limit, paths=paths)


def distinct_rows(rows: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Distinct rows, or one row per value of ``columns`` (the smallest record survives)."""
    return one_per_key(rows, columns) if columns else rows.distinct()
