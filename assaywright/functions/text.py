"""Text view of a table and the missing-value test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """Column by literal name: spaces, dots and dashes in the name are safe."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_columns(df: DataFrame) -> list[Column]:
    """Every column of the frame as a string column of the same name."""
    return [
        named(name) if kind == "string" else named(name).cast("string").alias(name) for name, kind in df.dtypes
    ]


def as_text(df: DataFrame) -> DataFrame:
    """Every non-string column cast to string, once, in one projection."""
    return df.select(*text_columns(df))


def is_missing(value: Column) -> Column:
    """NULL, blank or the word NULL, after trimming spaces (a tab is not a space)."""
    trimmed = F.trim(value)
    return F.coalesce((trimmed == "") | (F.upper(trimmed) == "NULL"), F.lit(True))


def missing_message(columns: Sequence[str]) -> Column:
    names = F.concat_ws(",", *[F.when(is_missing(named(c)), F.lit(c)) for c in columns])
    return F.concat(F.lit("missing value for fields: "), names)


def lookup_key(value: Column) -> Column:
    """Reference lookups compare trimmed text without regard to case."""
    return F.upper(F.trim(value.cast("string")))
