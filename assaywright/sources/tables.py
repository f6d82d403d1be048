"""Target tables: batch slice, year slice and sub-source slice, filtered before any cast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import as_text, named


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet folder when the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def slice_table(
    df: DataFrame, load_date: int | str = 0, year_id: int = 0, sub_source: str | None = None
) -> DataFrame:
    """The part of a table one run looks at; 0 means no filter, as does a table without the column.

    Filters compare in the column's own type, so they reach the file scan and
    prune partitions.  ``year_id`` is added as NULL where the table has none.
    """
    names = {c.lower() for c in df.columns}
    if str(load_date) != "0" and "load_date" in names:
        df = df.where(named("load_date") == _typed(df, "load_date", load_date))
    if "year_id" not in names:
        df = df.withColumn("year_id", F.lit(None).cast("string"))
    elif year_id:
        df = df.where(named("year_id") == _typed(df, "year_id", year_id))
    return df if sub_source is None else slice_sub_source(df, sub_source)


def slice_sub_source(df: DataFrame, sub_source: str) -> DataFrame:
    """Rows of one sub-source; if it has none, every row with ``sub_source`` emptied.

    The presence test stops at the first matching row.
    """
    wanted = F.upper(named("sub_source")) == sub_source.upper()
    if df.where(wanted).isEmpty():
        return df.withColumn("sub_source", F.lit(None).cast("string"))
    return df.where(wanted)


def text_table(df: DataFrame, **slices) -> DataFrame:
    return as_text(slice_table(df, **slices))


def _typed(df: DataFrame, name: str, value):
    kind = next(kind for column, kind in df.dtypes if column.lower() == name)
    return F.lit(str(value)).cast(kind)
