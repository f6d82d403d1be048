"""Column profile, outlier bounds and timeliness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_text, is_missing, named


def column_profile(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """One row per column from one pass: counts, text lengths, numeric range, moments and quartiles.

    Every measure is a mergeable aggregate, so the pass shuffles one row per task.
    """
    text = as_text(df.select(*[named(c) for c in columns]))
    aggregates, entries = [F.count(F.lit(1)).alias("rows")], []
    for i, name in enumerate(columns):
        value = named(name)
        present = F.when(~is_missing(value), F.trim(value))
        number = present.try_cast("double")
        measures = {
            "missing": F.count_if(is_missing(value)),
            "approx_distinct": F.approx_count_distinct(present),
            "min_text": F.min(present),
            "max_text": F.max(present),
            "min_length": F.min(F.length(present)),
            "max_length": F.max(F.length(present)),
            "numbers": F.count(number),
            "min_number": F.min(number),
            "max_number": F.max(number),
            "mean": F.avg(number),
            "stddev": F.stddev_samp(number),
            "quartiles": F.percentile_approx(number, [0.25, 0.5, 0.75], accuracy),
        }
        aggregates += [measure.alias(f"{label}_{i}") for label, measure in measures.items()]
        entries.append(
            F.struct(F.lit(name).alias("column"), *[F.col(f"{label}_{i}").alias(label) for label in measures])
        )
    return text.agg(*aggregates).select("rows", F.inline(F.array(*entries)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, copies) for every distinct value; missing values are left out."""
    text = as_text(df.select(*[named(c) for c in columns]))
    pairs = [F.struct(F.lit(c).alias("column"), F.trim(named(c)).alias("value")) for c in columns]
    long = text.select(F.inline(F.array(*pairs))).where(~is_missing(F.col("value")))
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("copies"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column, counted over already distinct values."""
    counted = value_counts(df, columns)
    return counted.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def top_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values of each column, ties broken by the value.

    The rank filter lets Spark keep k rows per task and column before the shuffle.
    """
    return _top(value_counts(df, columns), k)


def text_shape(value: Column) -> Column:
    """Letters become A or a, digits 9; other characters stay."""
    shape = F.regexp_replace(value, r"[A-Z]", "A")
    shape = F.regexp_replace(shape, r"[a-z]", "a")
    return F.regexp_replace(shape, r"[0-9]", "9")


def top_shapes(df: DataFrame, columns: Sequence[str], k: int = 1) -> DataFrame:
    """The k most frequent text shapes of each column."""
    shaped = df.select(*[text_shape(F.trim(named(c).cast("string"))).alias(c) for c in columns])
    return _top(value_counts(shaped, columns), k)


def _top(counted: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("column").orderBy(F.desc("copies"), F.asc("value"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def zscore_outliers(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Rows farther than ``limit`` standard deviations from the mean; adds ``deviation``."""
    number = named(column).try_cast("double")
    facts = df.agg(F.avg(number).alias("mean"), F.stddev_samp(number).alias("spread"))
    deviation = (number - facts.select("mean").scalar()) / facts.select("spread").scalar()
    return df.withColumn("deviation", deviation).where(F.abs("deviation") > limit)


def iqr_outliers(df: DataFrame, column: str, reach: float = 1.5, accuracy: int = 10_000) -> DataFrame:
    """Rows outside the quartiles by more than ``reach`` times their distance."""
    number = named(column).try_cast("double")
    facts = df.agg(F.percentile_approx(number, [0.25, 0.75], accuracy).alias("q")).select(
        F.col("q")[0].alias("low"), F.col("q")[1].alias("high")
    )
    low, high = facts.select("low").scalar(), facts.select("high").scalar()
    distance = (high - low) * reach
    return df.where((number < low - distance) | (number > high + distance))


def timeliness(df: DataFrame, event_time: str, arrival_time: str, max_delay: str) -> DataFrame:
    """Flag per row: -1 where a time is absent, 1 where arrival is early or later than ``max_delay``."""
    event, arrival = named(event_time), named(arrival_time)
    late = (arrival > event + F.expr(f"interval {max_delay}")) | (arrival < event)
    flag = F.when(event.isNull() | arrival.isNull(), F.lit(-1)).when(late, F.lit(1)).otherwise(F.lit(0))
    return df.withColumn("rule_violation_flag", flag)
