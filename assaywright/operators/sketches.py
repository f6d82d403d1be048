"""Column profiles kept per batch and merged, so that a table that grows is not read again.

A batch leaves one row per column: counts, ranges, moments, a HyperLogLog sketch
of its distinct values and a KLL sketch of its numbers.  Merging reads these rows
only.  Counts, ranges, mean and deviation are exact; the sketches have the error
bounds below, whatever the number of batches and rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import as_text, is_missing, named
from ..sinks import writers

DISTINCT_BITS = 12
QUANTILE_SIZE = 400
QUARTILES = (0.25, 0.5, 0.75)
#: Relative error of distinct counts: three standard errors of a sketch of 2^12 registers.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)
#: Error of a quantile's rank, as a share of all numbers: twice the sketch's 99 % bound.
RANK_ERROR = 2 * 2.296 / QUANTILE_SIZE**0.9723


def profile_parts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One mergeable row per column, and per value of ``by`` (a batch, a load date), from one pass.

    All measures combine before the shuffle, so a task sends one row per group.
    """
    text = as_text(df.select(*[named(c) for c in dict.fromkeys([*by, *columns])]))
    aggregates, entries = [F.count(F.lit(1)).alias("rows")], []
    for i, name in enumerate(columns):
        value = named(name)
        present = F.when(~is_missing(value), F.trim(value))
        number = present.try_cast("double")
        measures = {
            "missing": F.count_if(is_missing(value)),
            "min_text": F.min(present),
            "max_text": F.max(present),
            "min_length": F.min(F.length(present)),
            "max_length": F.max(F.length(present)),
            "numbers": F.count(number),
            "min_number": F.min(number),
            "max_number": F.max(number),
            "mean": F.avg(number),
            "squares": F.var_pop(number) * F.count(number),
            "distinct_sketch": F.hll_sketch_agg(present, F.lit(DISTINCT_BITS)),
            "number_sketch": F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(QUANTILE_SIZE)),
        }
        aggregates += [measure.alias(f"{label}_{i}") for label, measure in measures.items()]
        entries.append(F.struct(F.lit(name).alias("column"), *[F.col(f"{label}_{i}").alias(label) for label in measures]))
    given = text.groupBy(*[named(c).alias(c) for c in by]).agg(*aggregates)
    return given.select(*[named(c) for c in by], "rows", F.inline(F.array(*entries)))


def merged_profile(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and value of ``by``) over all parts: reads parts, never rows.

    ``approx_distinct`` is within ``DISTINCT_ERROR`` of the true number, and the
    quartiles' ranks are within ``RANK_ERROR`` of theirs.  An empty set of parts
    has an empty profile; a column without numbers has NULL measures of numbers.
    """
    keys = [*[named(c) for c in by], F.col("column")]
    group = W.partitionBy(*keys)
    weight = F.sum(F.col("mean") * F.col("numbers")).over(group) / F.nullif(F.sum("numbers").over(group), F.lit(0))
    known = parts.withColumn("__mean", weight)
    between = F.col("numbers") * F.pow(F.col("mean") - F.col("__mean"), 2)
    found = known.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("rows", "missing", "numbers")],
        *[F.min(c).alias(c) for c in ("min_text", "min_length", "min_number")],
        *[F.max(c).alias(c) for c in ("max_text", "max_length", "max_number")],
        F.first("__mean", True).alias("mean"),
        F.sum(F.col("squares") + between).alias("__squares"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("approx_distinct"),
        F.kll_merge_agg_double("number_sketch").alias("__numbers"),
    )
    spread = F.when(F.col("numbers") > 1, F.sqrt(F.col("__squares") / (F.col("numbers") - 1)))
    counted = F.kll_sketch_get_n_double("__numbers")
    quartiles = F.array(*[F.kll_sketch_get_quantile_double("__numbers", F.lit(p)) for p in QUARTILES])
    found = found.withColumn("stddev", spread).withColumn("quartiles", F.when(counted > 0, quartiles))
    return found.drop("__squares", "__numbers")


def store_parts(df: DataFrame, columns: Sequence[str], target: str, run: str, by: Sequence[str] = ()) -> None:
    """Add a batch's parts to a stored profile; the same run again replaces what it left."""
    writers.publish_run(f"profile-{run}", {target: profile_parts(df, columns, by)}, partitions=())


def stored_profile(spark: SparkSession, target: str, by: Sequence[str] = ()) -> DataFrame:
    return merged_profile(writers.read(spark, target), by)


def rank_errors(df: DataFrame, estimates: DataFrame, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """Per column the largest distance of an estimated quantile's rank from its probability, by exact counts.

    ``estimates``: (column, quartiles), a row per column of the table, so it may be
    broadcast.  A column without numbers has the distance 0.
    """
    names = [r["column"] for r in estimates.select("column").collect()]
    text = as_text(df.select(*[named(c) for c in names]))
    number = [F.when(~is_missing(named(c)), F.trim(named(c))).try_cast("double").alias("number") for c in names]
    long = text.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), n) for c, n in zip(names, number)])))
    met = long.join(F.broadcast(estimates.select("column", "quartiles")), "column")
    quantile = [F.col("quartiles")[i] for i in range(len(probabilities))]
    counts: list[Column] = [F.count("number").alias("n")]
    for i, q in enumerate(quantile):
        counts += [F.count_if(F.col("number") < q).alias(f"below_{i}"), F.count_if(F.col("number") <= q).alias(f"upto_{i}")]
    far = [
        F.greatest(F.lit(0.0), F.col(f"below_{i}") / F.col("n") - p, p - F.col(f"upto_{i}") / F.col("n"))
        for i, p in enumerate(probabilities)
    ]
    error = F.when(F.col("n") > 0, F.greatest(*far)).otherwise(F.lit(0.0))
    return met.groupBy("column").agg(*counts).select("column", error.alias("rank_error"))
