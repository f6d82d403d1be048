"""Exact quantiles and modes of groups of any size.

Equal values of a group are counted first, with a partial step before the
shuffle.  For quantiles the counted values are dealt into ranges of (group,
value), so that a large group lies in many partitions in order; a running total
in two steps (per partition, then of the partitions) gives every value its
ranks, and the two values that a quantile lies between are picked by rank.  No
task holds a group, only a range of counted values.

NULL values take no part; NULL keys are a group of their own; a group without a
value gives NULL.  A tie for the mode goes to the smallest value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

PART, COPIES = "__part", "__copies"


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    tests = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _counted(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    counted = values.where(F.col(value).isNotNull()).groupBy(*keys, value)
    return counted.agg(F.count(F.lit(1)).alias(COPIES))


def group_modes(values: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Per group the most frequent value."""
    best = F.min(F.struct((-F.col(COPIES)).alias("n"), F.col(value).alias("v"))).alias("__best")
    return _counted(values, keys, value).groupBy(*keys).agg(best).select(*keys, F.col("__best.v").alias(name))


def group_quantiles(
    values: DataFrame, keys: Sequence[str], value: str, points: dict[str, float], paths: list[str] | None = None
) -> DataFrame:
    """Per group, by name, the quantile at each point (0 to 1), between two values in proportion.

    ``values`` has the key columns and a double column ``value``.
    """
    paths = [] if paths is None else paths
    ordered = _counted(values, keys, value).repartitionByRange(*keys, value)
    placed = stored(ordered.withColumn(PART, F.spark_partition_id()), paths)
    totals = placed.groupBy(PART, *keys).agg(F.sum(COPIES).alias("__here"))
    of_group = Window.partitionBy(*keys)
    before = F.sum("__here").over(of_group.orderBy(PART)) - F.col("__here")
    totals = totals.withColumns({"__before": before, "__all": F.sum("__here").over(of_group)}).drop("__here")
    renamed = totals.withColumnsRenamed({c: f"{c}_t" for c in (PART, *keys)})
    at = same_keys([PART, *keys], [f"{c}_t" for c in (PART, *keys)])
    joined = placed.join(renamed, at).drop(*[f"{c}_t" for c in (PART, *keys)])
    within = Window.partitionBy(PART, *keys).orderBy(value)
    last = F.col("__before") + F.sum(COPIES).over(within) - 1
    ranked = joined.withColumn("__last", last).withColumn("__first", F.col("__last") - F.col(COPIES) + 1)

    picks, shown = [], []
    for i, (name, point) in enumerate(points.items()):
        place = F.lit(float(point)) * (F.col("__all") - 1)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = (F.col("__first") <= rank) & (rank <= F.col("__last"))
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"__{side}{i}"))
        picks.append(F.max(place - F.floor(place)).alias(f"__share{i}"))
        low, high = F.col(f"__low{i}"), F.col(f"__high{i}")
        share = F.col(f"__share{i}")
        shown.append(F.when(low == high, low).otherwise(low * (1 - share) + high * share).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *shown)
