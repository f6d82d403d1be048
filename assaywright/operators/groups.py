"""Group aggregates: duplicates, conditional aggregates, HAVING on groups.

Aggregation always runs per key with a map-side partial step; rows are never
gathered per key.  The result is small (keys, not rows) and is joined back by
``joins.join_keyed`` only where row-level output is wanted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..conditions import Sql
from ..functions.predicates import holds_or_false
from ..functions.text import named
from ..rules import Calculation
from . import selection
from .joins import ROWS

#: Per lower-case column name, the column that holds the value in its own type, and that type.
Typed = Mapping[str, tuple[str, str]]
NUMERIC = ("sum", "avg", "mean", "stddev", "stddev_samp", "stddev_pop", "variance", "var_samp", "var_pop")
#: Computed by ranks over counted values (``selection``) and not by an aggregate that would hold a group.
SELECTED = ("median", "percentile", "mode")
MEMBER_FUNCTIONS = ("collect_list", "collect_set", "array_agg", "listagg", "string_agg")


def aggregate_column(calc: Calculation, thresholds: Mapping | None = None, typed: Typed | None = None) -> Column:
    """One aggregate as a column.  A conditional aggregate over no matching row is NULL.

    Sums of columns that ``typed`` names as whole or decimal are exact; other numbers are added as doubles.
    """
    typed = typed or {}
    if is_selected(calc):
        raise ValueError(f"{calc.function} is found by group_facts, not by one aggregate")
    function = calc.function.strip().lower()
    if function in MEMBER_FUNCTIONS:
        raise ValueError(
            f"{calc.function} would hold a whole group in one task; "
            "use count_distinct for its size or group_members for its values"
        )
    every = calc.column == "*"
    value = F.lit(1) if every else named(calc.column)
    if calc.where is None:
        return _plain(function, value, calc, typed).alias(calc.alias)
    chosen = _chosen(calc, thresholds, typed)
    if function in ("count_distinct", "countdistinct", "approx_count_distinct", "count"):
        result = _plain(function, F.when(chosen, value), calc, typed)
        return F.when(F.count_if(chosen) > 0, result).alias(calc.alias)
    if function in ("first", "last"):
        return _edge(function, value, calc, chosen).alias(calc.alias)
    return _plain(function, F.when(chosen, value), calc, typed, chosen).alias(calc.alias)


def _chosen(calc: Calculation, thresholds: Mapping | None, typed: Typed) -> Column:
    if isinstance(calc.where, Sql):
        return F.coalesce(F.expr(calc.where.text), F.lit(False))
    return holds_or_false(calc.where, thresholds, typed)


def number_of(value: Column, function: str, kind: tuple[str, str] | None) -> Column:
    """What a numeric aggregate reads: exact decimals for sums of exact columns, doubles otherwise."""
    if function == "sum" and kind is not None and kind[1] == "bigint":
        return value.try_cast("decimal(28,0)")
    if function == "sum" and kind is not None and kind[1].startswith("decimal"):
        return value.try_cast(kind[1])
    return F.trim(value.cast("string")).try_cast("double")


def _plain(function: str, value: Column, calc: Calculation, typed: Typed, chosen: Column | None = None) -> Column:
    if function in ("count_distinct", "countdistinct"):
        return F.count_distinct(value)
    if function == "approx_count_distinct":
        return F.approx_count_distinct(value)
    if function in ("first", "last"):
        return _edge(function, value, calc, None)
    if function == "count":
        return F.count(value)
    if function in NUMERIC:
        kind = typed.get(calc.column.lower())
        if kind is not None and function == "sum" and kind[1] != "double":
            exact = F.col(kind[0])
            value = exact if chosen is None else F.when(chosen, exact)
        value = number_of(value, function, kind)
    return getattr(F, function)(value)


def _edge(function: str, value: Column, calc: Calculation, chosen: Column | None) -> Column:
    if calc.order_by is None:
        picker = F.first if function == "first" else F.last
        if chosen is None:
            return picker(value)
        return picker(F.when(chosen, F.struct(value)), ignorenulls=True).getField(0)
    order = F.struct(named(calc.order_by), value)
    picker = F.min_by if function == "first" else F.max_by
    return picker(value, order if chosen is None else F.when(chosen, order))


def group_facts(
    rows: DataFrame,
    keys: Mapping[str, Column],
    calculations: Sequence[Calculation],
    thresholds: Mapping | None = None,
    typed: Typed | None = None,
) -> DataFrame:
    """One row per key: the aggregates and ``__n``, the number of rows behind the key.

    Quantiles and modes are found on their own, without a group in one task, and joined.
    """
    grouped = rows.groupBy(*[value.alias(name) for name, value in keys.items()])
    columns = [aggregate_column(c, thresholds, typed) for c in calculations if not is_selected(c)]
    facts = grouped.agg(F.count(F.lit(1)).alias(ROWS), *columns)
    for calc in calculations:
        if is_selected(calc):
            found = selected_facts(rows, keys, calc, thresholds, typed)
            other = [f"{k}_s" for k in keys]
            found = found.withColumnsRenamed(dict(zip(keys, other)))
            facts = facts.join(found, selection.same_keys(list(keys), other), "left").drop(*other)
    return facts.select(*keys, ROWS, *[named(c.alias) for c in calculations])


def is_selected(calc: Calculation) -> bool:
    return calc.function.strip().lower() in SELECTED


def selected_facts(
    rows: DataFrame, keys: Mapping[str, Column], calc: Calculation, thresholds: Mapping | None, typed: Typed | None
) -> DataFrame:
    """The quantile or mode of each group: the keys and the value under its name."""
    function, chosen = calc.function.strip().lower(), rows
    if calc.where is not None:
        chosen = rows.where(_chosen(calc, thresholds, typed or {}))
    shown = [value.alias(name) for name, value in keys.items()]
    if function == "mode":
        return selection.group_modes(chosen.select(*shown, named(calc.column).alias("__value")), list(keys), "__value", calc.alias)
    number = F.trim(named(calc.column).cast("string")).try_cast("double").alias("__value")
    point = 0.5 if function == "median" else calc.at
    if point is None or not 0 <= point <= 1:
        raise ValueError(f"{calc.alias}: a percentile needs its place, at=0 to 1")
    return selection.group_quantiles(chosen.select(*shown, number), list(keys), "__value", {calc.alias: point})


def counted_groups(rows: DataFrame, keys: Mapping[str, Column], slices: Sequence[str]) -> DataFrame:
    """Row counts per key and slice (year, batch), with rows of NULL keys left out."""
    shaped = rows.select(*[value.alias(name) for name, value in keys.items()], *slices)
    return (
        shaped.where(_all_present(keys)).groupBy(*keys, *slices).agg(F.count(F.lit(1)).alias(ROWS))
    )


def only_counts_rows(calculations: Sequence[Calculation]) -> bool:
    return all(c.function.lower() == "count" and c.column == "*" and c.where is None for c in calculations)


def failing_groups(
    rows: DataFrame,
    keys: Mapping[str, Column],
    slices: Sequence[str],
    calculations: Sequence[Calculation],
    having,
    thresholds: Mapping | None = None,
    typed: Typed | None = None,
) -> DataFrame:
    """Groups whose aggregates satisfy ``having``: keys, slices, ``__n`` and the aggregates.

    Without slices one aggregate per key settles it.  With them, counting rules
    still need one pass: per-slice counts are summed per key over already
    aggregated groups, whose number per key is the number of slices.
    """
    counts = counted_groups(rows, keys, slices)
    if only_counts_rows(calculations) and not slices:
        facts = counts.withColumns({c.alias: F.col(ROWS) for c in calculations})
        return facts.where(holds_or_false(having, thresholds))
    if only_counts_rows(calculations):
        total = F.sum(ROWS).over(Window.partitionBy(*keys))
        facts = counts.withColumns({c.alias: total for c in calculations})
        return facts.where(holds_or_false(having, thresholds))
    if not slices:
        facts = group_facts(rows, keys, calculations, thresholds, typed)
        return facts.where(_all_present(keys) & holds_or_false(having, thresholds))
    facts = group_facts(rows, keys, calculations, thresholds, typed).drop(ROWS)
    return counts.join(facts.where(holds_or_false(having, thresholds)), list(keys), "inner")


def group_members(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Distinct values of a column per group, one row each, with the copies of each.

    The distributed form of collecting a list or set per group: no group is held in one task.
    """
    return rows.groupBy(*[named(k) for k in keys], named(column)).agg(F.count(F.lit(1)).alias("copies"))


def _all_present(keys: Mapping[str, Column]) -> Column:
    test = None
    for name in keys:
        pair = F.col(name).isNotNull()
        test = pair if test is None else test & pair
    return test
