"""Many key rules of one table in one scan and one shuffle.

Every row lists the rules it takes part in, each with the rule's key, so a row is
read once however many duplicate, group and reference rules look at it.  Counts
and aggregates per (rule, key, slice) are partial before the shuffle.  Verdicts
follow on what is left.  Reference rules share a pass of their own, which carries
no aggregates: allowed keys are dealt and grouped with the rows' keys, tagged by
rule, so a key that no allowed one fell in with fails and nothing is joined.

Keys of all rules share columns: whole numbers go to numeric slots, text to text
slots, digests to binary ones; a slot that a rule does not use holds a constant,
so that plain equality joins and groups them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..conditions import Sql, renamed
from ..functions.predicates import holds_or_false
from ..functions.text import named
from ..rules import Calculation
from .groups import Typed, aggregate_column, is_selected, number_of
from .joins import ROWS

RULE = "__rule"
KINDS = ("bigint", "string", "binary")
#: Aggregates that can be put together from the slices of a key.
MERGEABLE = ("count", "sum", "min", "max", "avg", "mean")


@dataclass(frozen=True)
class KeyTask:
    """One rule: its key columns with their types, which rows take part, and what makes a key fail.

    Either ``calculations`` and ``having`` (a group rule) or ``allowed``, a frame of the keys ``__k0``, ``__k1``, ... that pass
    (a key may be there several times).
    """

    number: int
    keys: tuple[tuple[str, Column], ...]
    applicable: Column
    calculations: tuple[Calculation, ...] = ()
    having: object | None = None
    thresholds: tuple = ()
    allowed: DataFrame | None = None


def shareable(calculations: Sequence[Calculation], sliced: bool) -> bool:
    """Whether the aggregates can be computed here: any plain ones without slices, mergeable ones with them."""
    if any(is_selected(c) for c in calculations):
        return False
    return not sliced or all(c.function.strip().lower() in MERGEABLE for c in calculations)


def _slots(tasks: Sequence[KeyTask]) -> list[tuple[str, str]]:
    """Names and types of the shared key columns."""
    most: dict[str, int] = {}
    for task in tasks:
        for kind in KINDS:
            most[kind] = max(most.get(kind, 0), sum(k == kind for k, _ in task.keys))
    return [(f"__{kind}{i}", kind) for kind, n in most.items() for i in range(n)]


def _places(keys) -> list[str]:
    """The slot of each key column."""
    used: dict[str, int] = {}
    out = []
    for kind, _ in keys:
        out.append(f"__{kind}{used.get(kind, 0)}")
        used[kind] = used.get(kind, 0) + 1
    return out


def _in_slots(keys, slots) -> list[Column]:
    values = dict(zip(_places(keys), [value for _, value in keys]))
    return [(values.get(name, F.lit("") if kind != "bigint" else F.lit(0))).cast(kind).alias(name) for name, kind in slots]


def _values_read(tasks: Sequence[KeyTask]) -> list[str]:
    """The columns that some rule's aggregates read, by position: value ``__x``, order ``__o``, whether the row is chosen ``__c``."""
    names = {}
    for task in tasks:
        for i, calc in enumerate(() if _counts_only(task) else task.calculations):
            used = {f"__x{i}": calc.column != "*", f"__o{i}": calc.order_by is not None, f"__c{i}": calc.where is not None}
            names |= {name: None for name, read in used.items() if read}
    return list(names)


def _value_columns(task: KeyTask, names: Sequence[str]) -> list[Column]:
    """Those columns of one rule; what it does not read is NULL, or chosen."""
    mine = {}
    for i, calc in enumerate(() if _counts_only(task) else task.calculations):
        if calc.column != "*":
            mine[f"__x{i}"] = named(calc.column)
        if calc.order_by is not None:
            mine[f"__o{i}"] = named(calc.order_by)
        if calc.where is not None:
            mine[f"__c{i}"] = holds_or_false(calc.where, dict(task.thresholds))
    nothing = {name: F.lit(True) if name.startswith("__c") else F.lit(None).cast("string") for name in names}
    shown = {name: value if name.startswith("__c") else value.cast("string") for name, value in mine.items()}
    return [(nothing | shown)[name].alias(name) for name in names]


def expanded(rows: DataFrame, tasks: Sequence[KeyTask], slices: Sequence[str]) -> DataFrame:
    """One row per row and rule it takes part in."""
    slots, read = _slots(tasks), _values_read(tasks)
    entries = []
    for task in tasks:
        whole = reduce(lambda a, b: a & b, [value.isNotNull() for _, value in task.keys], task.applicable)
        number = F.when(whole, F.lit(task.number)).alias(RULE)
        entries.append(F.struct(number, *_in_slots(task.keys, slots), *_value_columns(task, read)))
    long = rows.select(*slices, F.inline(F.array(*entries)))
    return long.where(F.col(RULE).isNotNull())


def _counts_only(task: KeyTask) -> bool:
    return all(c.function.strip().lower() == "count" and c.column == "*" and c.where is None for c in task.calculations)


def _gated(task: KeyTask, i: int, calc: Calculation) -> Calculation:
    """The calculation over the shared value columns."""
    mine = f"{RULE} = {task.number}"
    column = "*" if calc.column == "*" else f"__x{i}"
    where = Sql(mine if calc.where is None else f"{mine} and __c{i}")
    return Calculation(calc.function, column, f"__a{task.number}_{i}", where, f"__o{i}" if calc.order_by else None)


def _partials(task: KeyTask, i: int, calc: Calculation, typed: Typed) -> dict[str, tuple[Column, str]]:
    """What a mergeable aggregate needs of each slice: column and how slices merge."""
    name, function = f"__a{task.number}_{i}", calc.function.strip().lower()
    mine = F.col(RULE) == task.number
    mine = mine if calc.where is None else mine & F.col(f"__c{i}")
    value = F.when(mine, F.lit(1) if calc.column == "*" else F.col(f"__x{i}"))
    out = {f"{name}_chosen": (F.count_if(mine), "sum")}
    if function == "count":
        out[name] = (F.count(value), "sum")
    elif function in ("min", "max"):
        out[name] = (getattr(F, function)(value), function)
    else:
        number = number_of(value, function, typed.get(calc.column.lower()))
        out[name] = (F.sum(number), "sum")
        out[f"{name}_n"] = (F.count(number), "sum")
    return out


def _merged(task: KeyTask, i: int, calc: Calculation) -> Column:
    name, function = f"__a{task.number}_{i}", calc.function.strip().lower()
    value = F.col(name) / F.col(f"{name}_n") if function in ("avg", "mean") else F.col(name)
    return value if calc.where is None else F.when(F.col(f"{name}_chosen") > 0, value)


def failing_keys(rows: DataFrame, tasks: Sequence[KeyTask], slices: Sequence[str], typed: Typed | None = None) -> DataFrame:
    """(rule, key slots, slices) of every failing key with ``__n`` rows and the rule's aggregates ``__a{rule}_{i}``."""
    grouped, referring = [t for t in tasks if t.allowed is None], [t for t in tasks if t.allowed is not None]
    parts = [_failing_groups(rows, grouped, slices, typed or {})] if grouped else []
    parts += [_absent_keys(rows, referring, slices)] if referring else []
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _absent_keys(rows: DataFrame, tasks: Sequence[KeyTask], slices: Sequence[str]) -> DataFrame:
    """Keys that the references do not hold; ``__row`` is 1 for a row and 0 for an allowed key, whose slices are NULL."""
    slots = _slots(tasks)
    names = [name for name, _ in slots]
    allowed = reduce(DataFrame.unionByName, [_tagged(t, slots) for t in tasks]).withColumn("__row", F.lit(0))
    met = expanded(rows, tasks, slices).withColumn("__row", F.lit(1)).unionByName(allowed, allowMissingColumns=True)
    found = met.groupBy(RULE, *names, *slices).agg(F.sum("__row").alias(ROWS), F.min("__row").alias("__least"))
    if slices:
        found = found.withColumn("__least", F.min("__least").over(Window.partitionBy(RULE, *names)))
    return found.where(F.col("__least") == 1).select(RULE, *names, *slices, ROWS)


def _failing_groups(rows: DataFrame, tasks: Sequence[KeyTask], slices: Sequence[str], typed: Typed) -> DataFrame:
    slots = [name for name, _ in _slots(tasks)]
    grouped = expanded(rows, tasks, slices).groupBy(RULE, *slots, *slices)
    counted = [t for t in tasks if _counts_only(t)]
    valued = [(t, i, c) for t in tasks if not _counts_only(t) for i, c in enumerate(t.calculations)]
    rows_of_key = F.count(F.lit(1)).alias(ROWS)
    whole = Window.partitionBy(RULE, *slots)
    if slices:
        partial = {}
        for part in valued:
            partial |= _partials(*part, typed)
        found = grouped.agg(rows_of_key, *[column.alias(name) for name, (column, _) in partial.items()])
        total = {"__all": F.sum(ROWS).over(whole)} if counted else {}
        found = found.withColumns(total | {name: getattr(F, how)(name).over(whole) for name, (_, how) in partial.items()})
        found = found.withColumns({f"__a{t.number}_{i}": _merged(t, i, c) for t, i, c in valued})
    else:
        columns = []
        for task, i, calc in valued:
            shown = _gated(task, i, calc)
            kind = typed.get(calc.column.lower())
            column = aggregate_column(shown, None, {} if kind is None else {f"__x{i}": (f"__x{i}", kind[1])})
            columns.append(column.alias(shown.alias))
        found = grouped.agg(rows_of_key, *columns)
        found = found.withColumn("__all", F.col(ROWS)) if counted else found
    aggregates = [f"__a{t.number}_{i}" for t, i, _ in valued]
    for task in counted:
        for i, _ in enumerate(task.calculations):
            found = found.withColumn(f"__a{task.number}_{i}", F.when(F.col(RULE) == task.number, F.col("__all")))
            aggregates.append(f"__a{task.number}_{i}")
    verdict = F.lit(False)
    for task in tasks:
        names = {c.alias.lower(): f"__a{task.number}_{i}" for i, c in enumerate(task.calculations)}
        fails = holds_or_false(renamed(task.having, names), dict(task.thresholds))
        verdict = F.when(F.col(RULE) == task.number, fails).otherwise(verdict)
    return found.where(verdict).select(RULE, *slots, *slices, ROWS, *aggregates)


def _tagged(task: KeyTask, slots) -> DataFrame:
    keys = [(kind, F.col(f"__k{i}")) for i, (kind, _) in enumerate(task.keys)]
    present = reduce(lambda a, b: a & b, [value.isNotNull() for _, value in keys])
    return task.allowed.where(present).select(F.lit(task.number).alias(RULE), *_in_slots(keys, slots))


def of_task(found: DataFrame, task: KeyTask, slices: Sequence[str]) -> DataFrame:
    """The failing keys of one rule: ``__k0``, ``__k1``, ..., slices, ``__n`` and the aggregates by their names."""
    keys = [F.col(place).alias(f"__k{i}") for i, place in enumerate(_places(task.keys))]
    aggregates = [F.col(f"__a{task.number}_{i}").alias(c.alias) for i, c in enumerate(task.calculations)]
    return found.where(F.col(RULE) == task.number).select(*keys, *slices, ROWS, *aggregates)

