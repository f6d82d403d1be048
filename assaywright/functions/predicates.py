"""From typed conditions to Spark columns and violation messages."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..conditions import Between, CastsTo, Chain, Compare, IsNull, Like, Matches, OneOf, Param, Sql, leaves
from .text import named

COMPARISONS = {
    "=": operator.eq,
    "==": operator.eq,
    "<>": operator.ne,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "<=>": lambda left, right: left.eqNullSafe(right),
}


def holds(condition, thresholds: Mapping | None = None, typed: Mapping | None = None) -> Column:
    """Boolean column; may be NULL where the inputs are NULL.

    ``typed`` gives, per lower-case field, a column that holds the value in its own type (bigint, double or decimal)
    and that type: numbers are then compared in it instead of being read from text.
    """
    thresholds, typed = thresholds or {}, typed or {}
    if isinstance(condition, Chain):
        test = _chain(condition, thresholds, typed)
    else:
        test = _leaf(condition, thresholds, typed)
    return ~test if condition.negate else test


def holds_or_false(condition, thresholds: Mapping | None = None, typed: Mapping | None = None) -> Column:
    """As ``holds``, with an unknown result counted as false."""
    return F.coalesce(holds(condition, thresholds, typed), F.lit(False))


def messages(condition, thresholds: Mapping | None = None, typed: Mapping | None = None) -> list[Column]:
    """One nullable message per leaf, present where that leaf holds."""
    thresholds = thresholds or {}
    return [F.when(holds(leaf, thresholds, typed), F.lit(describe(leaf, thresholds))) for leaf in leaves(condition)]


def describe(leaf, thresholds: Mapping | None = None) -> str:
    field = leaf.field.text if isinstance(leaf.field, Sql) else leaf.field
    if isinstance(leaf, Matches):
        return f"Regex pattern violated in {field}: {leaf.pattern}"
    if isinstance(leaf, Compare):
        tail = f"{leaf.op} {_shown(leaf.value, thresholds)}"
    elif isinstance(leaf, OneOf):
        tail = "IN (" + ", ".join(_shown(v) for v in leaf.values) + ")"
    elif isinstance(leaf, Between):
        tail = f"BETWEEN {_shown(leaf.low, thresholds)} AND {_shown(leaf.high, thresholds)}"
    elif isinstance(leaf, Like):
        tail = f"LIKE {_shown(leaf.pattern)}"
    elif isinstance(leaf, IsNull):
        tail = "IS NULL"
    else:
        tail = f"IS {leaf.type_name}"
    return f"Condition violated: {field} {tail}"


def substitute(param: Param, thresholds: Mapping) -> str:
    """Space-separated words that name a threshold are replaced by its value."""
    return " ".join(str(thresholds.get(word, word)) for word in param.text.split(" "))


def _shown(value, thresholds: Mapping | None = None) -> str:
    if isinstance(value, Sql):
        return value.text
    if isinstance(value, Param):
        return substitute(value, thresholds or {})
    return f"'{value}'" if isinstance(value, str) else str(value)


def _chain(chain: Chain, thresholds: Mapping, typed: Mapping) -> Column:
    alternatives: list[list[Column]] = [[]]
    for item in chain.items:
        if isinstance(item, str):
            word = item.strip().lower()
            if word not in ("and", "or"):
                raise ValueError(f"unknown logical operator {item!r}")
            if word == "or":
                alternatives.append([])
        else:
            alternatives[-1].append(holds(item, thresholds, typed))
    return reduce(operator.or_, [reduce(operator.and_, group) for group in alternatives])


def _leaf(leaf, thresholds: Mapping, typed: Mapping) -> Column:
    raw = F.expr(leaf.field.text) if isinstance(leaf.field, Sql) else named(leaf.field)
    if isinstance(leaf, Matches):
        if not leaf.every and not leaf.none:
            return F.trim(raw).rlike(leaf.pattern)
        tests = [F.trim(raw).rlike(p) for p in leaf.every] + [~F.trim(raw).rlike(p) for p in leaf.none]
        return reduce(operator.and_, tests)
    if isinstance(leaf, IsNull):
        return raw.isNull()
    if isinstance(leaf, CastsTo):
        return F.trim(raw).try_cast(leaf.type_name).isNotNull()
    if isinstance(leaf, OneOf):
        return _folded(raw).isin([str(v).strip().lower() for v in leaf.values])
    if isinstance(leaf, Like):
        return _folded(raw).like(leaf.pattern.strip().lower())
    if isinstance(leaf, Between):
        low = Compare(leaf.field, ">=", leaf.low, text=leaf.text)
        high = Compare(leaf.field, "<=", leaf.high, text=leaf.text)
        return _leaf(low, thresholds, typed) & _leaf(high, thresholds, typed)
    if isinstance(leaf, Compare):
        return _compared(leaf, raw, thresholds, typed)
    raise TypeError(f"not a condition: {leaf!r}")


def _compared(leaf: Compare, raw: Column, thresholds: Mapping, typed: Mapping) -> Column:
    value, compare = leaf.value, COMPARISONS[leaf.op]
    if isinstance(value, Param):
        value = _parameter(substitute(value, thresholds))
    expression = isinstance(leaf.field, Sql)
    if isinstance(value, Sql):
        other = F.expr(value.text)
        return compare(raw, other) if expression else compare(_folded(raw), _folded(other))
    number = isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
    if expression:
        return compare(raw, F.lit(value))
    if number and not leaf.text:
        return _compared_numbers(compare, raw, value, typed.get(leaf.field.lower()))
    return compare(_folded(raw), F.lit(str(value).strip().lower()))


def _compared_numbers(compare, raw: Column, value, kind: tuple[str, str] | None) -> Column:
    """Exact where value and column are: whole numbers and decimals never pass through a double.

    Text is read as a decimal of 20 places before and 18 after the point, and as a double only beyond these.
    """
    exact = exact_literal(value)
    if kind is not None:
        column, name = F.col(kind[0]), kind[1]
        if name == "double" or exact is None:
            return compare(column.cast("double"), F.lit(float(value)))
        if name == "bigint" and isinstance(value, int) and abs(value) < 1 << 63:
            return compare(column, F.lit(value).cast("bigint"))
        return compare(column, exact)
    text = F.trim(raw.cast("string"))
    rough = compare(text.try_cast("double"), F.lit(float(value)))
    if exact is None or isinstance(value, float):
        return rough
    return F.coalesce(compare(text.try_cast("decimal(38,18)"), exact), rough)


def exact_literal(value) -> Column | None:
    """The number as a decimal; None where it has none (infinite, or of too many digits)."""
    try:
        number = Decimal(repr(value)) if isinstance(value, float) else Decimal(value)
    except InvalidOperation:
        return None
    if not number.is_finite():
        return None
    _, digits, exponent = number.as_tuple()
    after = max(0, -exponent)
    if after > 18 or len(digits) + max(0, exponent) - after > 20:
        return None
    return F.lit(f"{number:f}").cast(f"decimal({min(38, 20 + after)},{after})")


def _parameter(text: str):
    if re.fullmatch(r"[+-]?\d+", text):
        return int(text)
    if re.fullmatch(r"[+-]?\d*\.\d+", text):
        return Decimal(text)
    if len(text) > 1 and text[0] == text[-1] == "'":
        return text[1:-1]
    return Sql(text)


def _folded(value: Column) -> Column:
    return F.lower(F.trim(value.cast("string")))

