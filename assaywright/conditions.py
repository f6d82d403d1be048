"""Typed conditions: what a rule calls a violation.

A condition is a small immutable description; ``functions.predicates`` turns it
into a Spark ``Column``.  Field names are plain column names (any characters,
matched case-insensitively by Spark); a raw SQL expression is written as
``Sql("a - b")`` and a threshold name as ``Param("max_total")``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Union


@dataclass(frozen=True)
class Sql:
    """A raw Spark SQL expression, used as a field or as a value."""

    text: str


@dataclass(frozen=True)
class Param:
    """Threshold name(s); space-separated words found in the thresholds are replaced."""

    text: str


Field = Union[str, Sql]


@dataclass(frozen=True)
class Matches:
    """The trimmed text contains a match of ``pattern`` (find, not full match).

    A repeated group recurses once per repetition in Java's matcher and can
    overflow the stack on a long text.  ``every`` and ``none`` then say the same
    without one: all of ``every`` match and none of ``none`` does.
    """

    field: Field
    pattern: str
    negate: bool = False
    every: tuple = ()
    none: tuple = ()


@dataclass(frozen=True)
class Compare:
    """``field op value`` with op one of ``= == <> != < <= > >= <=>``.

    Text against text ignores case and outer spaces.  A numeric value compares
    as numbers unless ``text`` asks for the text order; a field that is not a
    number then makes the condition unknown, which counts as not violated.
    """

    field: Field
    op: str
    value: object
    negate: bool = False
    text: bool = False


@dataclass(frozen=True)
class OneOf:
    """Case-insensitive, trimmed membership in a fixed list."""

    field: Field
    values: tuple
    negate: bool = False


@dataclass(frozen=True)
class Between:
    field: Field
    low: object
    high: object
    negate: bool = False
    text: bool = False


@dataclass(frozen=True)
class Like:
    field: Field
    pattern: str
    negate: bool = False


@dataclass(frozen=True)
class IsNull:
    field: Field
    negate: bool = False


@dataclass(frozen=True)
class CastsTo:
    """The trimmed text can be read as the Spark type ``type_name``."""

    field: Field
    type_name: str
    negate: bool = False


@dataclass(frozen=True)
class Chain:
    """Conditions with ``"and"`` / ``"or"`` between them; AND binds first, as in SQL."""

    items: tuple
    negate: bool = False


def all_of(*conditions) -> Chain:
    return Chain(_interleave(conditions, "and"))


def any_of(*conditions) -> Chain:
    return Chain(_interleave(conditions, "or"))


def if_then(premise, conclusion) -> Chain:
    """Business rule "if premise then conclusion": violated when premise and not conclusion."""
    return Chain((premise, "and", replace(conclusion, negate=not conclusion.negate)))


def _interleave(conditions, word) -> tuple:
    items: list = []
    for condition in conditions:
        if items:
            items.append(word)
        items.append(condition)
    return tuple(items)


def leaves(condition) -> list:
    """All leaf conditions of a tree, left to right."""
    if condition is None:
        return []
    if isinstance(condition, Chain):
        return [leaf for item in condition.items if not isinstance(item, str) for leaf in leaves(item)]
    return [condition]


def plain_fields(condition) -> set[str] | None:
    """Lower-cased plain column names a condition reads; None when it holds raw SQL."""
    names = set()
    for leaf in leaves(condition):
        if isinstance(leaf.field, Sql) or isinstance(getattr(leaf, "value", None), (Sql, Param)):
            return None
        names.add(leaf.field.lower())
    return names


def renamed(condition, names: dict[str, str]):
    """The condition with plain field names (given in lower case) replaced."""
    if isinstance(condition, Chain):
        return replace(condition, items=tuple(i if isinstance(i, str) else renamed(i, names) for i in condition.items))
    if isinstance(condition.field, Sql):
        return condition
    return replace(condition, field=names.get(condition.field.lower(), condition.field))
