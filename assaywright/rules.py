"""The rule description users write: plain dataclasses, no Spark objects inside."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from decimal import Decimal

from . import conditions


@dataclass(frozen=True)
class NationalId:
    """Fifteen-digit 784 identity number check; ``current_year`` is explicit so runs repeat."""

    current_year: int
    dob_column: str | None = None


@dataclass(frozen=True)
class Enrich:
    """Join a side table before aggregation; ``table`` is a name known to the run."""

    table: str
    columns: tuple[str, ...] = ()
    how: str = "inner"


@dataclass(frozen=True)
class Calculation:
    """One aggregate.  ``where`` limits the rows it sees (a group without any gives NULL).

    ``order_by`` makes ``first`` / ``last`` deterministic; ``at`` (0 to 1) is the place of a ``percentile``.
    """

    function: str
    column: str
    alias: str
    where: object | None = None
    order_by: str | None = None
    at: float | None = None


@dataclass(frozen=True)
class GroupAggregate:
    """Aggregates per ``group_by`` (empty: over the whole table).

    ``digest`` groups on SHA-256 of each key column, so long texts are not shuffled.
    """

    group_by: tuple[str, ...]
    calculations: tuple[Calculation, ...]
    digest: bool = False


@dataclass(frozen=True)
class Reference:
    """Allowed values live in ``table``.``columns`` (paired with the rule's columns by position).

    ``scope`` keeps only the reference rows whose columns equal the given values,
    e.g. ``{"ds_table_name": "t", "ds_column_name": "c"}`` for a long code list.
    """

    table: str
    columns: tuple[str, ...]
    scope: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Rule:
    rule_id: str
    columns: tuple[str, ...] = ("*",)
    name: str = ""
    description: str = ""
    dimension: str = ""
    category: str = ""
    severity: str = ""
    rule_type: str = "Data Quality"
    object: str = ""
    system: str = ""
    sub_system: str = ""
    domain: str = ""
    critical_attribute: str = ""
    model_integrity: str = ""
    composite_columns: tuple[str, ...] | None = None
    violation: object | None = None
    national_id: NationalId | None = None
    enrich: Enrich | None = None
    distinct: bool = False
    distinct_columns: tuple[str, ...] = ()
    aggregations: tuple[GroupAggregate, ...] = ()
    having: object | None = None
    references: tuple[Reference, ...] = ()
    thresholds: tuple[tuple[str, object], ...] = field(default=())

    @property
    def is_row_local(self) -> bool:
        """The flag of a row depends on that row alone."""
        return not (self.reshapes_rows or self.aggregations or self.references)

    @property
    def reshapes_rows(self) -> bool:
        """The rule changes how many rows there are, so it cannot share a pass."""
        return self.enrich is not None or self.distinct

    def bind(self, **changes) -> "Rule":
        return dataclasses.replace(self, **changes)

    def to_json(self) -> str:
        """The rule's own definition as JSON, kept in the detail log."""
        shown = {}
        for item in dataclasses.fields(self):
            value = getattr(self, item.name)
            if item.name == "rule_id" or value != item.default:
                shown[item.name] = _plain(value)
        return json.dumps(shown, ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str) -> "Rule":
        """The rule that ``to_json`` wrote, or one written by hand in that form: rules need no Python code.

        Conditions, aggregates and references are objects with their class as ``kind``; unknown kinds and fields are refused.
        """
        given = json.loads(text)
        if not isinstance(given, dict):
            raise ValueError("a rule is a JSON object")
        return _typed({"kind": "Rule", **given})


def _plain(value):
    if dataclasses.is_dataclass(value):
        inner = {f.name: _plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
        return {"kind": type(value).__name__, **inner}
    if isinstance(value, Decimal):
        return {"kind": "Decimal", "value": str(value)}
    if isinstance(value, (tuple, list)):
        return [_plain(item) for item in value]
    return value


def _typed(value):
    """The inverse of ``_plain``."""
    if isinstance(value, list):
        return tuple(_typed(item) for item in value)
    if not isinstance(value, dict):
        return value
    kinds = {c.__name__: c for c in (Rule, NationalId, Enrich, Calculation, GroupAggregate, Reference)}
    kinds |= {name: c for name, c in vars(conditions).items() if dataclasses.is_dataclass(c)}
    kind, fields = value.get("kind"), {k: _typed(v) for k, v in value.items() if k != "kind"}
    if kind == "Decimal":
        return Decimal(fields["value"])
    if kind not in kinds:
        raise ValueError(f"unknown kind {kind!r} in a rule")
    unknown = set(fields) - {f.name for f in dataclasses.fields(kinds[kind])}
    if unknown:
        raise ValueError(f"{kind} has no fields {sorted(unknown)}")
    return kinds[kind](**fields)
