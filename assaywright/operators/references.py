"""Reference lookups: which key values of a table are absent from an allowed set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ..functions.text import lookup_key, named
from ..rules import Reference
from .groups import counted_groups


def allowed_rows(
    table: DataFrame, reference: Reference, keys: Sequence[str], kinds: Sequence[str] = ()
) -> DataFrame:
    """Normalised reference keys, one per row of the table, limited to the reference's scope if it has one.

    Keys of the kind ``bigint`` are compared as the numbers they are, the others as text.
    """
    for column, value in reference.scope:
        table = table.where(named(column) == value)
    kinds = kinds or ["string"] * len(keys)
    columns = [
        (named(c).cast("bigint") if kind == "bigint" else lookup_key(named(c))).alias(k)
        for k, kind, c in zip(keys, kinds, reference.columns)
    ]
    return table.select(*columns)


def allowed_keys(
    table: DataFrame, reference: Reference, keys: Sequence[str], kinds: Sequence[str] = ()
) -> DataFrame:
    """The same, each key once."""
    return allowed_rows(table, reference, keys, kinds).distinct()


def failing_groups(
    rows: DataFrame,
    keys: Mapping[str, Column],
    slices: Sequence[str],
    table: DataFrame,
    reference: Reference,
    kinds: Sequence[str] = (),
) -> DataFrame:
    """Key values (with row counts per slice) that the reference table does not hold.

    Both sides are reduced to distinct keys first, so a value carried by a third
    of all rows is one row by the time the join runs.
    """
    counts = counted_groups(rows, keys, slices)
    return counts.join(allowed_keys(table, reference, list(keys), kinds), list(keys), "left_anti")
