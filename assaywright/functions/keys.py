"""Business keys, record image and the key that ties summary and detail together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import named

# Order of the fields inside the row-group key and the number of unpacked keys.
GROUP_KEY_FIELDS = ("rule_id", "dimension", "object", "attribute_name", "year_id", "batch_id", "rule_run_date")
DOMAIN_FIELDS = ("system", "sub_system", "domain")
UNPACKED_KEYS = 4


def row_group_key(fields: Sequence[str] = GROUP_KEY_FIELDS + DOMAIN_FIELDS) -> Column:
    """SHA-256 over the joined fields; NULL fields are skipped, in summary and detail alike."""
    return F.sha2(F.concat_ws("-", *[named(f).cast("string") for f in fields]), 256)


def key_names(columns: Sequence[str] | None) -> str | None:
    return None if columns is None else "-".join(columns)


def key_values(columns: Sequence[str] | None) -> Column:
    if columns is None:
        return F.lit(None).cast("string")
    if not columns:
        return F.lit("")
    return F.concat_ws("||", *[F.trim(named(c)) for c in columns])


def key_value_at(columns: Sequence[str] | None, position: int, lower: bool = False) -> Column:
    """Value of the n-th key column, read from the row itself (no JSON parsing)."""
    if not columns or position >= len(columns):
        return F.lit(None).cast("string")
    value = named(columns[position])
    return F.lower(value) if lower else value


def attribute_values(columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[named(c) for c in columns])


def record_image(columns: Sequence[str], extra: Sequence[Column] = ()) -> Column:
    """JSON of the whole record with NULL fields kept."""
    return F.to_json(F.struct(*[named(c) for c in columns], *extra), {"ignoreNullFields": "false"})
