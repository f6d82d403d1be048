"""Rule configuration as tables: selection, screening, thresholds and expansion into rules."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_by_name
from ..rules import Reference, Rule
from .builtin import DUPLICATE_RULE, REFERENCE_RULES, TEMPLATES, build

ALL = "all"
# Name fragments of the two layers and the keys that tie thresholds to rules.
LAYERS = {"silver": "%silver%", "bronze": "%bnz%"}
THRESHOLD_KEYS = ("rule_id", "domain", "system", "sub_system", "rule_type")
MANDATORY = ("database_name", "table_name", "columns")
REFERENCE_FIELDS = ("reference_database", "reference_table_name", "reference_columns")


def _listed(text: str) -> list[str]:
    return [part.strip() for part in text.split(",") if part.strip()]


def _everything(text: str | None) -> bool:
    return text is None or text.strip().lower() in ("", ALL)


def active(config: DataFrame, rule_type: str = ALL, rules: str = ALL) -> DataFrame:
    """Active rows of one rule type and an exact list of rule ids (``all`` keeps everything)."""
    kept = config.where(F.col("is_active") == 1)
    if not _everything(rule_type):
        kept = kept.where(F.col("rule_type") == rule_type)
    if not _everything(rules):
        kept = kept.where(F.col("rule_id").isin(_listed(rules)))
    return kept


def select_bindings(
    bindings: DataFrame,
    rule_type: str = ALL,
    rules: str = ALL,
    systems: str = ALL,
    sub_systems: str = ALL,
    domains: str = ALL,
    tables: str = ALL,
    layer: str = "",
    excluded: str = "",
) -> DataFrame:
    """Bindings to run; system, sub-system, domain and table lists ignore case."""
    kept = active(bindings, rule_type, rules)
    wanted = {"system": systems, "sub_system": sub_systems, "domain": domains, "table_name": tables}
    for column, text in wanted.items():
        if not _everything(text):
            kept = kept.where(F.lower(column).isin([v.lower() for v in _listed(text)]))
    if excluded and excluded.strip():
        kept = kept.where(~F.lower("table_name").isin([v.lower() for v in _listed(excluded)]))
    if layer and layer.lower() in LAYERS:
        kept = kept.where(F.lower("table_name").like(LAYERS[layer.lower()]))
    return kept


def screened(bindings: DataFrame) -> DataFrame:
    """Adds ``reject_reason``: NULL for complete bindings, a text for the others."""
    incomplete = _any_blank(MANDATORY)
    unreferenced = F.col("rule_id").isin(list(REFERENCE_RULES)) & _any_blank(REFERENCE_FIELDS)
    reference_text = F.concat(
        F.lit(f"Reference fields are missing: {', '.join(REFERENCE_FIELDS)}, for "), F.col("table_name")
    )
    reason = F.when(incomplete, F.lit(f"Mandatory fields {', '.join(MANDATORY)} are missing"))
    return bindings.withColumn("reject_reason", reason.when(unreferenced, reference_text))


def accepted(bindings: DataFrame) -> DataFrame:
    return screened(bindings).where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(bindings: DataFrame) -> DataFrame:
    return screened(bindings).where(F.col("reject_reason").isNotNull())


def _any_blank(columns: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in columns:
        test = test | F.coalesce(F.trim(F.col(name)) == "", F.lit(True))
    return test


def with_thresholds(rules: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Rules left-joined to their thresholds, a map of name to value."""
    parsed = thresholds.select(
        *THRESHOLD_KEYS, F.from_json("thresholdvalue", "map<string,string>").alias("thresholds")
    )
    return join_by_name(rules, parsed, "left", THRESHOLD_KEYS)


def bound_rules(rules: DataFrame, bindings: DataFrame) -> DataFrame:
    """Rules joined to bindings on the rule id; the binding's own place in the organisation wins."""
    theirs = [c for c in bindings.columns if c in rules.columns and c != "rule_id"]
    own = ("system", "sub_system", "domain")
    kept_rules = rules.drop(*own)
    kept_bindings = bindings.drop(*[c for c in theirs if c not in own])
    joined = kept_rules.join(kept_bindings, "rule_id", "inner")
    return joined.dropDuplicates([name for name, kind in joined.dtypes if not kind.startswith("map")])


def expanded(bindings: DataFrame) -> DataFrame:
    """One row per rule and column; duplicate rules keep their whole column list.

    Reference columns, critical attributes and model integrities pair with the
    columns by position; a shorter list is padded with the empty text, and a
    reference rule without its reference column is refused by ``to_rules``.  In a
    reference rule ``a+b`` is one key of two columns, paired with ``x+y``.
    Bindings repeated in different letter case are kept once.
    """
    whole = F.col("rule_id") == DUPLICATE_RULE
    columns = F.when(whole, F.array(F.trim("columns"))).otherwise(F.split("columns", ","))
    listed = bindings.select("*", F.posexplode(columns).alias("position", "column")).withColumn(
        "column", F.trim("column")
    )

    def paired(name: str) -> Column:
        text = F.coalesce(F.col(name), F.lit(""))
        value = F.try_element_at(F.split(text, ","), F.col("position") + 1)
        return F.when(whole, text).otherwise(F.trim(F.coalesce(value, F.lit(""))))

    shaped = listed.withColumns(
        {
            "reference_column": paired("reference_columns"),
            "critical": paired("critical_attribute"),
            "integrity": paired("model_integrity"),
        }
    )
    place = ("rule_id", "system", "sub_system", "domain", "database_name", "table_name", "reference_table_name")
    same = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in (*place, "column", "reference_column")]
    first = F.min_by(F.struct(*[F.col(c) for c in shaped.columns]), F.struct("column", "position")).alias("kept")
    marks = {f"__same{i}": value for i, value in enumerate(same)}
    # the records are sorted to be aggregated: dealt first, so that no task sorts all that one scanning task reads
    share = F.pmod(F.xxhash64(*[F.col(c) for c in bindings.columns if dict(bindings.dtypes)[c][:3] != "map"]), F.lit(16))
    dealt = shaped.select("*", *[value.alias(mark) for mark, value in marks.items()]).repartition(*marks, share)
    return dealt.groupBy(*marks).agg(first).select("kept.*")


def target_tables(bindings: DataFrame) -> DataFrame:
    """One row per database and table, with the smallest domain and key seen for it."""
    about = ("system", "sub_system", "domain", "composite_columns")
    return bindings.groupBy("database_name", "table_name").agg(*[F.min(c).alias(c) for c in about])


def to_rules(rows: Sequence, current_year: int, custom: Mapping[str, Callable[..., Rule]] | None = None) -> list[Rule]:
    """Typed rules from expanded binding rows (bounded by the configuration's size).

    ``custom`` maps the ids of a user's own rules to functions that take the
    bound columns and the descriptive fields and return a ``Rule``.
    """
    return [_to_rule(row.asDict(), current_year, custom or {}) for row in rows]


def _key_parts(entry: str) -> list[str]:
    """The columns of one key: ``a`` or, for a key of several, ``a+b``."""
    return [part.strip() for part in (entry or "").split("+") if part.strip()]


def _to_rule(row: dict, current_year: int, custom: Mapping[str, Callable[..., Rule]]) -> Rule:
    rule_id = row["rule_id"]
    if rule_id not in TEMPLATES and rule_id not in custom:
        raise ValueError(f"unknown rule {rule_id}")
    about = {
        "object": row["table_name"], "system": row["system"], "sub_system": row["sub_system"],
        "domain": row["domain"], "rule_type": row["rule_type"], "critical_attribute": row["critical"],
        "model_integrity": row["integrity"],
        "composite_columns": tuple(_listed(row["composite_columns"] or "")),
    }
    for field, column in (("name", "rule_name"), ("description", "rule_description")):
        if row.get(column):
            about[field] = row[column]
    thresholds = row.get("thresholds") or {}
    if isinstance(thresholds, str):
        thresholds = json.loads(thresholds)
    about["thresholds"] = tuple(sorted(thresholds.items()))
    if rule_id in custom:
        return custom[rule_id]((row["column"],), **about)
    reference = None
    if rule_id in REFERENCE_RULES:
        table = ".".join(p for p in (row["reference_database"], row["reference_table_name"]) if p)
        columns, theirs = _key_parts(row["column"]), _key_parts(row["reference_column"])
        if len(columns) != len(theirs):
            raise ValueError(f"{row['column']} is not paired with as many reference columns of {table}")
        reference = Reference(table, tuple(theirs))
    else:
        columns = _listed(row["column"]) if rule_id == DUPLICATE_RULE else [row["column"]]
    return build(rule_id, columns, current_year=current_year, reference=reference, **about)
