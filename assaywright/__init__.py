"""Rule-based data validation on Spark: typed rules, one pass per table, summary and detail logs."""

from .conditions import (
    Between, CastsTo, Chain, Compare, IsNull, Like, Matches, OneOf, Param, Sql, all_of, any_of, if_then,
)
from .rules import Calculation, Enrich, GroupAggregate, NationalId, Reference, Rule

__all__ = [
    "Between", "Calculation", "CastsTo", "Chain", "Compare", "Enrich", "GroupAggregate", "IsNull", "Like",
    "Matches", "NationalId", "OneOf", "Param", "Reference", "Rule", "Sql", "all_of", "any_of", "if_then",
]
