"""The shipped rules as typed rules, by id.  ``build`` binds one to a table's columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass


from ..conditions import Compare, Matches, OneOf
from ..rules import Calculation, GroupAggregate, NationalId, Reference, Rule
from . import values as V

DUPLICATE_RULE = "DQ_005"
REFERENCE_RULES = ("DQ_003", "DQ_004")


@dataclass(frozen=True)
class Template:
    name: str
    dimension: str
    category: str
    condition: Callable[[str], object] | None = None
    severity: str = ""
    description: str = ""


def _shape(pattern: str) -> Callable[[str], object]:
    return lambda column: Matches(column, pattern, negate=True)


def _listed(allowed: Sequence[str]) -> Callable[[str], object]:
    return lambda column: OneOf(column, tuple(allowed), negate=True)


# Ids, names, dimensions and categories of the shipped rules.
TEMPLATES = {
    "DQ_001": Template("Null Value Check", "completeness", "Missing Values", severity="Major",
                       description="Ensure no values are NULL or missing."),
    "DQ_002": Template("Numeric Value Check", "validity", "Integer Value Check", _shape(V.DECIMAL_NUMBER), "Major",
                       "Ensure values contain only numeric characters (0-9)."),
    "DQ_003": Template("Value Consistency Check", "consistency", "Inconsistent Values With Master Tables",
                       description="Ensure all values are consistent across the dataset and adhere to defined"
                       " standards."),
    "DQ_004": Template("Foreign Key Integrity", "integrity", "Inconsistent Values With Foreign Tables",
                       description="Ensure foreign keys correctly reference existing records in the related tables."),
    "DQ_005": Template("Duplicate Value Check", "uniqueness", "Duplicate Values",
                       description="Ensure values are unique and distinct within the dataset."),
    "DQ_006": Template("Decimal Value Check", "validity", "Decimal Value Expected", _shape(V.DECIMAL_NUMBER), "",
                       "Ensure values contain only decimal numbers (with optional decimal places)."),
    "DQ_007": Template("Emirates ID Validation", "relevance", "EmiratesID Format Mismatch",
                       description='Ensure Emirates ID contains 15 numeric characters, starting with "784" and pass'
                       " Luhn Algorith Checks"),
    "DQ_008": Template("Full Date-Time Format Check", "validity", "Date Format Mismatch", _shape(V.DATE_TIME_FULL), "",
                       "Ensure date values are in the format yyyymmdd hh:mm:ss.SSS or yyyy-mm-dd hh:mm:ss.SSS."),
    "DQ_009": Template("Date Format (Simple) Check", "validity", "Date Format Mismatch", _shape(V.DATE_SIMPLE), "",
                       "Ensure date values are in the format yyyymmdd or yyyy-mm-dd."),
    "DQ_010": Template("ISO Date-Time Format Check", "validity", "Date Format Mismatch", _shape(V.DATE_TIME_ISO), "",
                       "Ensure date values follow the format yyyy-mm-ddTHH:MM:SSZ or yyyy-mm-dd HH:MM:SS."),
    "DQ_011": Template("Alphanumeric Check", "validity", "Alpha Numeric Check", _shape(V.ALPHANUMERIC), "",
                       "Ensure values are alphanumeric, containing only letters and numbers."),
    "DQ_012": Template("Email Address Validation", "validity", "Email ID Check", _shape(V.EMAIL), "",
                       "Ensure values contain valid email addresses following standard email formats (e.g.,"
                       " example@domain.com)."),
    "DQ_013": Template("Phone Number Validation", "relevance", "Phone Number Check", _shape(V.PHONE), "",
                       "Ensure values contain valid phone numbers, following predefined formats."),
    "DQ_014": Template("Gender Value Validation", "validity", "Gender Check", _listed(V.GENDERS), "",
                       'Ensure values contain only "Male" or "Female".'),
    "DQ_015": Template("English Alphabet Check", "validity", "English Character Check",
                       lambda column: Matches(column, V.ENGLISH_TEXT, True, V.ENGLISH_EVERY, V.ENGLISH_NONE), "",
                       "Ensure values contain only English alphabet characters (A-Z)."),
    "DQ_016": Template("Arabic Text Check", "validity", "Arabic Text Check", _shape(V.ARABIC_TEXT), "",
                       "Ensure values contain only Arabic characters."),
    "DQ_017": Template("Multiple Valide Date-Time Format Check", "validity", "Date Format Mismatch",
                       _shape(V.DATE_MULTI), "",
                       "Ensure date values follow the format yyyy-mm-ddTHH:MM:SSZ or yyyy-mm-dd"
                       " HH:MM:SS,yyymmdd,yyyy-mm-dd"),
    "DQ_018": Template("Curriculum Value Validation", "validity", "Curriculum Check", _listed(V.CURRICULA), "",
                       "Ensure values contain only Valid Curriculum."),
    "DQ_019": Template("Nationality Value Validation", "validity", "Nationality Check", _listed(V.NATIONALITIES), "",
                       "Ensure values contain only Valid Nationality."),
    "DQ_020": Template("Marital Status Value Validation", "validity", "Marital Status Check",
                       _listed(V.MARITAL_STATUSES), "", "Ensure values contain only Valid Marital."),
    "DQ_021": Template("Grade Value Validation", "validity", "Grade Check", _listed(V.GRADES), "",
                       "Ensure values contain only Valid Grade."),
    # Shipped without an id: named here so that they can be bound like the others.
    "whole_number": Template("Number Check", "validity", "Number Check", _shape(V.WHOLE_NUMBER), "Major"),
    "emirate": Template("Emirates Check", "validity", "Emirates Check", _listed(V.EMIRATES)),
}


def build(
    rule_id: str,
    columns: Sequence[str] | str,
    *,
    current_year: int | None = None,
    dob_column: str | None = None,
    reference: Reference | None = None,
    digest: bool = False,
    **about,
) -> Rule:
    """A shipped rule bound to columns; ``about`` sets any other ``Rule`` field (object, system, ...)."""
    template = TEMPLATES[rule_id]
    columns = (columns,) if isinstance(columns, str) else tuple(columns)
    parts: dict = {}
    if rule_id == DUPLICATE_RULE:
        count = Calculation("count", "*", "duplicate_count")
        parts["aggregations"] = (GroupAggregate(columns, (count,), digest),)
        parts["having"] = Compare("duplicate_count", ">", 1)
    elif rule_id in REFERENCE_RULES:
        if reference is None:
            raise ValueError(f"{rule_id} needs a reference table and columns")
        parts["references"] = (reference,)
    elif rule_id == "DQ_007":
        if current_year is None:
            raise ValueError("DQ_007 needs current_year")
        parts["national_id"] = NationalId(current_year, dob_column)
    elif template.condition is not None:
        parts["violation"] = template.condition(columns[0])
    fields = {
        "name": template.name, "description": template.description, "dimension": template.dimension,
        "category": template.category, "severity": template.severity,
    }
    return Rule(rule_id, columns, **{**fields, **parts, **about})
